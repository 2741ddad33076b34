"""Project settings: a repository's own file, or the contract's defaults."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass
from decimal import Decimal
from pathlib import Path

from finlake.contracts import DATASETS, EXPECTED_INVOICES_PER_COUNTRY, MIN_VOLUME_RATIO, NONCRITICAL, RULES

FILE = "finlake.json"


@dataclass(frozen=True)
class ProjectConfig:
    """Thresholds and rules of a project. rules_version is a digest of all of them."""

    reporting_currency: str = "EUR"
    money_scale: Decimal = Decimal("0.01")
    rate_scale: Decimal = Decimal("0.000001")
    expected_invoices_per_country: int = EXPECTED_INVOICES_PER_COUNTRY
    min_volume_ratio: Decimal = Decimal(MIN_VOLUME_RATIO)
    critical_rules: frozenset[str] = frozenset(RULES) - frozenset(NONCRITICAL)

    @property
    def dataset_keys(self) -> dict[str, tuple[str, ...]]:
        return {n: d.key for n, d in DATASETS.items()}

    @property
    def ordered_datasets(self) -> tuple[str, ...]:
        return tuple(DATASETS)

    @property
    def rules_version(self) -> str:
        held = [self.reporting_currency, str(self.money_scale), str(self.rate_scale), self.expected_invoices_per_country, str(self.min_volume_ratio), sorted(self.critical_rules)]
        return hashlib.sha256(json.dumps(held, separators=(",", ":")).encode()).hexdigest()


def load_project_config(root: str | Path | None = None) -> ProjectConfig:
    """Settings of `root`/finlake.json, of the nearest such file above the working folder, or the defaults."""
    if root is not None:
        path = Path(root) / FILE
        if not path.is_file():
            raise FileNotFoundError(path)
    else:
        here = Path.cwd().resolve()
        path = next((p / FILE for p in (here, *here.parents) if (p / FILE).is_file()), None)
        if path is None:
            return ProjectConfig()
    found = json.loads(path.read_text(encoding="utf-8"))
    kinds = {"money_scale": Decimal, "rate_scale": Decimal, "min_volume_ratio": Decimal, "expected_invoices_per_country": int, "critical_rules": frozenset, "reporting_currency": str}
    if unknown := set(found) - set(kinds):
        raise ValueError(f"{path}: unknown settings {', '.join(sorted(unknown))}")
    made = ProjectConfig(**{k: kinds[k](v) for k, v in found.items()})
    if wrong := made.critical_rules - set(RULES):
        raise ValueError(f"{path}: unknown rules {', '.join(sorted(wrong))}")
    if not 0 <= made.min_volume_ratio <= 1 or made.expected_invoices_per_country < 0:
        raise ValueError(f"{path}: a threshold is out of range")
    return made
