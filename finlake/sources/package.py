"""A governed export package of Silver, and loading it into a serving store once.

A package is a folder of CSV parts per table with a manifest of counts, EUR totals and checksums. Tables are written by
Spark in as many parts as they need, ordered by key over all parts.
"""

from __future__ import annotations

import copy
import hashlib
import json
import re
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime
from decimal import Decimal
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.contracts import CONTRACT_VERSION, DATASETS
from finlake.functions import expr
from finlake.operators.gold import month_open, with_fx_impact
from finlake.plans import buckets, serving, star
from finlake.plans.store import ALL, Store, write_json
from finlake.sources.delivery import SAFE_ID, file_digest

TABLES = tuple(n for n in DATASETS if n != "exchange_rates")
#: Exported beside them: quality results.
QUALITY, QUALITY_KEY = "data_quality_results", ("batch_id", "affected_dataset", "rule_name")
#: What tells a fact's rows apart.
FACT_KEYS = {"fact_shipment": ["shipment_id"], "fact_invoice": ["invoice_id"], "fact_operational_cost": ["cost_id"], "fact_budget": ["month_date_key", "cost_center_key", "currency_key"]}


class PackageError(ValueError):
    """A package that isn't what its manifest says."""


def projections(silver: dict[str, DataFrame], results: DataFrame | None = None) -> dict[str, DataFrame]:
    """What is exported. Invoices carry their amount at the month's opening rate; rates stay behind. Quality results go along
    where they are given."""
    out = {n: silver[n] for n in TABLES}
    invoices = with_fx_impact(silver["invoices"], "invoice_date", "revenue_amount", month_open(silver["exchange_rates"]))
    out["invoices"] = invoices.withColumn("amount_at_comparison_rate_eur", F.coalesce("amount_at_open_eur", "amount_eur")).drop("month_start", "amount_at_open_eur", "fx_impact_eur")
    return out | ({QUALITY: serving.exported_quality(results)} if results is not None else {})


def _checksum(folder: Path) -> str:
    digest = hashlib.sha256()
    for part in sorted(folder.glob("part-*")):
        digest.update(file_digest(part))
    return digest.hexdigest()


def _totals(frame: DataFrame) -> dict:
    amount = F.sum(F.col("amount_eur").cast(expr.MONEY)) if "amount_eur" in frame.columns else F.lit(None)
    row = frame.agg(F.count("*").alias("n"), amount.alias("v")).first()
    return {"rows": row["n"], "total_eur": None if row["v"] is None else str(row["v"])}


def build_package(silver: dict[str, DataFrame], folder: str | Path, load_id: str, exported_at: str, safe: bool = False, results: DataFrame | None = None) -> dict:
    """Writes the package; `safe` guards text cells against spreadsheets (never done to stored data)."""
    folder = Path(folder)
    tables = {}
    for name, frame in projections(silver, results).items():
        ordered = frame.orderBy(*(QUALITY_KEY if name == QUALITY else DATASETS[name].key))
        if safe:
            ordered = ordered.withColumns({c: expr.spreadsheet_safe(F.col(c)) for c, kind in ordered.dtypes if kind == "string"})
        ordered.write.mode("overwrite").options(header=True, escape='"', emptyValue="", nullValue="\\N").csv(str(folder / name))
        tables[name] = _totals(frame) | {"sha256": _checksum(folder / name), "columns": frame.columns}
    found = {"contract_version": CONTRACT_VERSION, "status": "complete", "load_id": load_id, "exported_at": exported_at, "tables": tables}
    found["fingerprint"] = hashlib.sha256(json.dumps(tables, sort_keys=True).encode()).hexdigest()
    write_json(folder / "manifest.json", found)
    return found


def read_table(spark: SparkSession, folder: Path, name: str) -> DataFrame:
    return spark.read.options(header=True, escape='"', emptyValue="", nullValue="\\N", mode="FAILFAST", multiLine=True).csv(str(folder / name))


def validate_package(spark: SparkSession, folder: str | Path) -> dict:
    folder = Path(folder)
    try:
        found = json.loads((folder / "manifest.json").read_text(encoding="utf-8"))
        datetime.fromisoformat(found["exported_at"].replace("Z", "+00:00"))
    except (OSError, ValueError, KeyError, AttributeError) as e:
        raise PackageError("the manifest can't be read") from e
    if found.get("contract_version") != CONTRACT_VERSION or found.get("status") != "complete" or not re.fullmatch("[0-9a-f]{64}", str(found.get("fingerprint"))):
        raise PackageError("the manifest's version, status or fingerprint is wrong")
    if set(found["tables"]) - {QUALITY} != set(TABLES) or not SAFE_ID.fullmatch(str(found.get("load_id"))):
        raise PackageError("the package doesn't hold exactly the exported tables, or its load id isn't safe")
    for name, wanted in found["tables"].items():
        if _checksum(folder / name) != wanted["sha256"]:
            raise PackageError(f"{name}: checksum")
        now = _totals(read_table(spark, folder, name))
        if now["rows"] != wanted["rows"] or Decimal(now["total_eur"] or 0) != Decimal(wanted["total_eur"] or 0):
            raise PackageError(f"{name}: row count or total")
    return found


_KINDS = {"date": "date", "money": expr.MONEY, "volume": expr.MONEY, "distance": expr.MONEY, "days": "int", "places": "int"}


def _staged(frame: DataFrame, name: str) -> DataFrame:
    kinds = {f: _KINDS.get(k, "string") for f, k in (DATASETS[name].fields.items() if name in DATASETS else ())}
    kinds |= {"failed_row_count": "long", "affected_financial_amount_eur": expr.MONEY, "execution_timestamp": "timestamp", "latest_successful_refresh_timestamp": "timestamp"}
    kinds |= {"fx_rate_to_eur": expr.RATE, "amount_eur": expr.MONEY, "amount_at_comparison_rate_eur": expr.MONEY}
    return frame.select(*[F.col(c).cast(kinds.get(c, "string")).alias(c) for c in frame.columns])


def expectations(found: dict) -> dict[str, str]:
    """What the controls must find, by the manifest's own counts and totals."""
    rows, eur = (lambda n: str(found["tables"][n]["rows"])), (lambda n: Decimal(found["tables"][n]["total_eur"] or 0))
    out = {"invoice_count": rows("invoices"), "operational_cost_count": rows("operational_costs"), "revenue_eur": str(eur("invoices")), "operational_cost_eur": str(eur("operational_costs")), "budget_eur": str(eur("budgets"))}
    out["gross_profit_eur"] = str(eur("invoices") - eur("operational_costs"))
    return out | dict.fromkeys(("duplicate_invoice_ids", "duplicate_cost_ids", "duplicate_shipment_ids"), "0")


def migrate(spark: SparkSession, root: str | Path) -> list[str]:
    """Applies the migrations that the store lacks, in order; their names."""
    store = Store(spark, root)
    state = store.state()
    applied = state.setdefault("migrations", {})
    todo = serving.pending_migrations(applied)
    for name, checksum, tables in todo:
        for table, schema in tables.items():
            if table not in state["tables"]:
                store.stage(state, table, ALL, spark.createDataFrame([], schema), [schema.split(" ")[0]])
        applied[name] = checksum
    if todo:
        store.commit(state)
    return [name for name, _, _ in todo]


def _run_row(spark: SparkSession, found: dict, status: str, began: datetime, error: str | None) -> DataFrame:
    return spark.createDataFrame([(found["load_id"], found["contract_version"], found["fingerprint"], status, began, datetime.now(UTC), error)], serving.LOAD_RUN)


def _put_fact(store: Store, state: dict, name: str, frame: DataFrame) -> None:
    """Merges a fact as the package has it: rows that it lacks go. Where its keys aren't unique there is no merge; then all rows
    are laid down for the controls, which refuse them."""
    try:
        buckets.merge_into(store, state, name, frame, FACT_KEYS[name], delete=True)
    except buckets.MergeError:
        state["tables"].pop(name, None)
        store.stage(state, name, ALL, frame, FACT_KEYS[name])


def load_package(spark: SparkSession, root: str | Path, folder: str | Path, expected: dict[str, str] | None = None, healthy_batch: str | None = None) -> str:
    """LOADED, or UNCHANGED if this package is what the serving store holds. Controls (by default against the manifest) gate
    the load: if one fails, the run and its results are recorded and nothing else changes."""
    began = datetime.now(UTC)
    found = validate_package(spark, folder)
    migrate(spark, root)
    store = Store(spark, root)
    state = store.state()
    if state["batches"].get("package", {}).get("fingerprint") == found["fingerprint"]:
        return "UNCHANGED"
    load = found["load_id"]
    if load in state["tables"]["load_run"] and store.read(state, "load_run", among=[load]).first()["status"] == "SUCCEEDED":
        raise PackageError(f"{load} was loaded already, from another package")
    names = [n for n in (*TABLES, QUALITY) if n in found["tables"]]
    staged = {n: _staged(read_table(spark, Path(folder), n), n) for n in names}
    silver = {n: staged[n] for n in TABLES}
    first = silver["invoices"].select(F.col("invoice_date").alias("rate_date"), "currency_code", F.col("fx_rate_to_eur").alias("rate_to_eur"))
    held = {f"dim_{n}": store.read(state, f"dim_{n}") for n in ("country", "currency", "customer", "cost_center", "route", "date")} if "dim_country" in state["tables"] else {}
    built = star.build(silver | {"exchange_rates": first.limit(0)}, held)
    compared = silver["invoices"].select("invoice_id", F.col("amount_at_comparison_rate_eur").alias("_at"))
    built["fact_invoice"] = built["fact_invoice"].join(compared, "invoice_id").withColumn("amount_at_comparison_rate_eur", F.coalesce("_at", "amount_eur")).drop("_at")
    if QUALITY in staged:
        before = store.read(state, "fact_data_quality_result") if "fact_data_quality_result" in state["tables"] else None
        built["fact_data_quality_result"] = serving.fact_data_quality(staged[QUALITY], before)
    new = copy.deepcopy(state)

    def keys(name: str, frame: DataFrame) -> list[str]:
        if name == "fact_data_quality_result":
            return ["source_batch_id", *QUALITY_KEY[1:]]
        return [frame.columns[0]] if name.startswith("fact_") else [next(c for c in frame.columns if c.endswith("_key"))]

    # Facts are merged: buckets whose rows are what they were keep their files. Everything else is small and written anew.
    merges = {n: f for n, f in built.items() if n in FACT_KEYS}
    rest = {n: f for n, f in built.items() if n not in merges}
    back = dict(zip(rest, store.stage_all(new, [(name, ALL, frame, keys(name, frame)) for name, frame in rest.items()]), strict=True))
    with ThreadPoolExecutor(len(merges)) as pool:
        list(pool.map(lambda n: _put_fact(store, new, n, merges[n]), merges))
    back |= {n: store.read(new, n) for n in merges}
    controls = serving.results(load, star.controls(back, expected or expectations(found), healthy_batch), began.strftime("%Y-%m-%d %H:%M:%S"))
    failed = serving.gate(controls) != "SUCCEEDED"
    out = copy.deepcopy(state) if failed else new
    checked = store.stage(out, "reconciliation_result", load, controls, ["load_id", "control_name"])
    bad = sorted(r["control_name"] for r in checked.where("status = 'FAIL'").collect())
    error = f"FAILED_RECONCILIATION: {', '.join(bad)}" if failed else None
    store.stage(out, "load_run", load, _run_row(spark, found, "FAILED" if failed else "SUCCEEDED", began, error), ["load_id"])
    if failed:
        store.commit(out)
        raise PackageError(f"controls failed: {', '.join(bad)}")
    digests = {n: found["tables"][n]["sha256"] for n in names}
    store.stage(out, "load_item", load, serving.load_items(load, staged, back, digests), ["load_id", "source_table"])
    arrival = state["batches"].get("package", {}).get("arrival", 0) + 1
    out["batches"]["package"] = {"arrival": arrival, "fingerprint": found["fingerprint"], "load_id": load}
    out["watermark"] = found["exported_at"]
    store.commit(out)
    return "LOADED"


def serving_tables(spark: SparkSession, root: str | Path) -> dict[str, DataFrame]:
    """All tables of a serving store."""
    store = Store(spark, root)
    state = store.state()
    return {n: store.read(state, n) for n in state["tables"]}


def smoke(spark: SparkSession, root: str | Path) -> dict[str, int]:
    """Rows of every reporting view, which are registered for import, too."""
    tables = serving_tables(spark, root)
    serving.register(tables)
    return serving.smoke(tables)
