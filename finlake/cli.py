"""Command line: generate, run, run-batch, land, silver, gold, correct, export, validate-package, migrate, load, smoke."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from pyspark.sql import SparkSession

from finlake import config, runlog
from finlake.plans import batch
from finlake.plans.store import Store
from finlake.sources import fixtures, package

DEMOS = {"healthy": ["healthy"], "broken": ["duplicate"], "correction": ["correction-initial", "correction-corrected"]}


def session() -> SparkSession:
    return SparkSession.builder.appName("finlake").config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").getOrCreate()


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="finlake", description=__doc__)
    parser.add_argument("--config", type=Path, help="folder of the project's finlake.json")
    sub = parser.add_subparsers(dest="command", required=True)

    def command(name: str, **options: dict) -> None:
        p = sub.add_parser(name)
        for option, settings in options.items():
            p.add_argument(f"--{option.replace('_', '-')}", **settings)

    path, text = {"type": Path, "required": True}, {"required": True}
    for name, more in (("generate", {"seed": {"type": int, "default": 7}}), ("run", {"input": path}), ("correct", {"input": path})):
        command(name, output=path, **more)
        if name != "correct":
            sub.choices[name].add_argument("demo", choices=DEMOS)
    command("run-batch", batch_dir=path, output=path)
    command("land", batch_dir=path, output=path)
    command("silver", batch=text, output=path)
    command("gold", batch=text, output=path)
    command("export", store=path, output=path, load_id=text, exported_at=text)
    command("validate-package", package=path)
    command("migrate", store=path)
    command("load", package=path, store=path, expected={"type": Path, "help": "JSON file of control values"}, healthy_batch={})
    command("smoke", store=path)
    return parser


def main(argv: list[str] | None = None) -> int:
    """0, or 2 where a critical quality rule failed."""
    a = arguments().parse_args(argv)
    log, shown = runlog.to_json(), lambda x: print(json.dumps(x, indent=2, sort_keys=True))
    if a.command == "generate":
        for scenario in DEMOS[a.demo]:
            print(fixtures.generate(a.output / scenario, scenario, a.seed))
        return 0
    settings = config.load_project_config(a.config)
    limits = {"expected": settings.expected_invoices_per_country, "ratio": str(settings.min_volume_ratio)}
    spark, failed = session(), False
    if a.command in ("run", "run-batch"):
        folders = [a.batch_dir] if a.command == "run-batch" else [a.input / s for s in DEMOS[a.demo]]
        for folder in folders:
            summary = batch.process_batch(spark, a.output, folder, **limits)
            log.info("processed", extra={"batch_id": summary["batch_id"], "status": summary["status"]})
            shown(summary)
            failed |= bool(set(summary["failed_rules"]) & (settings.critical_rules | set(batch.RECONCILIATION_RULES)))
    elif a.command == "land":
        shown(batch.land_bronze(spark, a.output, a.batch_dir, **limits))
    elif a.command == "silver":
        shown(batch.build_silver(spark, a.output, a.batch, **limits))
    elif a.command == "gold":
        summary = batch.build_gold_and_validate(spark, a.output, a.batch)
        shown(summary)
        failed = bool(summary["failed_rules"])
    elif a.command == "correct":
        shown(batch.run_correction(spark, a.output, [a.input / s for s in DEMOS["correction"]], **limits))
    elif a.command == "export":
        store = Store(spark, a.store)
        state = store.state()
        shown(package.build_package(batch.silver_tables(store, state), a.output, a.load_id, a.exported_at, results=store.read(state, "quality")))
    elif a.command == "validate-package":
        shown(package.validate_package(spark, a.package))
    elif a.command == "migrate":
        shown(package.migrate(spark, a.store))
    elif a.command == "load":
        expected = json.loads(a.expected.read_text(encoding="utf-8")) if a.expected else None
        print(package.load_package(spark, a.store, a.package, expected, a.healthy_batch))
    else:
        shown(package.smoke(spark, a.store))
    return 2 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
