"""Control tables of the serving store, the quality fact, reporting views by name, migrations and the smoke test."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.functions import expr
from finlake.operators import merge
from finlake.plans import star

LOAD_RUN = "load_id string, contract_version string, source_fingerprint string, status string, started_at timestamp, completed_at timestamp, error_message string"
LOAD_ITEM = "load_id string, source_table string, source_row_count long, source_financial_total decimal(20,2), target_row_count long, target_financial_total decimal(20,2), sha256 string, status string"
RECONCILIATION = "load_id string, control_name string, expected_value decimal(38,2), actual_value decimal(38,2), difference decimal(38,2), status string, checked_at timestamp"
#: Exported table to the star's.
TARGETS = {
    "countries": "dim_country", "currencies": "dim_currency", "customers": "dim_customer", "cost_centers": "dim_cost_center", "routes": "dim_route",
    "shipments": "fact_shipment", "invoices": "fact_invoice", "budgets": "fact_budget", "operational_costs": "fact_operational_cost", "data_quality_results": "fact_data_quality_result",
}
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def quoted(*names: str) -> str:
    """A one- to three-part table name in back quotes; anything but plain identifiers is refused."""
    if not 1 <= len(names) <= 3 or not all(_NAME.fullmatch(n) for n in names):
        raise ValueError(f"no table name: {names}")
    return ".".join(f"`{n}`" for n in names)


def scan(spark: SparkSession, statement: str, **tables: DataFrame) -> DataFrame:
    """The rows of a SQL statement over frames by name."""
    return spark.sql(statement, **{n: f for n, f in tables.items() if quoted(n)})


def row_text(n: Column) -> Column:
    """A row number with zeros before it, eight digits at least."""
    text = n.cast("string")
    return F.when(F.length(text) >= 8, text).otherwise(F.lpad(text, 8, "0"))


def lineage(batch_id: Column) -> Column:
    return F.sha2(batch_id, 256)


def exported_quality(quality: DataFrame) -> DataFrame:
    """Quality results as they are exported: with the latest successful refresh and their lineage."""
    columns = ["batch_id", "affected_dataset", "rule_name", "validation_status", "failure_reason", "failed_row_count", "affected_financial_amount_eur", "execution_timestamp"]
    latest = quality.agg(F.max(F.when(F.col("validation_status") == "PASS", F.col("execution_timestamp"))).alias("latest_successful_refresh_timestamp"))
    return quality.select(*columns).join(F.broadcast(latest), F.lit(True)).withColumn("_source_fingerprint", lineage(F.col("batch_id")))  # one row


def fact_data_quality(exported: DataFrame, held: DataFrame | None = None) -> DataFrame:
    """The quality fact, upserted by batch, dataset and rule."""
    rows = exported.withColumn("execution_date_key", expr.date_key(F.to_date("execution_timestamp"))).withColumnRenamed("_source_fingerprint", "source_fingerprint")
    rows = rows.withColumnsRenamed({"batch_id": "source_batch_id"})
    return rows if held is None else merge.upsert(held, rows, ["source_batch_id", "affected_dataset", "rule_name"])


def totals(frame: DataFrame, name: str) -> DataFrame:
    """One row: name, rows, eur (null where a table has no amounts)."""
    eur = F.sum("amount_eur").cast(expr.MONEY) if "amount_eur" in frame.columns else F.lit(None).cast(expr.MONEY)
    return frame.agg(F.count("*").alias("rows"), eur.alias("eur")).select(F.lit(name).alias("name"), "rows", "eur")


def load_items(load_id: str, sources: dict[str, DataFrame], targets: dict[str, DataFrame], digests: dict[str, str] | None = None) -> DataFrame:
    """The audit of a load: rows and EUR of every exported table, and of what it became."""
    spark = next(iter(sources.values())).sparkSession
    came = reduce(DataFrame.unionByName, [totals(f, n) for n, f in sources.items()])
    became = reduce(DataFrame.unionByName, [totals(targets[TARGETS[n]], n) for n in sources if TARGETS[n] in targets])
    sums = spark.createDataFrame([(n, (digests or {}).get(n)) for n in sources], "name string, sha256 string")
    out = came.join(became.select("name", F.col("rows").alias("target_rows"), F.col("eur").alias("target_eur")), "name", "left").join(sums, "name")
    return out.select(
        F.lit(load_id).alias("load_id"),
        F.col("name").alias("source_table"),
        F.col("rows").alias("source_row_count"),
        F.col("eur").alias("source_financial_total"),
        F.col("target_rows").alias("target_row_count"),
        F.col("target_eur").alias("target_financial_total"),
        "sha256",
        F.when(F.col("target_rows").isNull(), "STAGED").otherwise("PUBLISHED").alias("status"),
    )


def results(load_id: str, controls: DataFrame, at: str) -> DataFrame:
    return controls.select(F.lit(load_id).alias("load_id"), "control_name", "expected_value", "actual_value", "difference", "status", F.to_timestamp(F.lit(at)).alias("checked_at"))


def gate(status: DataFrame) -> str:
    """FAILED_RECONCILIATION if any control failed, else SUCCEEDED."""
    return "SUCCEEDED" if status.where("status = 'FAIL'").isEmpty() else "FAILED_RECONCILIATION"


#: Reporting views over the serving tables: dimensions and facts as they are, and what is built from them.
VIEWS: dict[str, Callable[[dict[str, DataFrame]], DataFrame]] = {
    **{n: (lambda t, n=n: t[n]) for n in ("dim_country", "dim_currency", "dim_customer", "dim_cost_center", "dim_route", "dim_date", "fact_shipment", "fact_invoice", "fact_operational_cost", "fact_budget", "fact_data_quality_result")},
    **star.VIEWS,
    "data_quality_summary": lambda t: t["fact_data_quality_result"].select(F.col("source_batch_id").alias("batch_id"), "affected_dataset", "rule_name", "validation_status", "failure_reason", "failed_row_count", "affected_financial_amount_eur", "execution_timestamp"),
    "refresh_status": lambda t: t["load_run"].select("load_id", "contract_version", "source_fingerprint", "status", "started_at", "completed_at"),
    "reconciliation_status": lambda t: t["reconciliation_result"].select("load_id", "control_name", "expected_value", "actual_value", "difference", "status", "checked_at"),
}


def register(tables: dict[str, DataFrame], prefix: str = "reporting_") -> list[str]:
    """Temporary views for a report's import, of all whose tables are there; their names."""
    made = []
    for name, view in VIEWS.items():
        try:
            frame = view(tables)
        except KeyError:
            continue
        frame.createOrReplaceTempView(prefix + name)
        made.append(prefix + name)
    return made


def smoke(tables: dict[str, DataFrame]) -> dict[str, int]:
    """Rows of every view; a view that can't be computed raises."""
    counts = reduce(DataFrame.unionByName, [v(tables).agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, v in VIEWS.items()])
    return {r["name"]: r["n"] for r in counts.collect()}


#: Ordered migrations: a name and the control tables that it makes sure of.
MIGRATIONS: tuple[tuple[str, dict[str, str]], ...] = (
    ("001_control_tables", {"load_run": LOAD_RUN, "load_item": LOAD_ITEM, "reconciliation_result": RECONCILIATION}),
)


class MigrationError(RuntimeError):
    """A migration that was applied isn't the one that is here."""


def pending_migrations(applied: dict[str, str]) -> list[tuple[str, str, dict[str, str]]]:
    """(name, checksum, tables) of migrations to apply, in order. What was applied must be unchanged, and a prefix."""
    out = []
    for name, tables in MIGRATIONS:
        checksum = hashlib.sha256(json.dumps(tables, sort_keys=True).encode()).hexdigest()
        if name not in applied:
            out.append((name, checksum, tables))
        elif applied[name] != checksum:
            raise MigrationError(f"{name} has changed since it was applied")
        elif out:
            raise MigrationError(f"{name} was applied before {out[0][0]}")
    if unknown := set(applied) - {n for n, _ in MIGRATIONS}:
        raise MigrationError(f"unknown migrations were applied: {', '.join(sorted(unknown))}")
    return out
