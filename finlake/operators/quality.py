"""Quality results per rule and dataset, from reasons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.contracts import COVERAGE, NONCRITICAL, REASON_TO_RULE
from finlake.functions import expr


def rule_of(reason) -> F.Column:
    return F.create_map(*[F.lit(x) for pair in REASON_TO_RULE.items() for x in pair])[reason]


def failures(frame: DataFrame, dataset: str) -> DataFrame:
    """(affected_dataset, amount_eur, rule_name, reasons): one row per row and rule that it fails. `frame` has `_reasons`."""
    amount = F.col("amount_eur") if "amount_eur" in frame.columns else F.lit(None)
    rules = F.array_distinct(F.transform("_reasons", rule_of))
    each = F.transform(rules, lambda rule: F.struct(rule.alias("rule_name"), F.filter("_reasons", lambda r: rule_of(r) == rule).alias("reasons")))
    rows = frame.where(F.size("_reasons") > 0).select(F.lit(dataset).alias("affected_dataset"), amount.cast(expr.MONEY).alias("amount_eur"), F.explode(each).alias("x"))
    return rows.select("affected_dataset", "amount_eur", "x.rule_name", "x.reasons")


def by_rule(found: DataFrame) -> DataFrame:
    """Failed rows, their EUR and their reasons per (dataset, rule), in one aggregation. A row with two reasons of a rule
    counts once."""
    return found.groupBy("affected_dataset", "rule_name").agg(
        F.count("*").alias("failed_row_count"),
        F.sum("amount_eur").cast(expr.MONEY).alias("amount"),
        F.concat_ws("|", F.array_sort(F.array_distinct(F.flatten(F.collect_set("reasons"))))).alias("failure_reason"),
    )


def coverage(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(COVERAGE, "rule_name string, affected_dataset string")


def quality_results(spark: SparkSession, checked: dict[str, DataFrame], batch_id: str, at: str, dropped: bool = False) -> DataFrame:
    """The whole rule and dataset grid, passes too. `dropped`: a country fell below its volume, perhaps without rows."""
    found = reduce(DataFrame.unionByName, [failures(f, name) for name, f in checked.items()])
    out = coverage(spark).join(by_rule(found), ["rule_name", "affected_dataset"], "left")
    volume = F.lit(dropped) & (F.col("rule_name") == "INVOICE_COUNTRY_VOLUME")
    fails = (F.coalesce("failed_row_count", F.lit(0)) > 0) | volume
    return out.select(
        "rule_name",
        "affected_dataset",
        F.lit(batch_id).alias("batch_id"),
        F.coalesce("failure_reason", F.when(volume, F.lit("COUNTRY_VOLUME_DROP")).otherwise("")).alias("failure_reason"),
        F.coalesce("failed_row_count", F.lit(0)).cast("long").alias("failed_row_count"),
        F.when(F.col("amount") != 0, F.col("amount")).cast(expr.MONEY).alias("affected_financial_amount_eur"),
        F.to_timestamp(F.lit(at)).alias("execution_timestamp"),
        F.when(fails, "FAIL").otherwise("PASS").alias("validation_status"),
    )


def failed_critical(results: DataFrame) -> list[str]:
    """Names of critical rules that failed; rules are a short fixed list."""
    bad = results.where((F.col("validation_status") == "FAIL") & ~F.col("rule_name").isin(*NONCRITICAL))
    return sorted(r[0] for r in bad.select("rule_name").distinct().collect())
