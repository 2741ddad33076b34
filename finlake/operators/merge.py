"""Replacing and merging rows by batch and key, as plain relational operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def replace_batch(target: DataFrame, rows: DataFrame, batch_id: str, supersedes: str | None = None) -> DataFrame:
    """`target` without what the batch (and the one that it supersedes) held before, and with `rows`."""
    owners = [b for b in (batch_id, supersedes) if b]
    return target.where(~F.col("_batch_id").isin(*owners)).unionByName(rows)


def upsert(target: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of `rows`, and those of `target` whose key `rows` doesn't have."""
    return target.join(rows.select(*key).distinct(), list(key), "left_anti").select(*target.columns).unionByName(rows.select(*target.columns))


def last_of_key(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy(*key).orderBy(*[F.col(c).desc() for c in order]))
    return rows.withColumn("_nth", nth).where("_nth = 1").drop("_nth")


def append_new(target: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """`target` with the rows whose key it doesn't hold: appending twice is appending once."""
    return target.unionByName(rows.join(target.select(*key).distinct(), list(key), "left_anti").select(*target.columns))


def collisions(target: DataFrame, rows: DataFrame, key: Sequence[str], batch_id: str) -> DataFrame:
    """Keys of `rows` that another batch holds."""
    held = target.where(F.col("_batch_id") != batch_id).select(*key)
    return rows.select(*key).distinct().join(held, list(key), "left_semi")


def replace_reasons(held: DataFrame, new: DataFrame, reasons: Sequence[str]) -> DataFrame:
    """Quarantine without rows that carry one of `reasons`, and with `new`."""
    any_of = F.arrays_overlap(F.split("_reason_codes", r"\|"), F.array(*map(F.lit, reasons)))
    return held.where(~any_of).unionByName(new)


def with_keys(target: DataFrame, rows: DataFrame, natural: str, surrogate: str) -> DataFrame:
    """(natural, surrogate) for all keys: those of `target` as they are, new ones numbered on after the greatest.

    New keys are numbered within hash parts, whose sizes give each part its offset, so no task sees them all."""
    new = rows.select(natural).where(F.col(natural).isNotNull()).distinct().join(target.select(natural), natural, "left_anti")
    part = F.pmod(F.xxhash64(natural), F.lit(256))
    numbered = new.withColumn("_part", part).withColumn("_nth", F.row_number().over(Window.partitionBy("_part").orderBy(natural)))
    sizes = new.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    offsets = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    top = target.agg(F.coalesce(F.max(surrogate), F.lit(0)).alias("_top"))
    made = numbered.join(F.broadcast(offsets), "_part").join(F.broadcast(top), F.lit(True)).select(natural, (F.col("_top") + F.col("_before") + F.col("_nth")).cast("long").alias(surrogate))
    return target.select(natural, F.col(surrogate).cast("long").alias(surrogate)).unionByName(made)


def merged(target: DataFrame, source: DataFrame, key: Sequence[str], delete: Column | bool = False) -> DataFrame:
    """Both tables' rows by `key`, which is unique in each, with `_action`: updated (matched, with other contents), unchanged,
    inserted (not matched), or, for target rows that the source lacks, deleted where `delete` holds (a condition on the target's
    columns) and unchanged elsewhere."""
    rest = [c for c in target.columns if c not in key]
    new = source.select(*key, F.struct(*rest, F.lit(1).alias("_here")).alias("_new"))
    gone = F.lit(delete) if isinstance(delete, bool) else F.coalesce(delete, F.lit(False))
    old = target.select(*key, F.struct(*rest, gone.alias("_gone")).alias("_old"))
    both = old.join(new, list(key), "full")
    same = reduce(lambda a, b: a & b, [F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")) for c in rest], F.lit(True))
    action = (
        F.when(F.col("_old").isNull(), "inserted")
        .when(F.col("_new").isNull(), F.when(F.col("_old._gone"), "deleted").otherwise("unchanged"))
        .when(same, "unchanged")
        .otherwise("updated")
    )
    pick = lambda c: F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c)
    return both.select(*[F.col(c) if c in key else pick(c) for c in target.columns], action.alias("_action"))
