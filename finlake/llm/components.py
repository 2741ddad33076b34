"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import cut, forget


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """Every node u ties its larger (large) or its not larger neighbours to the least of its neighbourhood. The pairs
    before go."""
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least")))
    out = both.join(least, "a")
    if large:
        out = out.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        out = out.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(least.select("a", F.col("least").alias("b")))
    out = cut(out.where("a != b").distinct())
    forget(pairs, least)
    return out


def components(pairs: DataFrame) -> DataFrame:
    """(node, label) for every node of the (a, b) pairs; label is the least node that it reaches."""
    pairs = cut(pairs.select("a", "b").where("a != b").distinct())
    state = None
    while True:
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            break
        state = now
        pairs = _star(_star(pairs, True), False)
    labels = pairs.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels.unionByName(pairs.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
