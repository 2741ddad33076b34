"""Distinct counts that can be added up: sets of integer keys, stored once by fine groups and joined for any coarser grouping.

A set is cut into buckets of 32768 neighbouring keys. A bucket with up to SPARSE of them is a sorted array of places, another
a bitmap of 4 kB, so that many small groups don't each take a bitmap. A hot group is spread over its buckets, and repeated keys
go before any list is made, so no list is longer than a bucket. Rows of several stored aggregates of the same groups may simply
stand side by side: a count joins them.

Defined results: counts are exact, whatever the grouping; null keys aren't counted, and a group that has no other isn't there;
nulls in grouping columns are a group; keys should be dense (surrogate keys), else buckets hold little; an empty table has no groups.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPARSE = 512


def stored(frame: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    """(by..., bucket, places, bitmap): the distinct keys of each group."""
    k = F.col(key).cast("long")
    found = frame.where(k.isNotNull()).select(*by, F.bitmap_bucket_number(k).alias("bucket"), F.bitmap_bit_position(k).cast("int").alias("at")).distinct()
    lists = found.groupBy(*by, "bucket").agg(F.collect_list("at").alias("places"))
    few = lists.where(F.size("places") <= SPARSE).select(*by, "bucket", F.sort_array("places").alias("places"), F.lit(None).cast("binary").alias("bitmap"))
    many = lists.where(F.size("places") > SPARSE).select(*by, "bucket", F.explode("places").alias("at"))
    many = many.groupBy(*by, "bucket").agg(F.bitmap_construct_agg("at").alias("bitmap"))
    return few.unionByName(many.select(*by, "bucket", F.lit(None).cast("array<int>").alias("places"), "bitmap"))


def counted(held: DataFrame, by: Sequence[str] = (), name: str = "n") -> DataFrame:
    """Distinct keys by some of the columns that `held` was stored by; without any, one row."""
    few = held.where(F.col("places").isNotNull()).select(*by, "bucket", F.explode("places").alias("at")).distinct()
    many = held.where(F.col("bitmap").isNotNull()).groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    # Places get a bitmap of 4 kB only where their group and bucket have one already; others are counted as they are.
    dense = many.select(*[F.col(c).alias(f"_{c}") for c in (*by, "bucket")], F.lit(True).alias("_dense"))
    few = few.join(dense, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*by, "bucket")]), "left")
    more = few.where("_dense").groupBy(*by, "bucket").agg(F.bitmap_construct_agg("at").alias("bitmap"))
    sets = many.unionByName(more).groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    alone = few.where(F.col("_dense").isNull()).groupBy(*by).agg(F.count("*").alias(name))
    found = sets.select(*by, F.bitmap_count("bitmap").alias(name)).unionByName(alone)
    count = F.coalesce(F.sum(name), F.lit(0)).alias(name)
    return found.groupBy(*by).agg(count) if by else found.agg(count)
