"""Bloom filters of keys, in bitmap rows: which parts of a table may hold some keys, without reading the parts.

A filter has a power of two of bits, ten or more a key, in rows of 32768 bits; a key sets HASHES of them. A part whose filter
lacks one bit of every asked key holds none of them; of others about one in a hundred answers for a key that it lacks. What
comes of it is the list of parts to read, never the answer itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASHES, BITS_A_KEY, ROW = 4, 10, 1 << 15


def bits_for(keys: Column) -> Column:
    """The bits of a filter of so many keys: a power of two, one row at least."""
    return F.greatest(F.lit(ROW), F.pow(F.lit(2), F.ceil(F.log2(F.greatest(keys * BITS_A_KEY, F.lit(1)))))).cast("long")


def _positions(keys: Sequence[str], bits: Column) -> Column:
    return F.array(*[F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(i)), bits) for i in range(HASHES)])


def filters(frame: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """(by..., bits, slice, bitmap) of the keys in each group `by`; bitmaps are put together before they are shuffled."""
    sizes = frame.groupBy(*by).agg(bits_for(F.count("*")).alias("bits"))
    sized = frame.select(*by, *[k for k in keys if k not in by]).join(sizes, list(by))
    spread = sized.select(*by, "bits", F.explode(_positions(keys, F.col("bits"))).alias("at"))
    return spread.groupBy(*by, "bits", F.floor(F.col("at") / ROW).cast("int").alias("slice")).agg(F.bitmap_construct_agg(F.col("at") % ROW).alias("bitmap"))


def _has(bitmap: Column, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) != 0


def may_hold(held: DataFrame, asked: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The groups `by` of `held` (what `filters` gave) that may hold a key of `asked`."""
    kinds = held.select("bits").distinct()  # powers of two: a few dozen rows at most
    wanted = asked.select(*keys).distinct().select(F.xxhash64(*keys).alias("_key"), *keys)
    spread = wanted.join(kinds, F.lit(True)).select("_key", "bits", F.explode(_positions(keys, F.col("bits"))).alias("at"))
    spread = spread.select("_key", "bits", F.floor(F.col("at") / ROW).cast("int").alias("slice"), (F.col("at") % ROW).alias("at"))
    hits = spread.join(held, ["bits", "slice"]).where(_has(F.col("bitmap"), F.col("at")))
    return hits.groupBy(*by, "_key").agg(F.count("*").alias("n")).where(F.col("n") >= HASHES).select(*by).distinct()
