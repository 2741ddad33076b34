"""Digests of sets of rows that can't be met on purpose, and the tree that names the bucket in which two tables differ.

A row's digest is LANES numbers of 64 bits, cut from its SHA-256; a set's is their sum, lane by lane, modulo 2^64. So it doesn't
depend on order or partitions, keeps count of repeated rows, and digests of parts are added or subtracted without their rows. One
sum of 64 bits is met by choosing among a few billion rows; LANES of them have to be met at once.

A table's rows lie in n buckets by their key. A bucket's digest is a leaf; each node above has the SHA-256 of up to FAN children. Two
tables with the same root are equal; otherwise only children of differing nodes are looked at, and only rows of differing leaves.

Defined results: null, empty and neighbouring values can't be mixed up; no rows have the digest of zeros, and an empty bucket no
leaf; a group's rows must be fewer than 2^31 (the sum overflows with an error beyond; take more buckets).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DecimalType, LongType, StringType, StructField, StructType

from finlake.functions import expr

if TYPE_CHECKING:
    import pyarrow as pa

#: Numbers of 64 bits in a digest, as so many hex characters; children of a node.
LANES, WIDTH, FAN = 16, 256, 16
_LOW = (1 << 32) - 1


def row_digest(*columns: Column) -> Column:
    """A row's digest: WIDTH hex characters."""
    return F.concat(*lengthened(expr.payload(*columns)))


def lengthened(once: Column) -> list[Column]:
    """The pieces of a row's digest, of the payload of its columns."""
    return [F.sha2(F.concat(once, F.lit(str(i))), 256) for i in range(WIDTH // 64)]


def total(digest: Column, times: Column | None = None) -> Column:
    """An aggregate: the digest of a union of sets, of which each counts `times` (-1: it is taken away; once by default)."""

    def half(at: int) -> Column:
        number = F.conv(F.substring(digest, at, 8), 16, 10).cast("long")
        return F.coalesce(F.sum(number if times is None else number * times), F.lit(0))

    def lane(i: int) -> Column:
        high, low = half(16 * i + 1), half(16 * i + 9)
        carried = (high + F.shiftright(low, 32)).bitwiseAND(F.lit(_LOW))
        return F.concat(*[F.lpad(F.hex(x), 8, "0") for x in (carried, low.bitwiseAND(F.lit(_LOW)))])

    return F.lower(F.concat(*[lane(i) for i in range(LANES)]))


def sums(frame: DataFrame, by: Sequence[str], words: Column, short: Sequence[str], amount: str | None = None) -> DataFrame:
    """Of each group: rows, then for each number of 64 bits whose hex digits `words` has: its sum in decimal digits, named by `short`, and of the
    LANES after these the `digest` that `total` gives; and the sum of `amount` (a decimal or whole number; null where there is none). `total` takes
    digits apart one number at a time, which costs a row more than its hashes, and its many columns cost a plan seconds; here Arrow batches are
    added up as arrays, and only their sums come back. Without `by` there is a row of zeros if there are none."""
    n, kind = len(short) + LANES, frame.schema[amount].dataType if amount else None
    wide = DecimalType(min(38, kind.precision + 10), kind.scale) if isinstance(kind, DecimalType) else DecimalType(38, 2)
    given = frame.select(*by, F.unhex(words).alias("_words"), (F.col(amount) if amount else F.lit(None)).cast(wide).alias("_amount"))
    groups, end = given.select(*by).schema.fields, StructField("amount", wide)
    part = given.mapInArrow(_summed(list(by), n), StructType([*groups, StructField("rows", LongType()), StructField("sums", BinaryType()), end]))
    if not by:
        part = part.unionByName(frame.sparkSession.range(1).select(F.lit(0).cast("long").alias("rows"), F.lit(bytes(16 * n)).alias("sums"), F.lit(None).cast(wide).alias("amount")))
    texts = [StructField(c, StringType()) for c in (*short, "digest")]
    return part.groupBy(*by).applyInArrow(_added(list(by), list(short), n), StructType([*groups, StructField("rows", LongType()), *texts, end]))


def _summed(by: list[str], n: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For each batch and group: rows, the sums of the numbers' high halves and of their low halves, and of the amounts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            if not batch.num_rows:
                continue
            code = np.zeros(batch.num_rows, np.int64)
            for c in by:  # numbered anew after each column, so that codes stay below rows squared
                found = batch.column(c).dictionary_encode(null_encoding="encode")
                code = np.unique(code * len(found.dictionary) + found.indices.to_numpy(), return_inverse=True)[1]
            order = np.argsort(code, kind="stable")
            starts = np.flatnonzero(np.diff(code[order], prepend=-1))
            held = batch.column("_words").cast(pa.binary(8 * n))
            words = np.frombuffer(held.buffers()[1], ">u8", n * len(held), 8 * n * held.offset).reshape(-1, n).astype(np.uint64)[order]
            halves = np.hstack([np.add.reduceat(x, starts, axis=0) for x in (words >> np.uint64(32), words & np.uint64(_LOW))])
            rows, amounts = np.diff(starts, append=len(order)), batch.column("_amount").take(pa.array(order))
            amount = [pc.sum(amounts.slice(a, k)).as_py() for a, k in zip(starts.tolist(), rows.tolist(), strict=True)]
            columns = [*[batch.column(c).take(pa.array(order[starts])) for c in by], pa.array(rows, pa.int64()), pa.array([x.tobytes() for x in halves], pa.binary()), pa.array(amount, amounts.type)]
            yield pa.RecordBatch.from_arrays(columns, names=[*by, "rows", "sums", "amount"])

    return run


def _added(by: list[str], short: list[str], n: int) -> Callable[[pa.Table], pa.Table]:
    """A group's sums, as Python's whole numbers and texts."""

    def run(table: pa.Table) -> pa.Table:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        totals = [0] * 2 * n
        for x in table.column("sums").to_pylist():
            totals = [a + b for a, b in zip(totals, np.frombuffer(x, np.uint64).tolist(), strict=True)]
        numbers = [(high << 32) + low for high, low in zip(totals[:n], totals[n:], strict=True)]
        texts = [*map(str, numbers[: len(short)]), "".join(f"{x % (1 << 64):016x}" for x in numbers[len(short) :])]
        amount = table.column("amount")
        columns = [*[table.column(c).slice(0, 1) for c in by], pa.array([pc.sum(table.column("rows")).as_py()], pa.int64()), *[pa.array([t]) for t in texts], pa.array([pc.sum(amount).as_py()], amount.type)]
        return pa.Table.from_arrays(columns, names=[*by, "rows", *short, "digest", "amount"])

    return run


def leaves(frame: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """node (a bucket of `keys`), rows and digest (the set's) of each bucket that has rows."""
    bucket = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(n)).cast("int")
    each = frame.select(bucket.alias("node"), row_digest(*[F.col(c) for c in sorted(frame.columns)]).alias("digest"))
    return each.groupBy("node").agg(F.count("*").alias("rows"), total(F.col("digest")).alias("digest"))


def depth(n: int) -> int:
    """Levels above the leaves of n buckets; the last has one node."""
    levels, wide = 0, 1
    while wide < n or not levels:
        levels, wide = levels + 1, wide * FAN
    return levels


def tree(found: DataFrame, n: int) -> DataFrame:
    """level (0: leaves), node, rows and digest of all nodes over the leaves `found`. A node's digest covers its children's places,
    rows and digests; a node has FAN children at most, so that none is gathered beyond that."""
    levels = [found.select(F.lit(0).alias("level"), "node", "rows", "digest")]
    for level in range(1, depth(n) + 1):
        child = F.concat_ws(":", F.col("node").cast("string"), F.col("rows").cast("string"), "digest")
        grouped = levels[-1].groupBy(F.floor(F.col("node") / FAN).cast("int").alias("above"))
        up = grouped.agg(F.sum("rows").alias("rows"), F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("node", child.alias("text")))), lambda c: c["text"]), ","), 256).alias("digest"))
        levels.append(up.select(F.lit(level).alias("level"), F.col("above").alias("node"), "rows", "digest"))
    return reduce(DataFrame.unionByName, levels)


def differing(one: DataFrame, other: DataFrame, n: int) -> DataFrame:
    """Leaves (node) that differ between two trees of n buckets, which are best stored by level: from the root down, among
    children of differing nodes only."""
    wrong: DataFrame | None = None
    for level in range(depth(n), -1, -1):
        sides = [t.where(F.col("level") == level).select("node", F.col("rows").alias(f"rows_{i}"), F.col("digest").alias(f"digest_{i}")) for i, t in enumerate((one, other))]
        if wrong is not None:
            above = wrong.select(F.col("node").alias("above"))
            sides = [s.join(above, F.floor(F.col("node") / FAN) == F.col("above"), "left_semi") for s in sides]
        same = F.col("rows_0").eqNullSafe(F.col("rows_1")) & F.col("digest_0").eqNullSafe(F.col("digest_1"))
        wrong = sides[0].join(sides[1], "node", "full").where(~same).select("node")
    return wrong


def altered(one: DataFrame, other: DataFrame, keys: Sequence[str], n: int, where: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """keys and what ('changed', 'missing' from `other`, 'added' by it) of keys whose sets of rows differ, among the buckets
    `where` (node). Rows of other buckets are neither digested nor shuffled; keys may be null and may have several rows. Buckets are `by` other columns where so said."""
    bucket = F.pmod(F.xxhash64(*[F.col(k) for k in by or keys]), F.lit(n)).cast("int")
    columns = [F.col(c) for c in sorted(one.columns)]

    def side(frame: DataFrame, sign: int) -> DataFrame:
        near = frame.withColumn("_node", bucket).join(F.broadcast(where.select(F.col("node").alias("_node"))), "_node", "left_semi")  # n rows at most
        return near.select(*keys, F.lit(sign).alias("_sign"), row_digest(*columns).alias("_digest"))

    both = side(one, 1).unionByName(side(other, -1)).groupBy(*keys)
    count = lambda sign: F.count(F.when(F.col("_sign") == sign, 1))
    sums = both.agg(count(1).alias("_one"), count(-1).alias("_other"), total(F.col("_digest"), F.col("_sign")).alias("_off"))
    what = F.when(F.col("_other") == 0, "missing").when(F.col("_one") == 0, "added").otherwise("changed")
    return sums.where(F.col("_off") != "0" * WIDTH).select(*keys, what.alias("what"))
