"""Tables of a store in hash buckets of their key, changed by copying the buckets that a change touches.

A bucket is a part of its own, so an untouched one keeps its files, its record and its attestation; what a change reads and
writes are the buckets that it touches, all in one write. How many buckets a table has is set when it is made: with n buckets
a change of k keys touches k of n at most, so choose n well over the keys of a usual change.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from finlake.operators import merge, multiset
from finlake.operators.evidence import attest, is_recorded
from finlake.plans.store import Store

#: Buckets of a table for which its first change names no other number; stores of many deliveries take more.
BUCKETS = 16
#: The part that gives a table its schema while no bucket has rows.
EMPTY = "empty"
#: Actions of a merge, in the order of its counts.
ACTIONS = ("updated", "inserted", "deleted", "unchanged")


class MergeError(ValueError):
    """A merge whose result isn't defined."""


def bucket_of(keys: Sequence[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(n)).cast("int")


def name_of(bucket: int) -> str:
    return f"bucket-{bucket:05d}"


def is_bucket(part: str) -> bool:
    return part.startswith("bucket-")


def buckets_in(frame: DataFrame, keys: Sequence[str], n: int) -> set[int]:
    """The buckets that `frame` has rows in; n numbers at most."""
    return {r["b"] for r in frame.select(bucket_of(keys, n).alias("b")).distinct().collect()}


def stage(store: Store, state: dict, table: str, frame: DataFrame, by: Sequence[str], n: int, touched: Iterable[int], keys: Sequence[str] | None = None, rebalanced: bool = True) -> None:
    """Puts `frame`, all rows of the buckets `touched` by columns `by`, in their place (in `state`, not yet published). One
    write and one aggregation for all of them; rows are told apart by `keys`. Without `rebalanced` nothing is shuffled, but each task
    writes a file for each bucket that it has rows of."""
    stage_apart(store, state, frame, {table: (F.lit(True), frame.columns, list(keys or by))}, by, n, touched, rebalanced)


def stage_apart(store: Store, state: dict, frame: DataFrame, tables: dict[str, tuple[Column, Sequence[str], list[str]]], by: Sequence[str], n: int, touched: Iterable[int], rebalanced: bool = True) -> None:
    """`stage` for several tables, which hold the rows of `frame` that meet their condition (a row meets one of them), with these columns
    and keys: `frame` is computed once and written once."""
    touched = sorted(set(touched))
    for table, (_, columns, keys) in tables.items():
        held = state["tables"].setdefault(table, {})
        if EMPTY not in held:
            store.stage(state, table, EMPTY, frame.select(*columns).limit(0), keys)
    if not touched:
        return
    path = f"parts/{next(iter(tables))}/buckets-{uuid.uuid4().hex}"
    of = reduce(lambda then, t: then.when(tables[t][0], t), tables, F)
    rows = frame.withColumns({"_table": of, "_bucket": bucket_of(by, n)}).where("_table IS NOT NULL")
    # Rebalanced by bucket: a large bucket is written by several tasks, small ones share a task.
    rows = rows.hint("rebalance", F.col("_bucket")) if rebalanced else rows
    rows.write.partitionBy("_table", "_bucket").parquet(store.at(path))
    for table, (_, columns, keys) in tables.items():
        _record(store, state, table, f"{path}/_table={table}", frame.select(*columns).schema, by, n, touched, keys)


def _record(store: Store, state: dict, table: str, path: str, fields: StructType, by: Sequence[str], n: int, touched: list[int], keys: list[str]) -> None:
    """Records the buckets of a table that lie in a folder, with their attestations as read back."""
    held, found, schema = state["tables"][table], {}, json.loads(fields.json())
    if store.exists(path):  # a table of which no row was written has no folder
        back = store.spark.read.option("basePath", store.at(path)).schema(StructType([*fields.fields, StructField("_bucket", IntegerType())])).parquet(store.at(path))
        found = {r["_bucket"]: r.asDict() for r in attest(back, keys, by=["_bucket"], euros=True, lanes=True).collect()}
    for k in touched:
        held.pop(name_of(k), None)
        if k in found:
            at = f"{path}/_bucket={k}"
            held[name_of(k)] = {"path": at, "files": store.files.listing(store.at(at)), "schema": schema, "keys": keys, "by": list(by), "n": n, **{c: v for c, v in found[k].items() if c != "_bucket"}}


def read(store: Store, state: dict, table: str, among: Iterable[int] | None = None, like: DataFrame | None = None) -> DataFrame:
    """Rows of some buckets, or of all."""
    parts = None if among is None else [EMPTY, *map(name_of, among)]
    return store.read(state, table, among=parts, like=like)


def others(state: dict, table: str) -> list[str]:
    """Parts of a table that were written before it had buckets."""
    return [p for p in state["tables"].get(table, {}) if not is_bucket(p) and p != EMPTY]


def verify(store: Store, state: dict, table: str, rows_of: Iterable[int] | None = ()) -> list[str]:
    """Buckets of a table that aren't what was recorded: by files, and those in `rows_of` (None: all) by their rows, too, of all
    of them in one pass."""
    held = {p: v for p, v in state["tables"].get(table, {}).items() if is_bucket(p)}
    wrong = {p for p in held if store.verify_part(state, table, p, False)}
    asked = sorted(held if rows_of is None else set(map(name_of, rows_of)) & set(held))
    if asked and not wrong:
        by, n, keys = (held[asked[0]][c] for c in ("by", "n", "keys"))
        frame = store.read(state, table, among=asked).withColumn("_bucket", bucket_of(by, n))
        now = store.attempt(lambda: {name_of(r["_bucket"]): r for r in attest(frame, keys, by=["_bucket"], lanes=True).collect()})
        if now is None:
            return asked
        wrong = {p for p in asked if p not in now or not is_recorded(now[p], held[p])} | (set(now) - set(asked))
    return sorted(wrong)


def differing(table: str, one: dict, other: dict) -> list[int]:
    """Buckets in which a table of two states differs, by their records alone."""
    a, b = ({p: (v["rows"], v.get("set_digest"), v["n"]) for p, v in s["tables"].get(table, {}).items() if is_bucket(p)} for s in (one, other))
    return sorted(int(p[-5:]) for p in a.keys() | b.keys() if a.get(p) != b.get(p) or a[p][1] is None)


def altered(store: Store, one: dict, other: dict, table: str, keys: Sequence[str], other_store: Store | None = None) -> DataFrame:
    """Which keys of a table differ between two states (versions, or copies in two stores), and how; see `multiset.altered`. Only
    buckets whose records differ are read. Both must lie in the same number of buckets."""
    near = differing(table, one, other)
    sides = [read(s, state, table, near) for s, state in ((store, one), (other_store or store, other))]
    if len(found := {v["n"] for s in (one, other) for v in s["tables"][table].values() if "n" in v}) > 1:
        raise ValueError(f"{table}: the two lie in other numbers of buckets: {sorted(found)}")
    n = max(found, default=1)
    by = next((v["by"] for s in (one, other) for v in s["tables"][table].values() if "by" in v), list(keys))
    where = store.spark.createDataFrame([(k,) for k in near], "node int")
    return multiset.altered(*sides, keys, n, where, by)


def merge_into(store: Store, state: dict, table: str, source: DataFrame, key: Sequence[str], n: int = BUCKETS, delete: Column | bool = False) -> dict[str, int]:
    """Merges `source` into a table by `key`: rows of equal key are replaced where they differ, new ones inserted, and those that
    `source` lacks deleted if `delete` says so (True: all; a condition: those that meet it). How many rows had which action. `n` is for a
    table without buckets.

    Touched buckets are found without reading rows that stay: a bucket whose source rows have the digest that is recorded for
    it holds them already; with deletion only by condition, its columns are read. Keys must be unique in `source` and not null."""
    source = source.persist()  # read several times here, and by nobody else
    try:
        return _merged_into(store, state, table, source, list(key), n, delete)
    finally:
        source.unpersist()


def _merged_into(store: Store, state: dict, table: str, source: DataFrame, key: list[str], n: int, delete: Column | bool) -> dict[str, int]:
    of_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    if not source.groupBy(*key).agg(F.count("*").alias("_n")).where((F.col("_n") > 1) | of_key).isEmpty():
        raise MergeError(f"{table}: the source has a key twice, or a null in a key")
    n = next((p["n"] for p in state["tables"].get(table, {}).values() if "n" in p), n)
    older = others(state, table)
    held = state["tables"].get(table, {})
    target = read(store, state, table, like=source).select(*source.columns)
    now = {r["_bucket"]: r for r in attest(source.withColumn("_bucket", bucket_of(key, n)), key, by=["_bucket"], lanes=True).collect()}
    same = {k for k, r in now.items() if (p := held.get(name_of(k))) and is_recorded(r, p)}
    if older:
        touched, same = set(range(n)), set()
    elif delete is True:
        touched = (set(now) | {int(p[-5:]) for p in held if is_bucket(p)}) - same
    else:
        touched = set(now) - same
        if delete is not False:
            touched |= buckets_in(target.where(delete), key, n) - same
    kept = sum(p["rows"] for name, p in held.items() if is_bucket(name) and int(name[-5:]) not in touched)
    old = target if older else read(store, state, table, touched, like=source).select(*source.columns)
    mine = source.where(bucket_of(key, n).isin(*touched)) if touched else source.limit(0)
    done = merge.merged(old, mine, key, delete)
    counts = {r["_action"]: r["n"] for r in done.groupBy("_action").agg(F.count("*").alias("n")).collect()} if touched else {}
    stage(store, state, table, done.where("_action <> 'deleted'").drop("_action"), key, n, touched)
    for p in older:
        state["tables"][table].pop(p)
    return {a: counts.get(a, 0) + (kept if a == "unchanged" else 0) for a in ACTIONS}
