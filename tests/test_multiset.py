"""Digests of sets, the tree over a table's buckets, and what of two tables differs."""

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from finlake.operators import evidence, multiset
from finlake.plans import buckets
from finlake.plans.store import Store

FORM = "k long, v string, w long"


def digest_of(row):
    once = hashlib.sha256("".join("n;" if x is None else f"{len(str(x))}:{x};" for x in row).encode()).hexdigest()
    return "".join(hashlib.sha256(f"{once}{i}".encode()).hexdigest() for i in range(multiset.WIDTH // 64))


def total_of(rows):
    """Lane by lane over Python's numbers."""
    lanes = [0] * multiset.LANES
    for row, times in rows:
        d = digest_of(row)
        lanes = [(x + times * int(d[16 * i : 16 * i + 16], 16)) % (1 << 64) for i, x in enumerate(lanes)]
    return "".join(f"{x:016x}" for x in lanes)


def made(n, seed=1):
    rng = random.Random(seed)
    return [(i if i % 29 else None, rng.choice(["", None, "é", "a;1:", "x" * 50]), rng.choice([None, -1, 2**63 - 1])) for i in range(n)]


def frame_of(spark, rows, parts=3):
    return spark.createDataFrame(rows, FORM).repartition(parts)


def test_totals_against_brute_force(spark):
    rows = made(90) + made(12)
    digest = multiset.row_digest(F.col("k"), F.col("v"), F.col("w"))
    whole = frame_of(spark, rows).select(digest.alias("d"))
    got = whole.agg(multiset.total(F.col("d")).alias("d")).first()["d"]
    assert got == total_of((r, 1) for r in rows) and len(got) == multiset.WIDTH
    assert whole.repartition(7).orderBy(F.desc("d")).agg(multiset.total(F.col("d")).alias("d")).first()["d"] == got
    parts = frame_of(spark, rows).select((F.col("w") > 0).alias("p"), digest.alias("d")).groupBy("p").agg(multiset.total(F.col("d")).alias("d"))
    assert parts.count() == 3 and parts.agg(multiset.total(F.col("d")).alias("d")).first()["d"] == got
    signed = frame_of(spark, rows[:40]).select(F.lit(-1).alias("s"), digest.alias("d")).unionByName(whole.select(F.lit(1).alias("s"), "d"))
    assert signed.agg(multiset.total(F.col("d"), F.col("s")).alias("d")).first()["d"] == total_of((r, 1) for r in rows[40:])
    only = frame_of(spark, rows[:40]).select(digest.alias("d"))
    assert only.agg(multiset.total(F.col("d"), F.lit(-1)).alias("d")).first()["d"] == total_of((r, -1) for r in rows[:40])
    assert whole.limit(0).agg(multiset.total(F.col("d")).alias("d")).first()["d"] == "0" * multiset.WIDTH


@pytest.mark.parametrize("n", [1, 16, 300])
def test_trees_name_what_differs(spark, n):
    """Changed, lost, new and repeated rows, null keys, and the order of rows, by trees of one to three levels."""
    rows = made(120)
    other = [r for i, r in enumerate(rows) if i != 11] + [(900, "new", 1), rows[30], (None, "more", None)]
    other[50] = (other[50][0], "changed", 0)
    a, b = frame_of(spark, rows), frame_of(spark, other, 5)
    trees = [multiset.tree(multiset.leaves(x, ["k"], n), n).cache() for x in (a, b)]
    tops = [t.where(F.col("level") == multiset.depth(n)).collect() for t in trees]
    assert [len(t) for t in tops] == [1, 1] and tops[0][0]["digest"] != tops[1][0]["digest"] and [t[0]["rows"] for t in tops] == [len(rows), len(other)]
    again = multiset.tree(multiset.leaves(a.repartition(2).orderBy("w"), ["k"], n), n)
    assert sorted(again.collect()) == sorted(trees[0].collect())
    assert multiset.differing(trees[0], again, n).count() == 0
    by_key = [collections.Counter(x) for x in (rows, other)]
    off = {r[0] for r in (by_key[0] - by_key[1]) + (by_key[1] - by_key[0])}
    bucket = {r["k"]: r["b"] for r in a.unionByName(b).select("k", buckets.bucket_of(["k"], n).alias("b")).collect()}
    near = multiset.differing(*trees, n)
    assert {r["node"] for r in near.collect()} == {bucket[k] for k in off}
    keys = [{r[0] for r in x} for x in (rows, other)]
    wanted = {k: "missing" if k not in keys[1] else "added" if k not in keys[0] else "changed" for k in off}
    assert {r["k"]: r["what"] for r in multiset.altered(a, b, ["k"], n, near).collect()} == wanted and {"missing", "added", "changed"} == set(wanted.values())
    empty = multiset.tree(multiset.leaves(a.limit(0), ["k"], n), n)
    assert empty.count() == 0 and {r["node"] for r in multiset.differing(trees[0], empty, n).collect()} == set(bucket[r[0]] for r in rows)


def test_one_altered_row_is_found_in_its_bucket_alone(spark, tmp_path):
    """Two stores hold a table; one row of the copy differs. The other buckets' files are gone, so nothing reads them."""
    rows = [(i, f"v{i}", i) for i in range(200)]
    stores = [Store(spark, tmp_path / x) for x in ("a", "b")]
    states = [{"version": 0, "tables": {}, "batches": {}, "watermark": None} for _ in stores]
    for store, state, change in zip(stores, states, (None, 77), strict=True):
        buckets.stage(store, state, "t", frame_of(spark, [(k, "other" if k == change else v, w) for k, v, w in rows]), ["k"], 16, range(16))
    near = buckets.differing("t", *states)
    assert len(near) == 1
    for store, state in zip(stores, states, strict=True):
        for part, held in state["tables"]["t"].items():
            if buckets.is_bucket(part) and part != buckets.name_of(near[0]):
                for name in list((tmp_path / store.root.rsplit("/", 1)[1] / held["path"]).iterdir()):
                    name.unlink()
    found = buckets.altered(stores[0], states[0], states[1], "t", ["k"], stores[1]).collect()
    assert [(r["k"], r["what"]) for r in found] == [(77, "changed")]
    assert buckets.differing("t", states[0], states[0]) == []


def test_records_of_before_hold_and_digests_are_compared(spark, tmp_path):
    """A record without the set's digest is held against what it has; one with another digest is seen, though its sums agree."""
    store, state = Store(spark, tmp_path / "s"), {"version": 0, "tables": {}, "batches": {}, "watermark": None}
    rows = frame_of(spark, [(i, "v", 1) for i in range(50)])
    store.stage(state, "p", "d1", rows, ["k"])
    buckets.stage(store, state, "t", rows, ["k"], 4, range(4))
    assert len(state["tables"]["p"]["d1"]["set_digest"]) == multiset.WIDTH
    assert store.verify(state, "d1") == [] and buckets.verify(store, state, "t", None) == []
    one = buckets.name_of(2)
    kept = state["tables"]["p"]["d1"].pop("set_digest"), state["tables"]["t"][one].pop("set_digest")
    assert store.verify(state, "d1") == [] and buckets.verify(store, state, "t", None) == []
    state["tables"]["p"]["d1"]["set_digest"], state["tables"]["t"][one]["set_digest"] = kept[0][::-1], kept[1][::-1]
    assert store.verify(state, "d1") == ["p"] and buckets.verify(store, state, "t", None) == [one]
    assert evidence.attest(rows, ["k"]).columns == ["rows", "row_digest", "key_digest"]


def test_attestations_add_digests_up_as_arrays(spark):
    """Taken apart digit by digit in the plan, a row's 34 numbers cost more than its hashes (claims_incremental)."""
    rows = made(300)
    frame = frame_of(spark, rows).withColumn("_bucket", F.when(F.col("k") % 3 > 0, F.col("k") % 3)).withColumn("amount_eur", F.col("k").cast("decimal(20,2)"))
    frame = frame.select("amount_eur", "k", "v", "w", "_bucket")
    of = lambda r: None if r[0] is None or r[0] % 3 == 0 else r[0] % 3
    text = lambda r: (None if r[0] is None else f"{r[0]}.00", *r)
    found = evidence.attest(frame, ["k"], by=["_bucket"], euros=True, lanes=True)
    assert "conv(" not in found._jdf.queryExecution().executedPlan().toString()
    old = {r["_bucket"]: r.asDict() for r in evidence.attest(frame, ["k"], by=["_bucket"], euros=True).collect()}
    for r in found.collect():
        mine = [x for x in rows if of(x) == r["_bucket"]]
        assert r["set_digest"] == total_of((text(x), 1) for x in mine) and r["rows"] == len(mine)
        assert {c: r[c] for c in old[r["_bucket"]]} == old.pop(r["_bucket"])
    assert not old
    none = evidence.attest(frame.drop("_bucket").limit(0), ["k"], lanes=True).collect()
    assert [tuple(r) for r in none] == [(0, "0", "0", "0" * multiset.WIDTH, "0.00")]
