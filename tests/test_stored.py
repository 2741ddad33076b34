"""CSV in ranges, tables in buckets, claims settled where they change, and what a run leaves behind when it dies."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from finlake.operators import membership, merge, ownership
from finlake.plans import batch, buckets, claims, records
from finlake.plans.store import ClaimsIntegrityError, Store
from finlake.sources import csv_ranges, fixtures, package

CELLS = ["", "a", "b,c", 'say "hi"', "line\nbreak", "\n", "\n\n", '"', '""', "é漢", "  sp ", "long " * 9, ",", "two\n\nlines,\n"]


def written(path, rows, end="\n", blank=11):
    out = io.StringIO(newline="")
    w = csv.writer(out, lineterminator=end)
    w.writerow(["c1", "c2", "c3"])
    for i, r in enumerate(rows):
        w.writerow(r)
        if i % blank == 0:
            out.write(end)
    path.write_text(out.getvalue(), encoding="utf-8", newline="")
    return str(path)


@pytest.fixture()
def ranges_of(spark):
    """Sets how many bytes a range has."""

    def put(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield put
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("size", [17, 61, 1 << 20])
def test_ranges_read_what_one_range_does(spark, tmp_path, ranges_of, size):
    """Breaks, quotes and whole cells at the edges of ranges; records over many ranges."""
    rng = random.Random(size)
    rows = [["k" + rng.choice(CELLS), rng.choice(CELLS), rng.choice(CELLS)] for _ in range(25)]
    path = written(tmp_path / "x.csv", rows)
    options = {"header": True, "multiLine": True, "escape": '"', "enforceSchema": False, "mode": "FAILFAST", "nullValue": "\x00", "emptyValue": ""}
    wanted = [tuple(r) for r in spark.read.schema("c1 string, c2 string, c3 string").options(**options).csv(path).collect()]
    ranges_of(size)
    assert csv_ranges.lines(spark, path).select("begins").distinct().count() > (8 if size < 100 else 0)
    got = csv_ranges.read(spark, path, ["c1", "c2", "c3"], numbered="n").orderBy("n").collect()
    assert [r["n"] for r in got] == list(range(1, 26)) and [tuple(r)[:3] for r in got] == wanted
    assert csv_ranges.header(spark, path) == ["c1", "c2", "c3"]


def test_carriage_returns_stay_in_cells_only(spark, tmp_path, ranges_of):
    rows = [["a\r\nb", "x", "last"], ["c", "\r\n", '"q"'], ["d", "", "e\n"]]
    path = written(tmp_path / "x.csv", rows, end="\r\n", blank=2)
    for size in (9, 1000):
        ranges_of(size)
        got = csv_ranges.read(spark, path, ["c1", "c2", "c3"], numbered="n").orderBy("n").collect()
        assert [[c or "" for c in tuple(r)[:3]] for r in got] == rows


def test_a_cell_that_is_never_closed_and_changed_ranges(spark, tmp_path, ranges_of):
    (tmp_path / "bad.csv").write_text('c1\n"a\nb\n')
    with pytest.raises(csv_ranges.CsvError, match="never closed"):
        csv_ranges.records(spark, str(tmp_path / "bad.csv"))
    (tmp_path / "none.csv").write_text("")
    assert csv_ranges.read(spark, str(tmp_path / "none.csv"), ["c1"]).collect() == [] and csv_ranges.header(spark, str(tmp_path / "none.csv")) == []
    path = written(tmp_path / "x.csv", [["a", "b", "c"]] * 40)
    frame = csv_ranges.read(spark, path, ["c1", "c2", "c3"])
    ranges_of(50)
    with pytest.raises(Exception, match="CSV_RANGES_CHANGED"):
        frame.collect()


# Buckets


def fresh():
    return {"version": 0, "tables": {}, "batches": {}, "watermark": None}


ROWS = "k long, j string, v string, amount_eur decimal(20,2)"


def brute_merge(old, new, delete):
    out = {k: r for k, r in old.items() if k in new or not delete(r)}
    return out | new


@pytest.mark.parametrize("delete", [False, True, "v < 'm'"])
def test_merge_against_brute_force(spark, tmp_path, delete):
    rng = random.Random(str(delete))
    store, state, held = Store(spark, tmp_path), fresh(), {}
    gone = {False: lambda r: False, True: lambda r: True}.get(delete, lambda r: r[2] is not None and r[2] < "m")
    for _ in range(3):
        new = {(k, "x"): (k, "x", rng.choice(["a", "q", "z", None]), None) for k in rng.sample(range(40), 12)}
        new |= {key: held[key] for key in rng.sample(sorted(held), min(5, len(held)))}
        wanted = brute_merge(held, new, gone)
        counts = buckets.merge_into(store, state, "t", spark.createDataFrame(list(new.values()), ROWS), ["k", "j"], n=7, delete=F.expr(delete) if isinstance(delete, str) else delete)
        assert {(r["k"], r["j"]): tuple(r) for r in store.read(state, "t").collect()} == wanted
        assert counts == {
            "updated": sum(held.get(k, r) != r for k, r in new.items()),
            "inserted": len(set(new) - set(held)),
            "deleted": len(set(held) - set(wanted)),
            "unchanged": sum(held.get(k) == r for k, r in wanted.items()),
        }
        assert buckets.verify(store, state, "t", None) == []
        held = wanted


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    store, state = Store(spark, tmp_path), fresh()
    rows = [(k, "x", "v", None) for k in range(200)]
    buckets.merge_into(store, state, "t", spark.createDataFrame(rows, ROWS), ["k"], n=32)
    before = {p: v["path"] for p, v in state["tables"]["t"].items()}
    rows[3] = (3, "x", "other", None)
    counts = buckets.merge_into(store, state, "t", spark.createDataFrame(rows, ROWS), ["k"], n=32, delete=True)
    assert counts == {"updated": 1, "inserted": 0, "deleted": 0, "unchanged": 199}
    assert sum(v["path"] != before[p] for p, v in state["tables"]["t"].items()) == 1
    with pytest.raises(buckets.MergeError, match="twice"):
        buckets.merge_into(store, state, "t", spark.createDataFrame(rows[:1] * 2, ROWS), ["k"])
    with pytest.raises(buckets.MergeError, match="null"):
        buckets.merge_into(store, state, "t", spark.createDataFrame([(None, "x", "v", None)], ROWS), ["k"])
    state["tables"]["t"][buckets.name_of(next(k for k in range(32) if buckets.name_of(k) in before))]["row_digest"] = "1"
    assert len(buckets.verify(store, state, "t", None)) == 1 and buckets.verify(store, state, "t") == []


def test_a_table_without_rows_and_one_of_before(spark, tmp_path):
    store, state = Store(spark, tmp_path), fresh()
    none = spark.createDataFrame([], ROWS)
    assert buckets.merge_into(store, state, "t", none, ["k"], delete=True) == dict.fromkeys(buckets.ACTIONS, 0)
    assert store.read(state, "t").collect() == []
    store.stage(state, "old", "_all", spark.createDataFrame([(1, "x", "v", None), (2, "x", "v", None)], ROWS), ["k"])
    counts = buckets.merge_into(store, state, "old", spark.createDataFrame([(2, "x", "w", None)], ROWS), ["k"], delete=True)
    assert counts == {"updated": 1, "inserted": 0, "deleted": 1, "unchanged": 0} and [r["v"] for r in store.read(state, "old").collect()] == ["w"]


def test_merged_rows_say_what_became_of_them(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k long, v string")
    new = spark.createDataFrame([(2, "c"), (3, None), (4, "d")], "k long, v string")
    found = {r["k"]: (r["v"], r["_action"]) for r in merge.merged(old, new, ["k"], F.col("v") == "a").collect()}
    assert found == {1: ("a", "deleted"), 2: ("c", "updated"), 3: (None, "unchanged"), 4: ("d", "inserted")}


# Claims

CLAIM = "invoice_id string, revenue_amount long, amount_eur decimal(20,2), claim_hash string, _batch_id string, _source_row_number int, _reasons array<string>"


def delivered(spark, name, picks):
    rows = [(f"I{i}", v, None, f"h{v}", name, k + 1, None) for k, (i, v) in enumerate(picks)]
    return spark.createDataFrame(rows, CLAIM)


def outcome(store, state):
    trusted = {(r["invoice_id"], r["_batch_id"], r["_source_row_number"]) for r in store.read(state, claims.TRUSTED).collect()}
    away = {(r["invoice_id"], r["_batch_id"], r["_source_row_number"]): r["_reason_codes"] for r in store.read(state, claims.AWAY).collect()}
    return trusted, away


def test_settled_buckets_equal_global_resolution(spark, tmp_path):
    """Deliveries, corrections of them and supersessions at random."""
    rng = random.Random(9)
    store, state, held, arrivals = Store(spark, tmp_path), fresh(), {}, {}
    claims.n_buckets(state, 5)
    for step in range(6):
        again = rng.choice(sorted(held)) if held and step % 3 == 1 else None  # a delivery comes in another version
        replaced = rng.choice(sorted(held)) if held and step % 3 == 2 else None
        name = again or f"d{step}"
        picks = [(rng.randrange(30), rng.choice([1, 1, 1, 2])) for _ in range(8)]
        touched, mine = claims.put(store, state, name, delivered(spark, name, picks), replaced)
        for b in (replaced,) if replaced else ():
            held.pop(b), arrivals.pop(b), state["batches"].pop(b)
        held[name], arrivals[name] = picks, arrivals.get(name, step + 1)
        state["batches"][name] = {"arrival": arrivals[name], "claim_buckets": mine}
        claims.settle(store, state, arrivals, touched)
    every = None
    for b, p in held.items():
        every = delivered(spark, b, p) if every is None else every.unionByName(delivered(spark, b, p))
    wanted = ownership.resolve_claims(claims.with_arrival(every, arrivals)).collect()
    key = lambda r: (r["invoice_id"], r["_batch_id"], r["_source_row_number"])
    trusted, away = outcome(store, state)
    assert trusted == {key(r) for r in wanted if not r["_reasons"]}
    assert away == {key(r): "|".join(r["_reasons"]) for r in wanted if r["_reasons"]}


def test_rows_read_grow_with_the_delivery(spark, tmp_path):
    store, state = Store(spark, tmp_path), fresh()
    claims.n_buckets(state, 40)
    touched, mine = claims.put(store, state, "history", delivered(spark, "history", [(i, 1) for i in range(400)]))
    state["batches"]["history"] = {"arrival": 1, "claim_buckets": mine}
    claims.settle(store, state, {"history": 1}, touched)
    paths = {t: {p: v["path"] for p, v in state["tables"][t].items()} for t in (claims.CLAIMS, claims.TRUSTED)}
    touched, mine = claims.put(store, state, "small", delivered(spark, "small", [(3, 1), (7, 2)]))
    assert touched == mine and len(touched) <= 2
    found = claims.settle(store, state, {"history": 1, "small": 2}, touched)
    assert found.count() < 60  # of 402
    for table, before in paths.items():
        assert sum(v["path"] != before.get(p) for p, v in state["tables"][table].items()) == len(touched)
    trusted, away = outcome(store, state)
    assert len(trusted) == 399 and away == {("I3", "small", 1): "CROSS_BATCH_DUPLICATE_INVOICE", ("I7", "history", 8): "CONFLICTING_DUPLICATE_INVOICE", ("I7", "small", 2): "CONFLICTING_DUPLICATE_INVOICE"}
    part = state["tables"][claims.CLAIMS][buckets.name_of(touched[0])]
    part["row_digest"] = "7"
    with pytest.raises(ClaimsIntegrityError, match="PRIOR_ARTIFACT_INTEGRITY_FAILED: claims"):
        claims.put(store, state, "next", delivered(spark, "next", [(3, 1)]))


def test_claims_of_before_are_laid_out_in_buckets(spark, tmp_path):
    """A store whose claims are parts by delivery, and another number of buckets."""
    store, state = Store(spark, tmp_path), fresh()
    old = delivered(spark, "old", [(1, 1), (2, 1)])
    store.stage(state, claims.CLAIMS, "old", old, claims.CLAIM_KEYS)
    state["batches"]["old"] = {"arrival": 1}
    claims.n_buckets(state, 4)
    touched, mine = claims.put(store, state, "new", delivered(spark, "new", [(2, 1)]))
    assert touched == [0, 1, 2, 3] and "old" not in state["tables"][claims.CLAIMS]
    state["batches"]["new"] = {"arrival": 2, "claim_buckets": mine}
    claims.settle(store, state, {"old": 1, "new": 2}, touched)
    before = outcome(store, state)
    assert before[0] == {("I1", "old", 1), ("I2", "old", 2)}
    store.commit(state)
    claims.rebucket(spark, str(tmp_path), 3)
    again = store.state()
    assert outcome(store, again) == before and again["claim_buckets"] == 3 and buckets.verify(store, again, claims.CLAIMS, None) == []


# Runs that die late, and other thresholds


@pytest.fixture(scope="module")
def died(spark, tmp_path_factory):
    """A store whose run died between its commit and its last clearing up."""
    base = tmp_path_factory.mktemp("died")
    folder = fixtures.generate(base / "in", months=1, per_month=2)

    def stop(step):
        if step == "committed":
            raise RuntimeError("died")

    with pytest.raises(RuntimeError, match="died"):
        batch.process_batch(spark, base / "root", folder, expected=2, at_step=stop)
    return base / "root", folder


def test_a_run_that_died_after_its_commit(spark, died):
    root, folder = died
    store = Store(spark, root)
    assert store.inflight() is not None and store.exists("pending", "demo-healthy.json")
    assert batch.process_batch(spark, root, folder, expected=2)["status"] == "already_processed"
    assert store.inflight() is None and not store.exists("pending", "demo-healthy.json")
    assert batch.land_bronze(spark, root, folder, expected=2, ratio="0.5")["status"] == "already_processed"
    # Another threshold is another run.
    assert batch.land_bronze(spark, root, folder, expected=2, ratio="0.1")["status"] == "landed"


def test_a_second_package_changes_only_what_it_must(spark, died, tmp_path):
    store, serving_root = Store(spark, died[0]), tmp_path / "serving"
    silver = batch.silver_tables(store, store.state())
    package.build_package(silver, tmp_path / "p1", "load-1", "2026-01-06T00:00:00Z")
    assert package.load_package(spark, serving_root, tmp_path / "p1") == "LOADED"
    one = silver["operational_costs"].select(F.min("cost_id")).first()[0]
    silver["operational_costs"] = silver["operational_costs"].withColumn("amount_eur", F.when(F.col("cost_id") == one, F.col("amount_eur") + 1).otherwise(F.col("amount_eur")).cast("decimal(20,2)"))
    silver["budgets"] = silver["budgets"].orderBy("cost_center_id").limit(silver["budgets"].count() - 1)
    package.build_package(silver, tmp_path / "p2", "load-2", "2026-01-07T00:00:00Z")
    held = Store(spark, serving_root)
    before = held.state()["tables"]
    assert package.load_package(spark, serving_root, tmp_path / "p2") == "LOADED"
    after = held.state()["tables"]
    moved = {n: {p for p in {*before[n], *after[n]} if before[n].get(p, {}).get("path") != after[n].get(p, {}).get("path")} for n in package.FACT_KEYS}
    assert {n: len(v) for n, v in moved.items()} == {"fact_shipment": 0, "fact_invoice": 0, "fact_operational_cost": 1, "fact_budget": 1}
    assert held.read(held.state(), "fact_budget").count() == silver["budgets"].count()
    # A package whose keys aren't unique is refused by the controls, and nothing changes.
    silver["invoices"] = silver["invoices"].unionByName(silver["invoices"])
    package.build_package(silver, tmp_path / "p3", "load-3", "2026-01-08T00:00:00Z")
    with pytest.raises(package.PackageError, match="duplicate_invoice_ids"):
        package.load_package(spark, serving_root, tmp_path / "p3")
    assert held.state()["tables"]["fact_invoice"] == after["fact_invoice"]


# Which parts a delivery's keys may be in


def test_filters_miss_no_key(spark):
    """Each part answers for every key of its own, and about one in a hundred others."""
    n, size = 30, 300
    held = spark.range(n * size).select((F.col("id") % n).alias("part"), F.concat(F.lit("k"), "id").alias("k"))
    made = membership.filters(held, ["k"], ["part"]).cache()
    assert [r["bits"] for r in made.select("bits").distinct().collect()] == [1 << 15]
    for k in ("k0", "k29", "k8999"):
        assert int(k[1:]) % n in {r["part"] for r in membership.may_hold(made, spark.createDataFrame([(k,)], "k string"), ["k"], ["part"]).collect()}
    one = membership.filters(held.withColumn("part", F.lit(0)).repartition(3), ["k"], ["part"]).cache()
    hits = sum(membership.may_hold(one, spark.createDataFrame([(f"x{i}",)], "k string"), ["k"], ["part"]).count() for i in range(12))
    assert hits <= 2
    assert membership.may_hold(made, spark.createDataFrame([], "k string"), ["k"], ["part"]).collect() == []


def test_only_parts_that_may_hold_a_key_are_read(spark, tmp_path):
    store, state = Store(spark, tmp_path), fresh()

    def shipments(ids):
        return spark.createDataFrame([(f"S{i}",) for i in ids], "shipment_id string")

    for b in range(6):
        frame = shipments(range(100 * b, 100 * b + 50))
        store.stage(state, "silver_shipments", f"b{b}", frame, ["shipment_id"])
        if b:
            store.stage(state, records.TABLE, f"b{b}", records.filters({"shipments": frame}, f"b{b}"), records.KEYS)
    # Parts without a filter, such as an older version's, are always read.
    assert records.parts_to_read(store, state, "new", {"shipments": shipments([9999])}) == {"shipments": ["b0"]}
    assert sorted(records.parts_to_read(store, state, "new", {"shipments": shipments([205, 9999, 410])})["shipments"]) == ["b0", "b2", "b4"]
    assert records.parts_to_read(store, state, "b2", {"shipments": shipments([205])}) == {"shipments": ["b0"]}
