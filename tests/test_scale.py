"""What only larger tables show: sampled bounds, shuffles that grow with the facts."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from finlake.functions import expr
from finlake.operators import bitmaps, gold
from finlake.plans import analogue, buckets, catalogue, claims, star
from finlake.plans.store import Store
from finlake.sources.delivery import numbered


@pytest.fixture
def parts_stay(spark):
    """Small parts aren't put together, as large ones aren't."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "2")


def test_numbers_follow_the_order_in_many_sampled_parts(spark, parts_stay):
    rows = spark.range(40000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), "id")
    found = sorted((r["_source_row_number"], r["k"]) for r in numbered(rows, ["k"]).collect())
    assert [n for n, _ in found] == list(range(1, 40001))
    assert [k for _, k in found] == sorted(k for _, k in found)


@pytest.mark.parametrize("name, scans", [("view_customer", 2), ("view_route", 2), ("view_monthly", 2), ("drillthrough", 1), ("report_trend", 2), ("report_country", 2), ("report_customer_ranked", 2), ("fact_invoice_star", 1)])
def test_each_fact_is_made_once(spark, sf, name, scans):
    plan = catalogue.QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [l_orderkey") == scans


def test_places_without_a_bitmap_are_counted_as_they_are(spark):
    rows = spark.range(70000).select(F.when(F.col("id") % 7 < 5, "dense").when(F.col("id") % 7 == 5, None).otherwise(F.col("id").cast("string")).alias("g"), "id")
    held = bitmaps.stored(rows.withColumn("h", F.col("id") % 2), "id", ["g", "h"])
    for by in (["g"], ["h"], []):
        wanted = rows.withColumn("h", F.col("id") % 2).groupBy(*by).agg(F.countDistinct("id").alias("n"))
        found = bitmaps.counted(held, by)
        assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))
    assert "_dense" in bitmaps.counted(held, ["g"])._jdf.queryExecution().analyzed().toString()


def test_both_tables_of_settled_claims_come_of_one_pass(spark, tmp_path):
    store, state = Store(spark, tmp_path), {"version": 0, "tables": {}, "batches": {}, "watermark": None}
    claims.n_buckets(state, 4)
    rows = spark.range(120).select(
        (F.col("id") % 80).cast("string").alias("invoice_id"),
        F.lit("d").alias("_batch_id"),
        F.col("id").cast("int").alias("_source_row_number"),
        F.when(F.col("id") == 90, "other").otherwise("same").alias("claim_hash"),
        F.lit(None).cast("array<string>").alias("_reasons"),
    )
    touched, _ = claims.put(store, state, "d", rows, rebalanced=False)
    claims.settle(store, state, {"d": 1}, touched)
    folders = {v["path"].split("/_table=")[0] for t in (claims.TRUSTED, claims.AWAY) for v in buckets_of(state, t)}
    assert len(folders) == 1
    assert store.read(state, claims.TRUSTED).count() == 79 and store.read(state, claims.AWAY).count() == 41
    assert "_reason_codes" not in store.read(state, claims.TRUSTED).columns
    plan = claims.resolved(store, state, {"d": 1}, touched)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(") == 1


def buckets_of(state, table):
    return [v for p, v in state["tables"][table].items() if buckets.is_bucket(p)]


def test_facts_carry_their_shipments_without_more_or_fewer_rows(spark):
    ships = spark.createDataFrame([("a", "r1", "c1"), ("b", "r2", None), ("b", "r3", "c3")], "shipment_id string, route_id string, customer_id string")
    fields = "shipment_id string, invoice_date date, posting_date date, currency_code string, country_code string, customer_id string, route_id string, cost_center_id string, revenue_amount int, amount int, amount_eur int"
    day = datetime.date(2025, 1, 2)
    facts = spark.createDataFrame([(k, day, day, "C", "N", "x", "y", "z", i, i, i) for i, k in enumerate(["a", "b", "none", None])], fields)
    s = {"shipments": ships, "invoices": facts.drop("route_id"), "operational_costs": facts.drop("customer_id")}
    carried = gold.with_shipments(s, lambda f: f)
    assert [carried[n].count() for n in ("invoices", "operational_costs")] == [4, 4]
    for n, column, values in (("invoices", "route_id", ["r1", "r2", "r3"]), ("operational_costs", "customer_id", ["None", "c1", "c3"])):
        plain, new = (sorted(str(r[column]) for r in gold._shipped(f[n], s, column).collect()) for f in (s, carried))
        assert plain == new == values


def test_reconciliation_makes_each_fact_once(spark, sf):
    plan = catalogue.QUERIES["gold_recon"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "Relation [l_orderkey" not in plan


REPORTS = ["report_customer_ranked", "view_monthly", "report_country_filtered", "report_trend", "report_drillthrough", "load_audit", "card_country", "card_cost_and_fx", "card_customer_and_route", "report_route", "report_executive_card", "measure_gross_profit"]


@pytest.mark.parametrize("name", REPORTS)
def test_reports_that_read_no_key_number_no_dimension(spark, sf, name):
    plan = catalogue.QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64(" not in plan and "row_number(" not in plan


def test_facts_without_keys_have_the_same_rows(spark, sf):
    s = analogue.silver(spark, sf)
    # Routes whose country isn't a dimension's, rows without a name, and a name that comes twice.
    s["countries"] = s["countries"].where("country_code <> 'N3'")
    s["customers"] = s["customers"].where("customer_id % 7 <> 1").unionByName(s["customers"].limit(3)).unionByName(s["customers"].limit(2).withColumn("customer_id", F.lit(None).cast("string")))
    keyed, plain = star.wide(s), star.wide(s, keys=False)
    for fact in ("fact_shipment", "fact_invoice", "fact_operational_cost", "fact_budget"):
        columns = plain[fact].columns
        surrogate = [c for c in keyed[fact].columns if c.endswith("_key") and "date" not in c]
        assert surrogate and set(columns) == set(keyed[fact].columns) - set(surrogate)
        left, right = (f[fact].select(F.xxhash64(*columns).alias("h")).groupBy("h").count() for f in (keyed, plain))
        assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty() and not right.isEmpty()


def test_date_keys_are_the_digits_of_the_date(spark):
    days = spark.sql("SELECT d FROM VALUES (DATE '1998-05-01'), (DATE '2024-02-29'), (DATE '0000-01-09'), (DATE '9999-12-31'), (DATE '-0004-03-01'), (CAST(NULL AS DATE)) AS t(d)")
    rows = days.select(expr.date_key(F.col("d")).alias("new"), F.date_format("d", "yyyyMMdd").cast("int").alias("old"), star._month_key("old").alias("month"), (F.floor(F.col("old") / 100) * 100 + 1).cast("int").alias("plain")).collect()
    assert [r["new"] for r in rows] == [r["old"] for r in rows] and [r["month"] for r in rows] == [r["plain"] for r in rows]


def _shuffled(frame):
    """What each exchange of the plan by hash is given."""
    plan = frame.sparkSession._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "formatted")
    return re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: hashpartitioning", plan)


@pytest.mark.parametrize("name", ["report_country_filtered", "load_audit", "fact_invoice_star", "card_customer_and_route", "report_route", "report_executive_card"])
def test_lines_are_shuffled_as_facts(spark, sf, name, monkeypatch):
    monkeypatch.setattr(star, "FEW", 1000)  # suppliers are few, customers and parts too many
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8k")
    try:
        given = _shuffled(catalogue.QUERIES[name](spark, sf))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert given and not [g for g in given if re.search(r"\bl_(suppkey|partkey|shipdate|extendedprice|discount)#", g)]


def test_owners_beside_the_facts_give_the_same_star(spark, sf):
    one, two = analogue.silver(spark, sf), analogue.silver(spark, sf, owned=False)
    orders = one["shipments"].select("shipment_id").where("shipment_id % 3 = 0")
    for s in (one, two):
        s["customers"] = s["customers"].where("customer_id % 7 <> 1").unionByName(s["customers"].where("customer_id % 5 = 2"))
    # Orders that come twice, and orders that aren't there.
    two["owners"] = two["owners"].where("shipment_id % 4 <> 1").unionByName(two["owners"].join(orders, "shipment_id"))
    for n in ("invoices", "operational_costs"):
        one[n] = two[n].join(two["owners"] if n == "invoices" else two["owners"].select("shipment_id"), "shipment_id", "left")
    one, two = star.wide(one, keys=False), star.wide(two, keys=False)
    for fact in ("fact_invoice", "fact_operational_cost"):
        columns = sorted(one[fact].columns)
        assert columns == sorted(two[fact].columns)
        left, right = (f[fact].select(F.xxhash64(*columns).alias("h")).groupBy("h").count() for f in (one, two))
        assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty() and not right.isEmpty()
