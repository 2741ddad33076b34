"""Gold from deltas against Gold from whole tables, and distinct counts from stored sets."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from finlake.operators import bitmaps, deltas, gold
from finlake.plans import batch, gold_deltas
from finlake.plans.store import ArtifactIntegrityError, Store
from finlake.sources import fixtures

SCHEMAS = {
    "shipments": "shipment_id string, shipment_date date, route_id string, customer_id string, country_code string",
    "invoices": "invoice_id string, shipment_id string, invoice_date date, country_code string, customer_id string, currency_code string, revenue_amount decimal(20,2), amount_eur decimal(20,2)",
    "operational_costs": "cost_id string, shipment_id string, posting_date date, route_id string, cost_center_id string, country_code string, currency_code string, amount decimal(20,2), amount_eur decimal(20,2)",
    "budgets": "month_start date, cost_center_id string, amount_eur decimal(20,2)",
    "cost_centers": "cost_center_id string, country_code string",
    "routes": "route_id string, origin_country_code string, destination_country_code string, transport_mode string",
    "exchange_rates": "rate_date date, currency_code string, rate_to_eur decimal(18,6)",
}
FACTS = ("shipments", "invoices", "operational_costs", "budgets")


def day(rng):
    return dt.date(2025, rng.choice([1, 2]), rng.randrange(1, 28))


def money(rng):
    return Decimal(rng.randrange(-500, 5000)) / 100


def delivered(rng, name):
    """Facts of one delivery; invoices and costs may name shipments of any delivery, or of none."""
    ships = [(f"{name}{i}", day(rng), rng.choice("RS"), rng.choice("XY"), rng.choice("AB")) for i in range(3)]
    every = [f"{n}{i}" for n in "abcdefghij" for i in range(3)]
    invoices = [(f"{name}i{k}", rng.choice(every), day(rng), rng.choice("AB"), rng.choice("XY"), rng.choice(["E", "U"]), money(rng), money(rng)) for k in range(4)]
    costs = [(f"{name}c{k}", rng.choice(every), day(rng), rng.choice("RS"), rng.choice("KL"), rng.choice("AB"), rng.choice(["E", "U"]), money(rng), money(rng)) for k in range(4)]
    return {"shipments": ships, "invoices": invoices, "operational_costs": costs, "budgets": [(dt.date(2025, ord(name) % 9 + 1, 1), rng.choice("KL"), money(rng))]}


def references(rng):
    return {
        "cost_centers": [("K", rng.choice("AB")), ("L", "B")],
        "routes": [("R", "A", "B", "sea"), ("S", "B", "A", rng.choice(["air", "road"]))],
        "exchange_rates": [(dt.date(2025, m, rng.choice([1, 2])), c, Decimal(rng.choice([1, 2]))) for m in (1, 2) for c in "EU" if rng.random() < 0.8],
    }


def rows_of(frame):
    return sorted(map(str, frame.collect()))


@pytest.mark.parametrize("product", list(gold.PRODUCTS))
def test_ten_deliveries_equal_a_full_rebuild(spark, product):
    """Deliveries, corrections and supersessions, with rates and cost centres that change."""
    rng = random.Random(5)
    frame = lambda n, rows: spark.createDataFrame(rows, SCHEMAS[n])
    facts = lambda d, n: [r for b in d.values() for r in b[n]]
    held, refs, sums, schema = {}, {n: [] for n in SCHEMAS if n not in FACTS}, None, None
    for step in range(10):
        name, now = "abcdefghij"[step], dict(held)
        gone = rng.choice(sorted(held)) if held and step % 3 else None
        if gone:
            name = gone if step % 3 == 1 else name
            now.pop(gone)
        now[name] = delivered(rng, name)
        new_refs = references(rng)
        kept = {b: v for b, v in held.items() if now.get(b) is v}
        changes = {n: deltas.Change(frame(n, facts(kept, n)), frame(n, facts({b: v for b, v in held.items() if b not in kept}, n)), frame(n, facts({b: v for b, v in now.items() if b not in kept}, n))) for n in FACTS}
        changes |= {n: deltas.Change(frame(n, []), frame(n, refs[n]), frame(n, new_refs[n])) for n in refs}
        delta = deltas.signed(product, changes)
        done = deltas.applied(product, None if sums is None else spark.createDataFrame(sums, schema), delta, changes)
        schema, sums = done.schema, done.collect()
        held, refs = now, new_refs
        if step % 3 == 0:
            tables = {n: frame(n, facts(held, n)) for n in FACTS} | {n: frame(n, refs[n]) for n in refs}
            assert rows_of(deltas.product_of(product, spark.createDataFrame(sums, schema), tables)) == rows_of(gold.PRODUCTS[product](tables))


def test_what_came_as_it_went_touches_nothing(spark):
    rng = random.Random(1)
    one, refs = delivered(rng, "a"), references(rng)
    frame = lambda n, rows: spark.createDataFrame(rows, SCHEMAS[n])
    same = {n: deltas.Change(frame(n, []), frame(n, r), frame(n, r)) for n, r in (one | refs).items()}
    for product in gold.PRODUCTS:
        assert deltas.signed(product, same).collect() == []


def test_a_stores_gold_is_kept_up_by_deltas(spark, tmp_path):
    """A delivery and its correction: Gold equals a rebuild, and altered sums are refused."""
    store = Store(spark, tmp_path / "root")
    for scenario in ("correction-initial", "correction-corrected"):
        folder = fixtures.generate(tmp_path / scenario, scenario, months=1, per_month=2)
        batch.process_batch(spark, tmp_path / "root", folder, expected=2)
    state = store.state()
    tables = batch.silver_tables(store, state)
    for product, make in gold.PRODUCTS.items():
        assert rows_of(store.read(state, product).select(*make(tables).columns)) == rows_of(make(tables))
    paths = {p: {n: v["path"] for n, v in state["tables"][gold_deltas.sums_of(p)].items()} for p in gold.PRODUCTS}
    gold_deltas.update(store, state, state, tables, tables)  # nothing changed
    assert paths == {p: {n: v["path"] for n, v in state["tables"][gold_deltas.sums_of(p)].items()} for p in gold.PRODUCTS}
    for part in state["tables"]["sums_budget_vs_actual"].values():
        part["row_digest"] = "7"
    without = state | {"tables": state["tables"] | {"silver_budgets": {}}}
    with pytest.raises(ArtifactIntegrityError, match="sums_budget_vs_actual"):
        gold_deltas.update(store, state, without, tables, tables | {"budgets": tables["budgets"].limit(0)})


# Distinct counts


def test_stored_sets_count_exactly(spark):
    rows = spark.range(60000).select((F.col("id") % 7).alias("g"), F.when(F.col("id") % 11 > 0, F.col("id") % 3).alias("h"), F.when(F.col("id") % 5 > 0, F.col("id") * 3 % 50021).alias("k"))
    held = bitmaps.stored(rows, "k", ["g", "h"]).cache()
    assert held.where("bitmap is not null").count() and held.where("size(places) > 512").count() == 0
    few = rows.where("k % 100 = 0")
    small = bitmaps.stored(few, "k", ["g", "h"]).cache()
    assert small.where("bitmap is not null").count() == 0
    for frame, made in ((rows, held), (few, small)):
        for by in ([], ["g"], ["h"], ["g", "h"]):
            wanted = frame.groupBy(*by).agg(F.countDistinct("k").alias("n"))
            assert rows_of(bitmaps.counted(made, by)) == rows_of(wanted)
    # Aggregates of two deliveries stand side by side.
    halves = [bitmaps.stored(rows.where(c), "k", ["g", "h"]) for c in ("k % 4 < 3", "k % 4 > 1")]
    assert rows_of(bitmaps.counted(halves[0].unionByName(halves[1]), ["g"])) == rows_of(rows.groupBy("g").agg(F.countDistinct("k").alias("n")))
    none = bitmaps.stored(rows.limit(0), "k", ["g"])
    assert bitmaps.counted(none, ["g"]).collect() == [] and bitmaps.counted(none).collect()[0]["n"] == 0
    assert bitmaps.counted(bitmaps.stored(spark.createDataFrame([(1, -5), (1, -5), (1, 0)], "g int, k long"), "k", ["g"]), ["g"]).collect()[0]["n"] == 2
