"""Rules on small made-up frames."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from finlake.contracts import COVERAGE, DATASETS, REASON_TO_RULE, bronze_schema
from finlake.functions import expr
from finlake.operators import checks, evidence, gold, merge, ownership
from finlake.sources import fixtures


def values(spark, column, rows):
    frame = spark.createDataFrame([(r,) for r in rows], "c string")
    return [r[0] for r in frame.select(column(F.col("c"))).collect()]


def test_numbers(spark):
    assert values(spark, expr.number, ["NaN", "Infinity", "1,234", "", "abc", None, "1_000"]) == [None] * 7
    assert values(spark, lambda c: expr.number(c).cast(expr.MONEY), [" 12.345 ", "-0.125", "1e3", ".5"]) == [Decimal("12.35"), Decimal("-0.13"), Decimal("1000.00"), Decimal("0.50")]


def test_dates(spark):
    assert values(spark, expr.strict_date, ["2025-02-31", "2025", "2025-1-5", "2025-01-05T10:00", "05/01/2025", None]) == [None] * 6
    assert values(spark, expr.strict_date, ["2025-01-05"]) == [dt.date(2025, 1, 5)]


def test_codes(spark):
    assert values(spark, expr.country, ["\tGermany \n", "türkiye", "uk", "xx"]) == ["DE", "TR", "GB", "XX"]
    assert values(spark, expr.identifier, [" cust 1\t"]) == ["CUST-1"]
    assert values(spark, expr.spreadsheet_safe, ["=1+1", "-2", "ok", None]) == ["'=1+1", "'-2", "ok", None]


def test_one_rounding(spark):
    row = spark.sql("SELECT CAST('0.09' AS DECIMAL(20,2)) a, CAST('0.055555' AS DECIMAL(18,6)) r").select(expr.money_product(F.col("a"), F.col("r"))).first()
    assert row[0] == Decimal("0.00")


@pytest.mark.parametrize("value", ["NaN", "sNaN", "Infinity", "-Infinity", "bad", "-1.00", "-0.001"])
def test_amounts_that_are_invalid(spark, value):
    assert values(spark, lambda c: checks._typed("money", c), [value]) == [None]


def test_zero_amount_is_valid_and_rates_must_stay_positive(spark):
    assert values(spark, lambda c: checks._typed("money", c), ["0.00"]) == [Decimal("0.00")]
    assert values(spark, lambda c: checks._typed("rate", c), ["0", "-1", "NaN", "0.0000004"]) == [None] * 4
    assert values(spark, lambda c: checks._typed("days", c), ["1.5", "1.0", "0"]) == [None, 1, None]


def frames(spark, rows):
    out = {}
    for name, each in rows.items():
        data = [(*[r[f] for f in DATASETS[name].fields], "b", f"{name}.csv", i, "f" * 64, None) for i, r in enumerate(each, 1)]
        out[name] = checks.typed(spark.createDataFrame(data, bronze_schema(name)), name)
    return out


def codes(frame, key):
    return {r[key]: r["_reason_codes"] for r in checks.quarantined(frame).collect()}


def test_cost_corruptions_each_have_their_reason(spark):
    rows = fixtures.datasets(months=1, per_month=4)
    fixtures.apply(rows, "invalid-costs")
    found = codes(checks.check_batch(frames(spark, rows), expected=1)["operational_costs"], "cost_id")
    assert len(found) == 9 and len(set(found.values())) == 8


def test_missing_and_unknown_references(spark):
    rows = fixtures.datasets(months=1, per_month=3)
    rows["invoices"][0]["customer_id"] = " "
    rows["invoices"][1]["customer_id"] = "NOBODY"
    rows["invoices"][2]["shipment_id"] = ""
    rows["shipments"][3]["route_id"] = ""
    found = checks.check_batch(frames(spark, rows), expected=1)
    first, shipment = [r["invoice_id"] for r in rows["invoices"]], rows["shipments"][3]["shipment_id"]
    assert codes(found["invoices"], "invoice_id") == {first[0]: "MISSING_CUSTOMER_ID", first[1]: "UNKNOWN_CUSTOMER_ID", first[2]: "UNKNOWN_SHIPMENT_ID"}
    assert codes(found["shipments"], "shipment_id") == {shipment: "MISSING_ROUTE_ID|UNKNOWN_ROUTE_ID"}


def test_rates(spark):
    rows = fixtures.datasets(months=1, per_month=6)
    rates = rows["exchange_rates"]
    used = sorted({r["invoice_date"] for r in rows["invoices"] if r["currency_code"] == "CHF"})
    conflicting, invalid = used[:2]
    unused = next(r["rate_date"] for r in rates if r["rate_date"] not in used)
    of = lambda day: next(r for r in rates if r["currency_code"] == "CHF" and r["rate_date"] == day)
    rates.append(dict(of(unused)))
    rates.append(of(conflicting) | {"rate_to_eur": "9.000000"})
    of(invalid)["rate_to_eur"] = "NaN"
    found = checks.check_batch(frames(spark, rows), expected=1)
    reasons = sorted(r[0] for r in checks.quarantined(found["exchange_rates"]).select("_reason_codes").collect())
    assert reasons == ["CONFLICTING_EXCHANGE_RATE"] * 2 + ["DUPLICATE_EXCHANGE_RATE", "INVALID_EXCHANGE_RATE"]
    dependants = {(str(r["invoice_date"]), r["_reason_codes"], r["amount_eur"]) for r in checks.quarantined(found["invoices"]).collect()}
    assert dependants == {(conflicting, "CONFLICTING_EXCHANGE_RATE_REFERENCE", None), (invalid, "INVALID_EXCHANGE_RATE_REFERENCE", None)}


def test_volume_drop_counts_distinct_invoices_of_listed_countries(spark):
    rows = fixtures.datasets(months=1, per_month=4)
    rows["invoices"] = [r for r in rows["invoices"] if r["country_code"] != "PL"] + [r for r in rows["invoices"] if r["country_code"] == "PL"][:1] * 4
    found = frames(spark, rows)
    gone = checks.dropped_countries(found["invoices"], found["countries"], 4, "0.50")
    assert [(r[0], r[1]) for r in gone.collect()] == [("PL", 1)]


def claims(spark, rows):
    return ownership.resolve_claims(spark.createDataFrame(rows, "invoice_id string, claim_hash string, _batch_id string, arrival int, _source_row_number int"))


def test_claims(spark):
    rows = [("a", "x", "b1", 1, 1), ("a", "x", "b1", 1, 2), ("a", "x", "b2", 2, 1), ("b", "x", "b1", 1, 3), ("b", "y", "b2", 2, 2), ("c", "z", "b2", 2, 3)]
    found = {(r["invoice_id"], r["_batch_id"], r["_source_row_number"]): r["_reasons"] for r in claims(spark, rows).collect()}
    assert found[("a", "b1", 1)] == [] and found[("c", "b2", 3)] == []
    assert found[("a", "b1", 2)] == ["DUPLICATE_INVOICE"] and found[("a", "b2", 1)] == ["CROSS_BATCH_DUPLICATE_INVOICE"]
    assert found[("b", "b1", 3)] == found[("b", "b2", 2)] == ["CONFLICTING_DUPLICATE_INVOICE"]


def test_payload_keeps_values_apart(spark):
    rows = spark.createDataFrame([("a", None), (None, "a"), ("", "a"), ("a", "")], "x string, y string")
    assert rows.select(expr.payload(F.col("x"), F.col("y")).alias("h")).distinct().count() == 4


def test_attestation_ignores_order_and_sees_changes(spark):
    rows = spark.createDataFrame([(i, f"v{i}") for i in range(20)], "k int, v string")
    same = evidence.attest(rows, ["k"]).first()
    assert evidence.attest(rows.repartition(3).orderBy(F.desc("k")), ["k"]).first() == same
    assert evidence.attest(rows.withColumn("v", F.when(F.col("k") == 3, "x").otherwise(F.col("v"))), ["k"]).first()["row_digest"] != same["row_digest"]


def test_keys_stay_and_go_on(spark):
    held = spark.createDataFrame([("a", 7)], "n string, k long")
    found = {r[0]: r[1] for r in merge.with_keys(held, spark.createDataFrame([("a",), ("b",), ("c",), ("b",), (None,)], "n string"), "n", "k").collect()}
    assert found["a"] == 7 and sorted(found.values()) == [7, 8, 9]


def test_spine_doesnt_fan_out(spark):
    a = spark.createDataFrame([(1, 10), (2, 20)], "k int, a int")
    b = spark.createDataFrame([(2, 5), (3, 6)], "k int, b int")
    assert sorted(tuple(r) for r in gold.spine([a, b], ["k"]).collect()) == [(1, 10, None), (2, 20, 5), (3, None, 6)]


def test_vocabulary():
    assert len(COVERAGE) == 38 and len(REASON_TO_RULE) == 25
