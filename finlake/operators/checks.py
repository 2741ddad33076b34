"""Typing, rules, references and currency conversion, driven by the contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finlake.contracts import COST_TYPES, DATASETS, EXPECTED_INVOICES_PER_COUNTRY, FACTS, MIN_VOLUME_RATIO, Dataset
from finlake.functions import expr


class BatchRejected(ValueError):
    """A batch that can't be published at all."""


def _typed(kind: str, c: Column) -> Column:
    n = expr.number(c)
    return {
        "country": lambda: expr.country(c),
        "currency": lambda: expr.code(c),
        "kind": lambda: expr.code(c),
        "id": lambda: expr.identifier(c),
        "date": lambda: expr.strict_date(c),
        # Signs are tested before rounding; a rate must also be positive after it.
        "money": lambda: F.when(n >= 0, n).cast(expr.MONEY),
        "volume": lambda: F.when(n > 0, n).cast(expr.MONEY),
        "distance": lambda: F.when(n > 0, n).cast(expr.MONEY),
        "days": lambda: F.when((n > 0) & (n % 1 == 0), n).cast("int"),
        "places": lambda: n.cast("int"),
        "rate": lambda: F.when((n > 0) & (n.cast(expr.RATE) > 0), n).cast(expr.RATE),
    }.get(kind, lambda: c)()


def typed(frame: DataFrame, dataset: str) -> DataFrame:
    """Source strings as domain types; values that aren't valid become null."""
    fields = DATASETS[dataset].fields
    rest = [c for c in frame.columns if c not in fields]
    return frame.select(*[_typed(kind, F.col(f)).alias(f) for f, kind in fields.items()], *rest)


def marked(frame: DataFrame, column: str, keys: DataFrame, key: str, mark: str) -> DataFrame:
    """`frame` with `mark`: whether `keys` has the value. Keys are distinct, so no row is repeated."""
    known = keys.select(F.col(key).alias(column)).where(F.col(column).isNotNull()).distinct().withColumn(mark, F.lit(True))
    return frame.join(known, column, "left").withColumn(mark, F.coalesce(mark, F.lit(False)))


def own_rules(d: Dataset) -> list[tuple[str, Column]]:
    """Rules that a row's own values decide."""
    rules = [(f"MISSING_{f.upper()}", expr.blank(F.col(f))) for f in d.required]
    for f, kind in d.fields.items():
        if kind == "money":
            rules.append(("INVALID_FINANCIAL_VALUE", F.col(f).isNull()))
        elif kind == "volume":
            rules.append(("INVALID_SHIPMENT_VOLUME", F.col(f).isNull()))
        elif kind == "kind":
            rules.append(("INVALID_COST_TYPE", ~F.coalesce(F.col(f).isin(*COST_TYPES), F.lit(False))))
        elif kind == "rate":
            rules.append(("INVALID_EXCHANGE_RATE", F.col(f).isNull() | F.col(d.key[0]).isNull()))
    if d.name == "routes":
        rules.append(("INVALID_ROUTE_DEFINITION", F.col("distance_km").isNull() | F.col("standard_transit_days").isNull()))
    return rules


_UNKNOWN = {"countries": "UNKNOWN_COUNTRY_CODE", "currencies": "UNKNOWN_CURRENCY_CODE", "customers": "UNKNOWN_CUSTOMER_ID", "cost_centers": "UNKNOWN_COST_CENTER_ID", "routes": "UNKNOWN_ROUTE_ID", "shipments": "UNKNOWN_SHIPMENT_ID"}


def with_references(frame: DataFrame, d: Dataset, known: dict[str, DataFrame]) -> tuple[DataFrame, list[tuple[str, Column]]]:
    """`frame` with a mark per reference, and the rules over the marks."""
    rules = []
    for f, (target, _, missing_too) in d.refs.items():
        mark = f"_known_{f}"
        frame = marked(frame, f, known[target], DATASETS[target].key[0], mark)
        absent = ~F.col(mark) if missing_too else ~F.col(mark) & ~expr.blank(F.col(f))
        rules.append((_UNKNOWN[target], absent))
    return frame, rules


def rate_rules(rates: DataFrame) -> DataFrame:
    """Rates with reasons for keys that occur more than once: identical valid rates keep the first row; different
    rates, or any row that is invalid already, condemn all of the key's rows. `_reasons` holds the rows' own."""
    key = Window.partitionBy("rate_date", "currency_code")
    nth = F.row_number().over(key.orderBy("_source_row_number"))
    bad = F.max((F.size("_reasons") > 0).cast("int")).over(key) == 1
    several = F.min("rate_to_eur").over(key) != F.max("rate_to_eur").over(key)
    marked_ = rates.withColumns({"_n": F.count("*").over(key), "_nth": nth, "_bad": bad, "_several": F.coalesce(several, F.lit(False))})
    conflict = (F.col("_n") > 1) & (F.col("_bad") | F.col("_several"))
    more = expr.reasons([("CONFLICTING_EXCHANGE_RATE", conflict), ("DUPLICATE_EXCHANGE_RATE", (F.col("_n") > 1) & ~conflict & (F.col("_nth") > 1))])
    return marked_.withColumn("_reasons", F.concat("_reasons", more)).drop("_n", "_nth", "_bad", "_several")


def rate_keys(rates: DataFrame) -> DataFrame:
    """One row per (date, currency): the rate if it can be used, and the state of the key."""
    has = lambda r: F.max(F.array_contains("_reasons", r).cast("int")) == 1
    ok = F.size("_reasons") == 0
    return (
        rates.where(F.col("rate_date").isNotNull())
        .groupBy("rate_date", "currency_code")
        .agg(
            F.when(has("CONFLICTING_EXCHANGE_RATE"), "conflict").when(F.max(ok.cast("int")) == 0, "invalid").otherwise("ok").alias("_rate_state"),
            F.max(F.when(ok, F.col("rate_to_eur"))).alias("_rate"),
        )
    )


def converted(facts: DataFrame, d: Dataset, rates: DataFrame) -> tuple[DataFrame, list[tuple[str, Column]]]:
    """Facts with fx_rate_to_eur and amount_eur by the exact date, and the rules for rates that can't be used."""
    keyed = rates.select(F.col("rate_date").alias(d.date), "currency_code", "_rate_state", "_rate")
    out = facts.join(keyed, [d.date, "currency_code"], "left")
    usable = F.col("_rate_state") == "ok"
    asked = F.col(d.amount).isNotNull() & F.col("_known_currency_code")
    state = F.coalesce("_rate_state", F.lit("missing"))
    out = out.withColumns(
        {
            "fx_rate_to_eur": F.when(asked & usable, F.col("_rate")).cast(expr.RATE),
            "amount_eur": F.when(asked & usable, expr.money_product(F.col(d.amount), F.col("_rate"))),
        }
    )
    return out, [
        ("CONFLICTING_EXCHANGE_RATE_REFERENCE", asked & (state == "conflict")),
        ("INVALID_EXCHANGE_RATE_REFERENCE", asked & (state == "invalid")),
        ("MISSING_EXCHANGE_RATE", asked & (state == "missing")),
    ]


def dropped_countries(invoices: DataFrame, countries: DataFrame, expected: int = EXPECTED_INVOICES_PER_COUNTRY, ratio: str = MIN_VOLUME_RATIO) -> DataFrame:
    """Listed countries whose distinct invoices are fewer than expected x ratio; absent countries count as none."""
    counts = invoices.groupBy("country_code").agg(F.countDistinct("invoice_id").alias("n"))
    listed = countries.select("country_code").where(F.col("country_code").isNotNull()).distinct()
    return listed.join(counts, "country_code", "left").select("country_code", F.coalesce("n", F.lit(0)).alias("n")).where(F.col("n") < F.lit(expected).cast("decimal(20,2)") * F.lit(ratio).cast("decimal(10,4)"))


def check_batch(frames: dict[str, DataFrame], expected: int = EXPECTED_INVOICES_PER_COUNTRY, ratio: str = MIN_VOLUME_RATIO) -> dict[str, DataFrame]:
    """Typed datasets with `_reasons`; facts also with fx_rate_to_eur and amount_eur. A row is trusted if it has none."""
    out: dict[str, DataFrame] = {}

    def keys(target: str, trusted: bool) -> DataFrame:
        if target not in out:
            return frames[target]
        return out[target].where(F.size("_reasons") == 0) if trusted else frames[target]

    order = ["currencies", "countries", "exchange_rates", "customers", "cost_centers", "routes", "shipments", "invoices", "budgets", "operational_costs"]
    state = None
    for name in order:
        d, frame = DATASETS[name], frames[name]
        columns = frame.columns
        known = {target: keys(target, trusted) for target, trusted, _ in d.refs.values()}
        frame, rules = with_references(frame, d, known)
        rules = own_rules(d) + rules
        extra = []
        if d.is_fact:
            frame, more = converted(frame, d, state)
            rules, extra = rules + more, ["fx_rate_to_eur", "amount_eur"]
        if name == "invoices":
            frame = marked(frame, "country_code", dropped_countries(frames[name], frames["countries"], expected, ratio), "country_code", "_dropped")
            rules = [*rules, ("COUNTRY_VOLUME_DROP", F.col("_dropped"))]
        frame = frame.withColumn("_reasons", expr.reasons(rules)).select(*columns, *extra, "_reasons")
        if name == "exchange_rates":
            frame = rate_rules(frame)
            state = rate_keys(frame)
        out[name] = frame
    return out


def trusted(frame: DataFrame) -> DataFrame:
    return frame.where(F.size("_reasons") == 0).drop("_reasons")


def quarantined(frame: DataFrame) -> DataFrame:
    return frame.where(F.size("_reasons") > 0).withColumn("_reason_codes", expr.joined(F.col("_reasons"))).drop("_reasons")


def reject_bad_dates(frames: dict[str, DataFrame]) -> None:
    """A fact without a valid date fails its whole batch before anything is published."""
    for name in FACTS:
        if not frames[name].where(F.col(DATASETS[name].date).isNull()).isEmpty():
            raise BatchRejected(f"{name}: {DATASETS[name].date} holds a value that is no date")
