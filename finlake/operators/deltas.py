"""Gold from what changed: signed rows, so that a correction subtracts what it replaces.

A Gold product is sums and counts over joins of Silver tables. When tables change, its sums change by the rows that came
(+1) less those that went (-1), where a fact's row also goes and comes again if a row that it is joined with has changed. Only groups
that such rows fall in are touched; `n`, the rows that a group has over all its facts, says when it is gone.

Defined results: rows that went and came alike cancel out and touch nothing; business keys are unique and not null, as Silver has
them, so distinct shipments are counted rows; a least value (a customer's country) can't be subtracted and is taken again,
for touched groups alone.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.functions import expr
from finlake.operators import gold

#: What each product adds up, besides `shipment_count`.
VALUES = {
    "gold_monthly_country_finance": ("total_revenue_eur", "fx_r", "total_operational_cost_eur", "fx_c", "budget_amount_eur"),
    "gold_route_profitability": ("total_revenue_eur", "allocated_operational_cost_eur"),
    "gold_customer_profitability": ("total_revenue_eur", "allocated_operational_cost_eur"),
    "gold_budget_vs_actual": ("budget_amount_eur", "actual_cost_eur"),
}
_SHIPMENT, _CENTER, _RATE = ("shipments", ("shipment_id",)), ("cost_centers", ("cost_center_id",)), ("exchange_rates", ("_month", "currency_code"))
#: By product and fact, the tables whose rows a fact's row is joined with, by which columns, and which of theirs matter.
JOINED = {
    "gold_monthly_country_finance": {"invoices": [(*_SHIPMENT, ()), (*_RATE, ("open_rate",))], "operational_costs": [(*_SHIPMENT, ()), (*_RATE, ("open_rate",))], "shipments": [], "budgets": [(*_CENTER, ("country_code",))]},
    "gold_route_profitability": {"invoices": [(*_SHIPMENT, ("route_id",))], "operational_costs": [], "shipments": []},
    "gold_customer_profitability": {"invoices": [], "operational_costs": [(*_SHIPMENT, ("customer_id",))], "shipments": []},
    "gold_budget_vs_actual": {"budgets": [], "operational_costs": []},
}
_DATES = {"invoices": "invoice_date", "operational_costs": "posting_date"}


@dataclass(frozen=True)
class Change:
    """A table's rows that stay, those that went and those that came."""

    kept: DataFrame
    minus: DataFrame
    plus: DataFrame

    @property
    def old(self) -> DataFrame:
        return self.kept.unionByName(self.minus)

    @property
    def new(self) -> DataFrame:
        return self.kept.unionByName(self.plus)


def _altered(change: Change, table: str, keys: tuple[str, ...], columns: tuple[str, ...]) -> DataFrame:
    """Keys of rows of a joined table that differ, each once."""
    if table == "exchange_rates":
        before, after = (gold.month_open(x).withColumnRenamed("month_start", "_month") for x in (change.old, change.new))
    else:
        before, after = change.minus, change.plus
    both = reduce(DataFrame.unionByName, [x.select(*keys, *columns, F.lit(sign).alias("_sign")) for x, sign in ((before, -1), (after, 1))])
    return both.groupBy(*keys, *columns).agg(F.sum("_sign").alias("_n")).where("_n <> 0").select(*keys).distinct()


def _reached(kept: DataFrame, fact: str, joined: list, changes: dict[str, Change]) -> DataFrame:
    """Rows of a fact that stay, but whose joined rows have changed."""
    if not joined:
        return kept.limit(0)
    out = kept.withColumn("_month", expr.month(F.col(_DATES[fact]))) if fact in _DATES else kept
    for i, (table, keys, columns) in enumerate(joined):
        out = out.join(_altered(changes[table], table, keys, columns).withColumn(f"_hit{i}", F.lit(True)), list(keys), "left")
    return out.where(F.coalesce(*[F.col(f"_hit{i}") for i in range(len(joined))], F.lit(False))).select(*kept.columns)


def _added(rows: DataFrame, product: str) -> DataFrame:
    keys, values = gold.KEYS[product], VALUES[product]
    sums = [F.coalesce(F.sum(v), F.lit(0)).cast(expr.MONEY).alias(v) for v in values]
    return rows.groupBy(*keys).agg(*sums, *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("shipment_count", "n")])


def signed(product: str, changes: dict[str, Change]) -> DataFrame:
    """By how much each group's sums and counts change; groups that don't aren't there."""
    keys, values = gold.KEYS[product], VALUES[product]
    old, new = {t: c.old for t, c in changes.items()}, {t: c.new for t, c in changes.items()}
    parts = []
    for fact, joined in JOINED[product].items():
        near = _reached(changes[fact].kept, fact, joined, changes)
        # Rows that stay go on their own: they are shuffled once for what they reach and for both signs.
        for sign, tables, rows in ((1, new, changes[fact].plus), (-1, old, changes[fact].minus), *([(1, new, near), (-1, old, near)] if joined else [])):
            made = gold.ROWS[product](tables | {fact: rows})[fact]
            of = {v: (F.col(v) * sign if v in made.columns else F.lit(None)).cast(expr.MONEY) for v in values}
            parts.append(made.select(*keys, *[c.alias(v) for v, c in of.items()], F.lit(sign if fact == "shipments" else 0).alias("shipment_count"), F.lit(sign).alias("n")))
    out = _added(reduce(DataFrame.unionByName, parts), product)
    return out.where(reduce(lambda a, b: a | b, [F.col(c) != 0 for c in (*values, "shipment_count", "n")]))


def applied(product: str, held: DataFrame | None, delta: DataFrame, changes: dict[str, Change]) -> DataFrame:
    """Sums of the groups of `held` (None: there are none) and of `delta`, which `signed` gave, without groups that are gone."""
    keys = list(gold.KEYS[product])
    out = _added(delta if held is None else held.select(*delta.columns).unionByName(delta), product).where("n > 0")
    if product != "gold_customer_profitability":
        return out
    touched = delta.select(*keys)
    ships = gold.ROWS[product]({t: c.new for t, c in changes.items()})["shipments"].join(touched, keys, "left_semi")
    now = ships.groupBy(*keys).agg(F.min_by("country_code", "shipment_id").alias("_now"))
    out = out.join(touched.withColumn("_touched", F.lit(True)), keys, "left").join(now, keys, "left")
    if held is None:
        return out.withColumn("country_code", F.col("_now")).drop("_now", "_touched")
    out = out.join(held.select(*keys, F.col("country_code").alias("_held")), keys, "left")
    return out.withColumn("country_code", F.when(F.col("_touched"), F.col("_now")).otherwise(F.col("_held"))).drop("_now", "_held", "_touched")


def product_of(product: str, sums: DataFrame, references: dict[str, DataFrame]) -> DataFrame:
    """The product's rows from its sums."""
    return gold.FINISHED[product](sums, references)
