"""Measures, and a planner that evaluates them by dimensions and under filters.

Each fact is filtered and aggregated on its own and joined with the others on the union of their keys, so that facts
never multiply one another. Dimensions filter facts in one direction; a budget's country is its cost centre's.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.functions import expr
from finlake.operators.gold import together


@dataclass(frozen=True)
class Base:
    """A measure that one fact gives."""

    fact: str
    column: Callable[[], Column]
    zero: bool = True


BASE = {
    "total_revenue": Base("invoice", lambda: expr.total(F.col("amount_eur"))),
    "total_operational_cost": Base("cost", lambda: expr.total(F.col("amount_eur"))),
    "shipment_count": Base("shipment", lambda: F.countDistinct("shipment_id")),
    "budget_amount": Base("budget", lambda: expr.total(F.col("amount_eur"))),
    "fx_impact_revenue": Base("invoice", lambda: expr.total(F.col("amount_eur") - F.col("amount_at_comparison_rate_eur"))),
    "failed_quality_rows": Base("quality", lambda: F.sum(F.when(F.col("validation_status") == "FAIL", F.col("failed_row_count")))),
    "latest_successful_refresh": Base("quality", lambda: F.max(F.when(F.col("validation_status") == "PASS", F.col("execution_timestamp"))), zero=False),
}
_c = F.col
DERIVED: dict[str, tuple[tuple[str, ...], Callable[[], Column]]] = {
    "gross_profit": (("total_revenue", "total_operational_cost"), lambda: expr.money(_c("total_revenue") - _c("total_operational_cost"))),
    "gross_margin_pct": (("total_revenue", "total_operational_cost"), lambda: expr.ratio(expr.money(_c("total_revenue") - _c("total_operational_cost")), _c("total_revenue"))),
    "revenue_per_shipment": (("total_revenue", "shipment_count"), lambda: expr.per_unit(_c("total_revenue"), _c("shipment_count"))),
    "cost_per_shipment": (("total_operational_cost", "shipment_count"), lambda: expr.per_unit(_c("total_operational_cost"), _c("shipment_count"))),
    "actual_cost": (("total_operational_cost",), lambda: _c("total_operational_cost")),
    "budget_variance_amount": (("budget_amount", "total_operational_cost"), lambda: expr.money(_c("budget_amount") - _c("total_operational_cost"))),
    "budget_variance_pct": (("budget_amount", "total_operational_cost"), lambda: expr.ratio(expr.money(_c("budget_amount") - _c("total_operational_cost")), _c("budget_amount"))),
    "fx_impact": (("fx_impact_revenue",), lambda: _c("fx_impact_revenue")),
}
MEASURES = (*BASE, *DERIVED)


#: Attributes that reports group and filter by, and the dimension that has each. Others are the fact's own columns.
ATTRIBUTES = {"country_code": "country", "customer_id": "customer", "route_id": "route", "cost_center_id": "cost_center", "month_start": "date"}


class Flat:
    """The star's facts, each joined with just those dimensions whose attributes are asked for and not carried by the fact."""

    DATES = {"invoice": "invoice_date_key", "cost": "posting_date_key", "shipment": "shipment_date_key", "budget": "month_date_key"}
    TABLES = {"invoice": "fact_invoice", "cost": "fact_operational_cost", "shipment": "fact_shipment", "budget": "fact_budget"}

    def __init__(self, star: dict[str, DataFrame], quality: DataFrame | None = None):
        self.star, self.quality = star, quality

    def fact(self, name: str, attributes: Sequence[str]) -> DataFrame:
        if name == "quality":
            return self.quality
        frame = self.star[self.TABLES[name]]
        for a in dict.fromkeys(attributes):
            dim = None if a in frame.columns else ATTRIBUTES.get(a)
            if dim == "date":
                dates = self.star["dim_date"].select(F.col("date_key").alias(self.DATES[name]), a)
                frame = frame.join(dates, self.DATES[name], "left")
            elif dim == "country" and name == "budget":  # a budget's country is its cost centre's
                center = "cost_center_key" if "cost_center_key" in frame.columns else "cost_center_id"
                frame = frame.join(self.star["dim_cost_center"].select(center, a), center, "left")
            elif dim:
                frame = frame.join(self.star[f"dim_{dim}"].select(f"{dim}_key", a), f"{dim}_key", "left")
        return frame


def query(facts: Flat | dict[str, DataFrame], measures: Sequence[str], by: Sequence[str] = (), where: Mapping[str, object] | None = None) -> DataFrame:
    """Measures by the columns of `by`, for rows whose attributes have the values of `where` (one each, or a list). Facts that
    lack a column of `by` can't be split by it and are left out of `measures` by the caller."""
    needed = list(dict.fromkeys(b for m in measures for b in (DERIVED[m][0] if m in DERIVED else (m,))))
    where = where or {}
    frames = []
    for fact in dict.fromkeys(BASE[b].fact for b in needed):
        frame = facts.fact(fact, [*by, *where]) if isinstance(facts, Flat) else facts[fact]
        for attribute, value in where.items():
            frame = frame.where(F.col(attribute).isin(*value) if isinstance(value, list | tuple) else F.col(attribute) == F.lit(value))
        frames.append(frame.groupBy(*by).agg(*[BASE[b].column().alias(b) for b in needed if BASE[b].fact == fact]))
    if by and len(frames) == 1:
        out = frames[0]
    elif by:
        out = together(frames, by)  # rows without a value of a key are one group, too
    else:
        out = reduce(lambda a, f: a.join(f, F.lit(True)), frames)  # one row each
    kinds = dict(out.dtypes)
    out = out.withColumns({b: F.coalesce(b, F.lit(0)).cast(kinds[b]) for b in needed if BASE[b].zero})
    return out.select(*by, *[(DERIVED[m][1]() if m in DERIVED else F.col(m)).alias(m) for m in measures])


def ranked(frame: DataFrame, measure: str, keys: Sequence[str], top: int | None = None) -> DataFrame:
    """`frame` in the order of a measure, the largest first; the first `top` rows if wanted."""
    out = frame.orderBy(F.desc(measure), *keys)
    return out.limit(top) if top else out
