"""Gold products: metrics aggregated on their own, then joined on the union of their keys."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.functions import expr


def together(metrics: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """All keys of all metric frames, with each frame's columns, which have different names; nulls in keys are a value. Frames have
    one row per key, so nothing fans out, and each is computed once."""
    types = {c: t for m in metrics for c, t in m.dtypes if c not in keys}
    rows = [m.select(*keys, *[F.col(c) if c in m.columns else F.lit(None).cast(t).alias(c) for c, t in types.items()]) for m in metrics]
    every = reduce(DataFrame.unionByName, rows)
    return every.groupBy(*keys).agg(*[F.first(c, ignorenulls=True).alias(c) for c in types]) if types else every.distinct()


def spine(metrics: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """`together`, but rows that lack a key are no group's: their keys are listed, without values."""
    out = together(metrics, keys)
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return out.select(*keys, *[F.when(whole, F.col(c)).alias(c) for c in out.columns if c not in keys])


def month_open(rates: DataFrame) -> DataFrame:
    """The first rate of each month and currency."""
    return rates.groupBy(expr.month(F.col("rate_date")).alias("month_start"), "currency_code").agg(F.min_by("rate_to_eur", "rate_date").alias("open_rate"))


def with_fx_impact(facts: DataFrame, date: str, amount: str, opening: DataFrame) -> DataFrame:
    """Facts with month_start and fx_impact_eur: EUR minus EUR at the month's opening rate, 0 where there is none."""
    out = facts.withColumn("month_start", expr.month(F.col(date))).join(opening, ["month_start", "currency_code"], "left")
    at_open = expr.money_product(F.col(amount), F.col("open_rate"))
    return out.withColumns({"amount_at_open_eur": at_open, "fx_impact_eur": expr.zero(F.col("amount_eur") - at_open)}).drop("open_rate")


def margin(revenue: str = "total_revenue_eur", cost: str = "total_operational_cost_eur") -> dict[str, Column]:
    profit = expr.money(F.col(revenue) - F.col(cost))
    return {"gross_profit_eur": profit, "gross_margin_pct": expr.ratio(profit, F.col(revenue))}


def variance(budget: str, cost: str) -> dict[str, Column]:
    amount = expr.money(F.col(budget) - F.col(cost))
    return {"budget_variance_amount_eur": amount, "budget_variance_pct": expr.ratio(amount, F.col(budget))}


def _sum(frame: DataFrame, keys: Sequence[str], **columns: str) -> DataFrame:
    return frame.groupBy(*keys).agg(*[expr.total(F.col(c)).alias(name) for name, c in columns.items()])


def _zeros(frame: DataFrame, *columns: str) -> DataFrame:
    return frame.withColumns({c: expr.zero(F.col(c)) for c in columns})


KEYS = {
    "gold_monthly_country_finance": ("month_start", "country_code"),
    "gold_route_profitability": ("month_start", "route_id"),
    "gold_customer_profitability": ("month_start", "customer_id"),
    "gold_budget_vs_actual": ("month_start", "cost_center_id"),
}


#: The column of facts that carry their shipments.
CARRIED = "_shipments"


def _rows(frame: DataFrame, key: str, **columns: str) -> DataFrame:
    return frame.select("month_start", key, *[F.col(c).alias(name) for name, c in columns.items()])


def _dated(frame: DataFrame, date: str) -> DataFrame:
    return frame.withColumn("month_start", expr.month(F.col(date)))


def _metrics(rows: dict[str, DataFrame], keys: Sequence[str]) -> list[DataFrame]:
    """Each fact's rows by key: sums of its values; of shipments how many, and the least one's country if it is a value."""
    out = []
    for fact, frame in rows.items():
        if fact == "shipments":
            least = [F.min_by("country_code", "shipment_id").alias("country_code")] if "country_code" not in keys and "country_code" in frame.columns else []
            out.append(frame.groupBy(*keys).agg(F.countDistinct("shipment_id").alias("shipment_count"), *least))
        else:
            out.append(_sum(frame, keys, **{c: c for c in frame.columns if c not in keys}))
    return out


def with_shipments(s: dict[str, DataFrame], keep: Callable[[DataFrame], DataFrame]) -> dict[str, DataFrame]:
    """Silver whose invoices and costs carry the shipments of their id as an array, for products that are all made at once: each fact is
    joined with its shipments once, of which `keep` then holds what products read. Facts aren't multiplied or left out."""
    of = s["shipments"].groupBy("shipment_id").agg(F.collect_list(F.struct("route_id", "customer_id")).alias(CARRIED))
    columns = {
        "invoices": ["invoice_date", "currency_code", "country_code", "customer_id", "revenue_amount", "amount_eur"],
        "operational_costs": ["posting_date", "currency_code", "country_code", "route_id", "cost_center_id", "amount", "amount_eur"],
    }
    return s | {n: keep(s[n].join(of, "shipment_id", "left").select(*c, CARRIED)) for n, c in columns.items()}


def _shipped(facts: DataFrame, s: dict[str, DataFrame], *columns: str) -> DataFrame:
    """Facts whose shipment is in Silver, with columns of it."""
    if CARRIED not in facts.columns:
        return facts.join(s["shipments"].select("shipment_id", *columns), "shipment_id")
    out = facts.select(*[c for c in facts.columns if c not in (CARRIED, *columns)], F.explode(CARRIED).alias("_shipment"))
    return out.withColumns({c: F.col(f"_shipment.{c}") for c in columns}).drop("_shipment")


def monthly_rows(s: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """What the product adds up, by fact: rows of its keys and values. The same for the other products."""
    opening = month_open(s["exchange_rates"])
    invoices = with_fx_impact(_shipped(s["invoices"], s), "invoice_date", "revenue_amount", opening)
    costs = with_fx_impact(_shipped(s["operational_costs"], s), "posting_date", "amount", opening)
    budgets = _dated(s["budgets"], "month_start").join(s["cost_centers"].select("cost_center_id", "country_code"), "cost_center_id")
    return {
        "invoices": _rows(invoices, "country_code", total_revenue_eur="amount_eur", fx_r="fx_impact_eur"),
        "operational_costs": _rows(costs, "country_code", total_operational_cost_eur="amount_eur", fx_c="fx_impact_eur"),
        "shipments": _rows(_dated(s["shipments"], "shipment_date"), "country_code", shipment_id="shipment_id"),
        "budgets": _rows(budgets, "country_code", budget_amount_eur="amount_eur"),
    }


def monthly_finished(out: DataFrame, s: dict[str, DataFrame]) -> DataFrame:
    """The product's rows from its sums. The same for the other products."""
    out = _zeros(out, "total_revenue_eur", "total_operational_cost_eur", "fx_r", "fx_c", "budget_amount_eur").fillna(0, ["shipment_count"])
    out = out.withColumns(margin()).withColumns(variance("budget_amount_eur", "total_operational_cost_eur"))
    return out.select(
        *KEYS["gold_monthly_country_finance"],
        "total_revenue_eur",
        "total_operational_cost_eur",
        "gross_profit_eur",
        "gross_margin_pct",
        "shipment_count",
        expr.per_unit(F.col("total_revenue_eur"), F.col("shipment_count")).alias("revenue_per_shipment_eur"),
        expr.per_unit(F.col("total_operational_cost_eur"), F.col("shipment_count")).alias("cost_per_shipment_eur"),
        "budget_amount_eur",
        "budget_variance_amount_eur",
        "budget_variance_pct",
        expr.money(F.col("fx_r") - F.col("fx_c")).alias("fx_impact_eur"),
    )


def route_rows(s: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Revenue through the shipment's route, cost through the cost row's own."""
    revenue = _shipped(_dated(s["invoices"], "invoice_date"), s, "route_id")
    return {
        "invoices": _rows(revenue, "route_id", total_revenue_eur="amount_eur"),
        "operational_costs": _rows(_dated(s["operational_costs"], "posting_date"), "route_id", allocated_operational_cost_eur="amount_eur"),
        "shipments": _rows(_dated(s["shipments"], "shipment_date"), "route_id", shipment_id="shipment_id"),
    }


def _profit(out: DataFrame) -> DataFrame:
    out = _zeros(out, "total_revenue_eur", "allocated_operational_cost_eur").fillna(0, ["shipment_count"])
    return out.withColumns(margin(cost="allocated_operational_cost_eur"))


def route_finished(out: DataFrame, s: dict[str, DataFrame]) -> DataFrame:
    out = _profit(out).join(s["routes"].select("route_id", "origin_country_code", "destination_country_code", "transport_mode"), "route_id")
    return out.select(*KEYS["gold_route_profitability"], "origin_country_code", "destination_country_code", "transport_mode", "shipment_count", "total_revenue_eur", "allocated_operational_cost_eur", "gross_profit_eur", "gross_margin_pct")


def customer_rows(s: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Revenue by the invoice's customer, cost by the shipment's."""
    cost = _shipped(_dated(s["operational_costs"], "posting_date"), s, "customer_id")
    return {
        "invoices": _rows(_dated(s["invoices"], "invoice_date"), "customer_id", total_revenue_eur="amount_eur"),
        "operational_costs": _rows(cost, "customer_id", allocated_operational_cost_eur="amount_eur"),
        "shipments": _rows(_dated(s["shipments"], "shipment_date"), "customer_id", shipment_id="shipment_id", country_code="country_code"),
    }


def customer_finished(out: DataFrame, s: dict[str, DataFrame]) -> DataFrame:
    return _profit(out).select(*KEYS["gold_customer_profitability"], "country_code", "shipment_count", "total_revenue_eur", "allocated_operational_cost_eur", "gross_profit_eur", "gross_margin_pct")


def budget_rows(s: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "budgets": _rows(_dated(s["budgets"], "month_start"), "cost_center_id", budget_amount_eur="amount_eur"),
        "operational_costs": _rows(_dated(s["operational_costs"], "posting_date"), "cost_center_id", actual_cost_eur="amount_eur"),
    }


def budget_finished(out: DataFrame, s: dict[str, DataFrame]) -> DataFrame:
    out = _zeros(out, "budget_amount_eur", "actual_cost_eur").withColumns(variance("budget_amount_eur", "actual_cost_eur"))
    out = out.join(s["cost_centers"].select("cost_center_id", "country_code"), "cost_center_id")
    return out.select(*KEYS["gold_budget_vs_actual"], "country_code", "budget_amount_eur", "actual_cost_eur", "budget_variance_amount_eur", "budget_variance_pct")


def monthly_country_finance(s: dict[str, DataFrame]) -> DataFrame:
    keys = KEYS["gold_monthly_country_finance"]
    return monthly_finished(spine(_metrics(monthly_rows(s), keys), keys), s)


def route_profitability(s: dict[str, DataFrame]) -> DataFrame:
    keys = KEYS["gold_route_profitability"]
    return route_finished(spine(_metrics(route_rows(s), keys), keys), s)


def customer_profitability(s: dict[str, DataFrame]) -> DataFrame:
    """Country of the month's least shipment, if any."""
    keys = KEYS["gold_customer_profitability"]
    return customer_finished(spine(_metrics(customer_rows(s), keys), keys), s)


def budget_vs_actual(s: dict[str, DataFrame]) -> DataFrame:
    keys = KEYS["gold_budget_vs_actual"]
    budgets, actual = _metrics(budget_rows(s), keys)
    return budget_finished(budgets.join(actual, list(keys), "full"), s)


def data_quality_summary(quality: DataFrame) -> DataFrame:
    return quality.where(~F.col("rule_name").startswith("SOURCE_TARGET_")).select("batch_id", "affected_dataset", "rule_name", "validation_status", "failure_reason", "failed_row_count", "affected_financial_amount_eur")


PRODUCTS = {
    "gold_monthly_country_finance": monthly_country_finance,
    "gold_route_profitability": route_profitability,
    "gold_customer_profitability": customer_profitability,
    "gold_budget_vs_actual": budget_vs_actual,
}
#: By product, its rows by fact, and the product from its sums.
ROWS = dict(zip(PRODUCTS, (monthly_rows, route_rows, customer_rows, budget_rows), strict=True))
FINISHED = dict(zip(PRODUCTS, (monthly_finished, route_finished, customer_finished, budget_finished), strict=True))


def reconcile(s: dict[str, DataFrame], gold: dict[str, DataFrame]) -> DataFrame:
    """(control, expected, actual, matches): Gold totals against Silver's, and one row per key. A row for each of eight controls."""

    def one(frame: DataFrame, column: str) -> DataFrame:
        return frame.agg(expr.zero(F.sum(column)).alias("v"))

    def count(frame: DataFrame, *keys: str) -> tuple[DataFrame, DataFrame]:
        return frame.agg(F.count("*").cast(expr.MONEY).alias("v")), frame.select(*keys).distinct().agg(F.count("*").cast(expr.MONEY).alias("v"))

    month, route, customer, budget = (gold[k] for k in PRODUCTS)
    pairs = {
        "monthly_revenue": (one(s["invoices"], "amount_eur"), one(month, "total_revenue_eur")),
        "monthly_cost": (one(s["operational_costs"], "amount_eur"), one(month, "total_operational_cost_eur")),
        "monthly_budget": (one(s["budgets"], "amount_eur"), one(month, "budget_amount_eur")),
        "route_revenue": (one(s["invoices"], "amount_eur"), one(route, "total_revenue_eur")),
        "route_cost": (one(s["operational_costs"], "amount_eur"), one(route, "allocated_operational_cost_eur")),
        "customer_revenue": (one(s["invoices"], "amount_eur"), one(customer, "total_revenue_eur")),
        "budget_actual": (one(s["operational_costs"], "amount_eur"), one(budget, "actual_cost_eur")),
        "monthly_keys": count(month, "month_start", "country_code"),
    }
    rows = [e.select(F.lit(name).alias("control"), F.col("v").alias("expected")).join(a.select(F.col("v").alias("actual")), F.lit(True)) for name, (e, a) in pairs.items()]
    return reduce(DataFrame.unionByName, rows).withColumn("matches", F.col("expected") == F.col("actual"))
