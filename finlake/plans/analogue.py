"""The finance datasets built from the driver's tables, in Spark and as common table expressions for the oracle.

Some rows are made unfit on purpose (missing or unknown identifiers and currencies, volumes of zero, a month without
rates, cost types outside the domain), so that every rule has something to find.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.functions import expr

FIRST_DAY, LAST_DAY = "1995-01-01", "2001-12-31"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _dec(c: Column) -> Column:
    return c.cast("decimal(18,2)")


def _n(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), c.cast("string"))


def frames(spark: SparkSession, sf_dir: str, owned: bool = True) -> dict[str, DataFrame]:
    """Typed datasets, before any rule. If not `owned`, the lines' orders are left for the reader to join: `owners` (shipment_id,
    customer_id) has them, and invoices have no customer_id."""
    t = {n: _read(spark, sf_dir, n) for n in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")}
    # Row counts come from file footers; they stand for the modulus of the invented references.
    n_parts, n_centers = t["part"].count(), t["supplier"].count()
    days = spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(FIRST_DAY)), F.to_date(F.lit(LAST_DAY)))).alias("rate_date"))
    rate = (F.lit(1) + F.col("r_regionkey") * F.lit("0.1").cast("decimal(2,1)") + F.dayofmonth("rate_date") * F.lit("0.0011").cast("decimal(5,4)")).cast(expr.RATE)
    gap = (F.col("r_regionkey") == 3) & (F.trunc("rate_date", "month") == F.lit("1997-03-01").cast("date"))
    out = {
        "currencies": t["region"].select(_n("C", F.col("r_regionkey")).alias("currency_code"), F.col("r_name").alias("currency_name"), F.lit(2).alias("decimal_places")),
        "countries": t["nation"].select(_n("N", F.col("n_nationkey")).alias("country_code"), F.col("n_name").alias("country_name"), _n("C", F.col("n_regionkey")).alias("default_currency")),
        "exchange_rates": days.join(t["region"], F.lit(True)).where(~gap).select("rate_date", _n("C", F.col("r_regionkey")).alias("currency_code"), rate.alias("rate_to_eur"), F.lit(1).alias("_source_row_number")),
        "customers": t["customer"].select(F.col("c_custkey").cast("string").alias("customer_id"), F.col("c_name").alias("customer_name"), _n("N", F.when(F.col("c_custkey") % 211 == 5, 99).otherwise(F.col("c_nationkey"))).alias("country_code")),
        "cost_centers": t["supplier"].select(F.col("s_suppkey").cast("string").alias("cost_center_id"), F.col("s_name").alias("cost_center_name"), _n("N", F.col("s_nationkey")).alias("country_code")),
        "routes": t["part"].select(
            F.col("p_partkey").cast("string").alias("route_id"),
            _n("N", F.col("p_partkey") % 25).alias("origin_country_code"),
            _n("N", F.col("p_partkey") * 7 % 25).alias("destination_country_code"),
            F.col("p_type").alias("transport_mode"),
            F.when(F.col("p_partkey") % 97 != 3, F.col("p_retailprice")).cast(expr.MONEY).alias("distance_km"),
            F.col("p_size").alias("standard_transit_days"),
        ),
    }
    key = F.col("o_orderkey")
    out["shipments"] = t["orders"].select(
        key.cast("string").alias("shipment_id"),
        F.col("o_orderdate").cast("date").alias("shipment_date"),
        F.when(key % 103 != 7, (key % n_parts).cast("string")).alias("route_id"),
        F.when(key % 40 > 0, key % 40).cast(expr.MONEY).alias("volume_m3"),
        _n("N", F.col("o_custkey") % 25).alias("country_code"),
        F.when(key % 101 != 9, F.col("o_custkey").cast("string")).alias("customer_id"),
        (F.col("o_custkey") % n_centers).cast("string").alias("cost_center_id"),
        _n("C", F.when(key % 89 == 4, 9).otherwise(key % 5)).alias("currency_code"),
        _dec(F.col("o_totalprice")).cast(expr.MONEY).alias("revenue_amount"),
    )
    # Joined by the id that facts join their shipment by, so that they are shuffled by it once.
    # What depends on the order or the supplier alone is made there, not for every line.
    owners = t["orders"].select(key.cast("string").alias("shipment_id"), F.col("o_custkey").cast("string").alias("customer_id"))
    lines = t["lineitem"].withColumn("shipment_id", F.col("l_orderkey").cast("string"))
    if owned:
        lines = lines.join(owners, "shipment_id", "left")
    else:
        out["owners"] = owners
    lines = lines.join(t["supplier"].select("s_suppkey", _n("N", F.col("s_nationkey")).alias("country_code")), F.col("l_suppkey") == F.col("s_suppkey"), "left")
    line_id = F.concat_ws("-", "shipment_id", F.col("l_linenumber").cast("string"))
    day = F.col("l_shipdate").cast("date")
    out["invoices"] = lines.select(
        line_id.alias("invoice_id"),
        "shipment_id",
        day.alias("invoice_date"),
        "country_code",
        *(["customer_id"] if owned else []),
        F.col("l_suppkey").cast("string").alias("cost_center_id"),
        _n("C", F.col("l_partkey") % 5).alias("currency_code"),
        _dec(F.col("l_extendedprice")).cast(expr.MONEY).alias("revenue_amount"),
        F.col("l_linestatus").alias("_batch_id"),
    )
    kind = F.concat("l_returnflag", "l_linestatus")
    out["operational_costs"] = lines.select(
        F.concat_ws("-", line_id, F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"), F.date_format("l_shipdate", "yyyyMMdd")).alias("cost_id"),
        "shipment_id",
        F.col("l_partkey").cast("string").alias("route_id"),
        F.col("l_suppkey").cast("string").alias("cost_center_id"),
        "country_code",
        day.alias("posting_date"),
        F.when(kind == "AF", "FUEL").when(kind == "AO", "LABOR").when(kind == "NF", "WAREHOUSING").when(kind == "NO", "TRANSPORT").when(kind == "RF", "OTHER").alias("cost_type"),
        (_dec(F.col("l_extendedprice")) * F.col("l_discount").cast("decimal(4,2)")).cast(expr.MONEY).alias("amount"),
        _n("C", F.col("l_suppkey") % 5).alias("currency_code"),
    )
    part = (_dec(F.col("o_totalprice")) * F.lit("0.2").cast("decimal(2,1)")).cast(expr.MONEY)
    center = F.col("o_custkey") % n_centers
    budget = t["orders"].groupBy(F.trunc("o_orderdate", "month").alias("month_start"), center.alias("c")).agg(F.sum(part).cast(expr.MONEY).alias("budget_amount"))
    out["budgets"] = budget.select("month_start", F.col("c").cast("string").alias("cost_center_id"), _n("C", F.col("c") % 5).alias("currency_code"), "budget_amount")
    return out


CTE = {
    "currencies": "SELECT 'C' || r_regionkey AS currency_code, r_name AS currency_name FROM region",
    "countries": "SELECT 'N' || n_nationkey AS country_code, n_name AS country_name, 'C' || n_regionkey AS default_currency FROM nation",
    "days": f"SELECT CAST(unnest(generate_series(DATE '{FIRST_DAY}', DATE '{LAST_DAY}', INTERVAL 1 DAY)) AS DATE) AS rate_date",
    "exchange_rates": """SELECT rate_date, 'C' || r_regionkey AS currency_code, CAST(1 + r_regionkey * 0.1 + day(rate_date) * 0.0011 AS DECIMAL(18,6)) AS rate_to_eur
        FROM days, region WHERE NOT (r_regionkey = 3 AND year(rate_date) = 1997 AND month(rate_date) = 3)""",
    "customers": "SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name, 'N' || CASE WHEN c_custkey % 211 = 5 THEN 99 ELSE c_nationkey END AS country_code FROM customer",
    "cost_centers": "SELECT CAST(s_suppkey AS VARCHAR) AS cost_center_id, s_name AS cost_center_name, 'N' || s_nationkey AS country_code FROM supplier",
    "routes": """SELECT CAST(p_partkey AS VARCHAR) AS route_id, 'N' || (p_partkey % 25) AS origin_country_code, 'N' || (p_partkey * 7 % 25) AS destination_country_code,
        p_type AS transport_mode, CASE WHEN p_partkey % 97 <> 3 THEN CAST(p_retailprice AS DECIMAL(20,2)) END AS distance_km, p_size AS standard_transit_days FROM part""",
    "shipments": """SELECT CAST(o_orderkey AS VARCHAR) AS shipment_id, CAST(o_orderdate AS DATE) AS shipment_date,
        CASE WHEN o_orderkey % 103 <> 7 THEN CAST(o_orderkey % (SELECT count(*) FROM part) AS VARCHAR) END AS route_id,
        CASE WHEN o_orderkey % 40 > 0 THEN CAST(o_orderkey % 40 AS DECIMAL(20,2)) END AS volume_m3, 'N' || (o_custkey % 25) AS country_code,
        CASE WHEN o_orderkey % 101 <> 9 THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
        CAST(o_custkey % (SELECT count(*) FROM supplier) AS VARCHAR) AS cost_center_id,
        'C' || CASE WHEN o_orderkey % 89 = 4 THEN 9 ELSE o_orderkey % 5 END AS currency_code, CAST(o_totalprice AS DECIMAL(18,2)) AS revenue_amount FROM orders""",
    "lines": """SELECT l.*, o_custkey, s_nationkey, l_orderkey || '-' || l_linenumber AS line_id, CAST(l_shipdate AS DATE) AS d
        FROM lineitem l LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN supplier ON l_suppkey = s_suppkey""",
    "invoices": """SELECT line_id AS invoice_id, CAST(l_orderkey AS VARCHAR) AS shipment_id, d AS invoice_date, 'N' || s_nationkey AS country_code,
        CAST(o_custkey AS VARCHAR) AS customer_id, CAST(l_suppkey AS VARCHAR) AS cost_center_id, 'C' || (l_partkey % 5) AS currency_code,
        CAST(l_extendedprice AS DECIMAL(18,2)) AS revenue_amount, l_linestatus AS _batch_id FROM lines""",
    "operational_costs": """SELECT line_id || '-' || l_partkey || '-' || l_suppkey || '-' || strftime(d, '%Y%m%d') AS cost_id, CAST(l_orderkey AS VARCHAR) AS shipment_id,
        CAST(l_partkey AS VARCHAR) AS route_id, CAST(l_suppkey AS VARCHAR) AS cost_center_id, 'N' || s_nationkey AS country_code, d AS posting_date,
        CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'FUEL' WHEN 'AO' THEN 'LABOR' WHEN 'NF' THEN 'WAREHOUSING' WHEN 'NO' THEN 'TRANSPORT' WHEN 'RF' THEN 'OTHER' END AS cost_type,
        CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS amount, 'C' || (l_suppkey % 5) AS currency_code FROM lines""",
    "budgets": """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, CAST(o_custkey % (SELECT count(*) FROM supplier) AS VARCHAR) AS cost_center_id,
        'C' || (o_custkey % (SELECT count(*) FROM supplier) % 5) AS currency_code, CAST(sum(CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.2 AS DECIMAL(20,2))) AS DECIMAL(18,2)) AS budget_amount
        FROM orders GROUP BY ALL""",
}


def euro(fact: str, date: str, amount: str) -> str:
    """SQL for a fact with its rate, EUR amount, month and FX impact."""
    return f"""SELECT f.*, r.rate_to_eur AS fx_rate_to_eur, CAST({amount} * r.rate_to_eur AS DECIMAL(20,2)) AS amount_eur, CAST(date_trunc('month', {date}) AS DATE) AS m,
        CAST({amount} * o.open_rate AS DECIMAL(20,2)) AS open_eur,
        coalesce(CAST({amount} * r.rate_to_eur AS DECIMAL(20,2)) - CAST({amount} * o.open_rate AS DECIMAL(20,2)), 0) AS fx
        FROM {fact} f JOIN exchange_rates r ON r.rate_date = {date} AND r.currency_code = f.currency_code
        LEFT JOIN opening o ON o.month_start = CAST(date_trunc('month', {date}) AS DATE) AND o.currency_code = f.currency_code"""


CTE |= {
    "opening": "SELECT CAST(date_trunc('month', rate_date) AS DATE) AS month_start, currency_code, arg_min(rate_to_eur, rate_date) AS open_rate FROM exchange_rates GROUP BY 1, 2",
    "ship": euro("shipments", "f.shipment_date", "f.revenue_amount"),
    "inv": euro("invoices", "f.invoice_date", "f.revenue_amount"),
    "cost": euro("operational_costs", "f.posting_date", "f.amount"),
    "bud": euro("budgets", "f.month_start", "f.budget_amount"),
}


def silver(spark: SparkSession, sf_dir: str, owned: bool = True) -> dict[str, DataFrame]:
    """Datasets with EUR amounts; facts without a rate are left out, no other rule applied. `owned` as in `frames`."""
    out = frames(spark, sf_dir, owned)
    rates = out["exchange_rates"].select("rate_date", "currency_code", "rate_to_eur")
    for name, date, amount in (("shipments", "shipment_date", "revenue_amount"), ("invoices", "invoice_date", "revenue_amount"), ("operational_costs", "posting_date", "amount"), ("budgets", "month_start", "budget_amount")):
        joined = out[name].join(rates.withColumnRenamed("rate_date", date).withColumnRenamed("rate_to_eur", "fx_rate_to_eur"), [date, "currency_code"])
        out[name] = joined.withColumn("amount_eur", expr.money_product(F.col(amount), F.col("fx_rate_to_eur")))
    return out


def sql(body: str) -> str:
    """`body` after the common table expressions that it needs."""
    import re

    need: list[str] = []

    def visit(text: str) -> None:
        for name in CTE:
            if name not in need and re.search(rf"\b{name}\b", text):
                visit(CTE[name])
                need.append(name) if name not in need else None

    visit(body)
    extra = body.strip()
    head = ", ".join(f"{n} AS ({CTE[n]})" for n in need)
    if extra.upper().startswith("WITH "):
        return f"WITH {head}, {extra[5:]}" if head else extra
    return f"WITH {head} {extra}" if head else extra


def sql_ratio(n: str, d: str, scale: int = 4) -> str:
    """Half-up n / d at a scale, for decimals with two places; null where d is 0. Exact integers, no doubles."""
    up = 10**scale
    step = f"CAST('{10.0**-scale:.{scale}f}' AS DECIMAL({scale + 1},{scale}))"
    nc, dc = f"CAST(round(({n}) * 100, 0) AS HUGEINT)", f"CAST(round(({d}) * 100, 0) AS HUGEINT)"
    return f"CASE WHEN ({d}) <> 0 THEN CAST(sign({nc}) * sign({dc}) * CAST((2 * abs({nc}) * {up} + abs({dc})) // (2 * abs({dc})) AS DECIMAL(24,0)) * {step} AS DECIMAL({18 if scale == 4 else 20},{scale})) END"


def sql_zero(c: str) -> str:
    return f"CAST(coalesce({c}, 0) AS DECIMAL(20,2))"
