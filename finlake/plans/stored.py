"""Queries over what was written: tables are written to the shared folder, changed there and read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finlake.functions import expr
from finlake.operators import bitmaps, deltas, membership, multiset, ownership
from finlake.plans import analogue, buckets, claims
from finlake.plans.analogue import sql_ratio, sql_zero
from finlake.plans.catalogue import _CLAIM_SQL, _MONTHLY, _sql_payload, _sql_per, query, read
from finlake.plans.store import Store
from finlake.sources import csv_ranges, scratch


@query("SELECT CAST(doc_id AS VARCHAR) AS doc_id, source, CAST(length(coalesce(text, '')) AS BIGINT) AS n_chars, sha256(coalesce(text, '')) AS text_sha256 FROM documents")
def csv_splits(spark: SparkSession, d: str) -> DataFrame:
    """Texts with quotes and line breaks, written as CSV and read in ranges."""
    path, columns = scratch.folder(spark), ["doc_id", "source", "text"]
    read(spark, d, "documents").select(*columns).write.options(header=True, escape='"', emptyValue="", nullValue="\\N").csv(path)
    text = F.coalesce("text", F.lit(""))
    return csv_ranges.read(spark, path, columns, null="\\N").select("doc_id", "source", F.length(text).cast("long").alias("n_chars"), F.sha2(F.encode(text, "UTF-8"), 256).alias("text_sha256"))


#: Deliveries by name and arrival: which orders' invoices each holds (remainder of the order's number, and whether it is that or
#: any other), and what it adds to their amount.
DELIVERIES = {
    "d1": (1, [("% 3 <> 0", 0)]),
    "d2": (2, [("% 3 = 0", 0), ("% 11 = 1", 0), ("% 13 = 2", 1)]),
    "d3": (3, [("% 3 = 0", 0), ("% 11 = 1", 0), ("% 17 = 5", 0)]),
    "d4": (4, [("% 19 = 3", 1), ("% 17 = 5", 0)]),
}
_ACTIVE_SQL = " UNION ALL ".join(f"SELECT * REPLACE ('{b}' AS _batch_id, CAST(revenue_amount + {more} AS DECIMAL(20,2)) AS revenue_amount), {a} AS arrival FROM base WHERE o {part}" for b, (a, parts) in DELIVERIES.items() if b != "d2" for part, more in parts)


@query(f"""WITH base AS (SELECT * EXCLUDE (fx, open_eur, m), CAST(split_part(invoice_id, '-', 1) AS BIGINT) AS o FROM inv), rows AS ({_ACTIVE_SQL}), hashed AS (SELECT *, {_CLAIM_SQL} AS h FROM rows),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY _batch_id, invoice_id ORDER BY h) AS r FROM hashed),
    judged AS (SELECT *, min(h) OVER one <> max(h) OVER one AS differs, row_number() OVER (PARTITION BY invoice_id ORDER BY arrival, _batch_id, r) AS nth, first_value(_batch_id) OVER (PARTITION BY invoice_id ORDER BY arrival, _batch_id, r) AS owner
        FROM numbered WINDOW one AS (PARTITION BY invoice_id))
    SELECT invoice_id, _batch_id AS batch, CASE WHEN differs THEN 'CONFLICTING_DUPLICATE_INVOICE' WHEN nth = 1 THEN '' WHEN owner = _batch_id THEN 'DUPLICATE_INVOICE' ELSE 'CROSS_BATCH_DUPLICATE_INVOICE' END AS reason,
        count(*) AS n, {sql_zero('sum(amount_eur)')} AS amount FROM judged GROUP BY ALL""")
def claims_incremental(spark: SparkSession, d: str) -> DataFrame:
    """Four deliveries one after another, each settled in the buckets that it touches; the third supersedes the second."""
    store, state = Store(spark, scratch.folder(spark)), {"version": 0, "tables": {}, "batches": {}, "watermark": None}
    # Numbered where the lines of a shipment are together already. A delivery's copies of an id are alike, or all of them conflict, so
    # any numbers that tell them apart will do.
    nth = F.row_number().over(Window.partitionBy("shipment_id", "invoice_id").orderBy("revenue_amount"))
    base = scratch.kept(analogue.silver(spark, d)["invoices"].select(*ownership.CLAIM_FIELDS).withColumn("nth", nth))
    order = F.split_part("invoice_id", F.lit("-"), F.lit(1)).cast("long")
    arrivals: dict[str, int] = {}
    for batch, (arrival, parts) in DELIVERIES.items():
        replaced = "d2" if batch == "d3" else None
        rows = None
        for i, (part, more) in enumerate(parts):
            left, is_equal, right = part.split(" ")[1], part.split(" ")[2] == "=", part.split(" ")[3]
            rest = order % int(left)
            some = base.where(rest == int(right) if is_equal else rest != int(right)).withColumn("revenue_amount", (F.col("revenue_amount") + more).cast(expr.MONEY))
            some = some.withColumn("_source_row_number", F.col("nth") * len(parts) + i)
            rows = some if rows is None else rows.unionByName(some)
        # A claim is settled by its digest, kept as bytes; of its contents only the amount is reported.
        digest = F.unhex("claim_hash").alias("claim_hash")
        rows = ownership.claim_hash(rows).select("invoice_id", F.lit(batch).alias("_batch_id"), "_source_row_number", digest, "amount_eur", F.lit(None).cast("array<string>").alias("_reasons"))
        arrivals = {b: a for b, a in arrivals.items() if b != replaced} | {batch: arrival}
        touched, mine = claims.put(store, state, batch, rows, replaced, rebalanced=False)
        state["batches"].pop(replaced, None)
        state["batches"][batch] = {"arrival": arrival, "claim_buckets": mine}
        claims.settle(store, state, arrivals, touched)
    # A trusted invoice is one row.
    trusted = store.read(state, claims.TRUSTED).select("invoice_id", F.col("_batch_id").alias("batch"), F.lit("").alias("reason"), F.lit(1).cast("long").alias("n"), expr.zero(F.col("amount_eur")).alias("amount"))
    away = store.read(state, claims.AWAY).groupBy("invoice_id", F.col("_batch_id").alias("batch"), F.col("_reason_codes").alias("reason")).agg(F.count("*").alias("n"), expr.zero(F.sum("amount_eur")).alias("amount"))
    return trusted.unionByName(away)


@query("""WITH s AS (SELECT shipment_id, shipment_date, revenue_amount, amount_eur, CAST(shipment_id AS BIGINT) AS k FROM ship), t AS (SELECT * FROM s WHERE k % 10 <> 3),
    src AS (SELECT shipment_id, shipment_date, revenue_amount, CASE WHEN k % 5 = 1 THEN CAST(amount_eur + 1 AS DECIMAL(20,2)) ELSE amount_eur END AS amount_eur FROM s WHERE k % 7 <> 2 AND shipment_date >= DATE '1996-01-01')
    SELECT shipment_id, coalesce(src.revenue_amount, t.revenue_amount) AS original_amount, coalesce(src.amount_eur, t.amount_eur) AS amount_eur FROM t FULL JOIN src USING (shipment_id)
    WHERE src.shipment_id IS NOT NULL OR t.shipment_date < DATE '1996-01-01'""")
def fact_merge(spark: SparkSession, d: str) -> DataFrame:
    """A fact of shipments, then a later extract of the months from 1996 on: changed rows are updated, new ones inserted, and
    those of these months that it lacks deleted."""
    store, state = Store(spark, scratch.folder(spark)), {"version": 0, "tables": {}, "batches": {}, "watermark": None}
    key, late = F.col("shipment_id").cast("long"), F.col("shipment_date") >= F.lit("1996-01-01").cast("date")
    fact = scratch.kept(analogue.silver(spark, d)["shipments"].select("shipment_id", "shipment_date", "revenue_amount", "amount_eur"))
    buckets.merge_into(store, state, "fact_shipment", fact.where(key % 10 != 3), ["shipment_id"])
    changed = F.when(key % 5 == 1, F.col("amount_eur") + 1).otherwise(F.col("amount_eur")).cast(expr.MONEY)
    buckets.merge_into(store, state, "fact_shipment", fact.where((key % 7 != 2) & late).withColumn("amount_eur", changed), ["shipment_id"], delete=late)
    return store.read(state, "fact_shipment").select("shipment_id", F.col("revenue_amount").alias("original_amount"), "amount_eur")


@query("""WITH held AS (SELECT DISTINCT year(o_orderdate) AS part, o_custkey FROM orders), asked AS (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 450000 AND o_orderdate >= DATE '1998-06-01')
    SELECT CAST(part AS INTEGER) AS part, count(*) AS n FROM held JOIN asked USING (o_custkey) GROUP BY 1""")
def collision_pruned(spark: SparkSession, d: str) -> DataFrame:
    """Customers that parts of earlier years hold already, looked for only in parts whose filter may hold one of them."""
    held = read(spark, d, "orders").select(F.year("o_orderdate").alias("part"), "o_custkey", "o_totalprice", "o_orderdate")
    asked = held.where((F.col("o_totalprice") > 450000) & (F.col("o_orderdate") >= F.lit("1998-06-01").cast("date"))).select("o_custkey").distinct()
    rows = held.select("part", "o_custkey").distinct()
    parts = membership.may_hold(membership.filters(rows, ["o_custkey"], ["part"]), asked, ["o_custkey"], ["part"])
    return rows.join(parts, "part", "left_semi").join(asked, "o_custkey", "left_semi").groupBy("part").agg(F.count("*").alias("n"))


#: Distinct shipments by these, all from one stored aggregate.
GROUPINGS = {"all": [], "month": ["month_start"], "country": ["country_code"], "month, country": ["month_start", "country_code"], "customer": ["customer_id"]}
_STORED_BY = ["month_start", "country_code", "customer_id", "cost_center_id"]


@query("WITH f AS (SELECT m AS month_start, country_code, customer_id, shipment_id FROM inv) " + " UNION ALL ".join(f"SELECT '{name}' AS by_what, concat_ws('/', {', '.join(f'CAST({c} AS VARCHAR)' for c in by) or chr(39) * 2}) AS of, count(DISTINCT shipment_id) AS shipments FROM f{' GROUP BY ALL' if by else ''}" for name, by in GROUPINGS.items()))
def distinct_bitmap(spark: SparkSession, d: str) -> DataFrame:
    """Distinct invoiced shipments, stored once by month, country, customer and cost centre."""
    facts = analogue.silver(spark, d)["invoices"].withColumn("month_start", expr.month(F.col("invoice_date")))
    held = scratch.kept(bitmaps.stored(facts, "shipment_id", _STORED_BY))
    one = lambda name, by: bitmaps.counted(held, by, "shipments").select(F.lit(name).alias("by_what"), F.concat_ws("/", *[F.col(c).cast("string") for c in by]).alias("of"), "shipments")
    return reduce(DataFrame.unionByName, [one(name, by) for name, by in GROUPINGS.items()])


@query(f"""WITH {_MONTHLY} SELECT m AS month_start, country_code, r AS total_revenue_eur, c AS total_operational_cost_eur, CAST(r - c AS DECIMAL(20,2)) AS gross_profit_eur,
    {sql_ratio('r - c', 'r')} AS gross_margin_pct, s AS shipment_count, {_sql_per('r')} AS revenue_per_shipment_eur, {_sql_per('c')} AS cost_per_shipment_eur, b AS budget_amount_eur,
    CAST(b - c AS DECIMAL(20,2)) AS budget_variance_amount_eur, {sql_ratio('b - c', 'b')} AS budget_variance_pct, fx AS fx_impact_eur FROM g""")
def gold_delta(spark: SparkSession, d: str) -> DataFrame:
    """The monthly product after two deliveries and a correction of the second, by signed rows alone: the second delivery has its
    shipments' amounts and countries wrong, lacks a month's rates, and the correction sets that right."""
    product = "gold_monthly_country_finance"
    late = {"shipments": F.col("shipment_id").cast("long") % 3 == 0, "invoices": F.crc32("invoice_id") % 3 == 0, "operational_costs": F.crc32("cost_id") % 3 == 0, "budgets": F.crc32("cost_center_id") % 3 == 0}
    # Of each table just the columns that the product reads, and which delivery a row comes with.
    columns = {
        "shipments": ["shipment_id", "shipment_date", "country_code", "amount_eur"],
        "invoices": ["shipment_id", "invoice_date", "currency_code", "country_code", "revenue_amount", "amount_eur"],
        "operational_costs": ["shipment_id", "posting_date", "currency_code", "country_code", "amount", "amount_eur"],
        "budgets": ["month_start", "cost_center_id", "amount_eur"],
        "cost_centers": ["cost_center_id", "country_code"],
        "exchange_rates": ["rate_date", "currency_code", "rate_to_eur"],
    }
    silver = analogue.silver(spark, d)
    right = {n: scratch.kept(silver[n].select(*c, *([late[n].alias("late")] if n in late else []))) for n, c in columns.items()}
    late = dict.fromkeys(late, F.col("late"))
    first, second = ({n: right[n].where(c if is_late else ~c) for n, c in late.items()} for is_late in (False, True))
    wrong = {n: f.withColumn("amount_eur", (F.col("amount_eur") + 7).cast(expr.MONEY)) for n, f in second.items()}
    wrong["shipments"] = wrong["shipments"].where(F.col("shipment_id").cast("long") % 2 == 0).withColumn("country_code", F.lit("N0"))
    rates = right["exchange_rates"].where(F.dayofmonth("rate_date") > 1)
    none = {n: f.limit(0) for n, f in right.items()}
    centers = right["cost_centers"].withColumn("country_code", F.lit("N1"))

    def step(kept: dict, minus: dict, plus: dict, references: tuple) -> dict[str, deltas.Change]:
        facts = {n: deltas.Change(kept[n], minus[n], plus[n]) for n in late}
        return facts | {n: deltas.Change(none[n], a, b) for n, (a, b) in zip(("exchange_rates", "cost_centers"), references, strict=True)}

    steps = [
        step(none, none, first, ((none["exchange_rates"], rates), (none["cost_centers"], centers))),
        step(first, none, wrong, ((rates, rates), (centers, centers))),
        step(first, wrong, second, ((rates, right["exchange_rates"]), (centers, right["cost_centers"]))),
    ]
    held = None
    for changes in steps:
        held = scratch.kept(deltas.applied(product, held, deltas.signed(product, changes), changes))
    return deltas.product_of(product, held, right)


_ROW_SQL = " || ".join(f"sha256({_sql_payload('o_custkey', 'o_orderkey', 'o_orderpriority', 'o_orderstatus')} || '{i}')" for i in range(multiset.WIDTH // 64))
_LANES_SQL = " || ".join(f"lpad(lower(printf('%x', CAST(sum(CAST(('0x' || substring(digest, {8 * i + 1}, 8)) AS HUGEINT) * {1 << 32} + CAST(('0x' || substring(digest, {8 * i + 9}, 8)) AS HUGEINT)) % {1 << 64} AS UBIGINT))), 16, '0')" for i in range(0, 2 * multiset.LANES, 2))


@query(f"SELECT o_orderstatus, count(*) AS n, {_LANES_SQL} AS digest FROM (SELECT o_orderstatus, {_ROW_SQL} AS digest FROM orders) GROUP BY 1")
def set_digests(spark: SparkSession, d: str) -> DataFrame:
    """Digests of sets of orders, each put together from those of its customers' buckets: no row is digested twice."""
    rows = read(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus")
    each = rows.select("o_orderstatus", (F.col("o_custkey") % 16).alias("part"), multiset.row_digest(*[F.col(c) for c in rows.columns]).alias("digest"))
    parts = each.groupBy("o_orderstatus", "part").agg(F.count("*").alias("n"), multiset.total(F.col("digest")).alias("digest"))
    return parts.groupBy("o_orderstatus").agg(F.sum("n").alias("n"), multiset.total(F.col("digest")).alias("digest"))


#: Buckets of the two copies of orders.
COMPARED_IN = 512


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 2003 = 7 THEN 'missing' WHEN o_orderkey % 1511 = 5 THEN 'added' ELSE 'changed' END AS what FROM orders
    WHERE o_orderkey % 2003 = 7 OR o_orderkey % 1511 = 5 OR o_orderkey % 1009 = 3""")
def attest_located(spark: SparkSession, d: str) -> DataFrame:
    """Orders and a copy that lacks some, has others only by itself and has the price of a third kind wrong: found by two stored trees,
    from the root down, and then among the rows of the leaves that differ."""
    key = F.col("o_orderkey")
    orders = read(spark, d, "orders")
    missing, added = key % 2003 == 7, (key % 1511 == 5) & (key % 2003 != 7)
    one, other = orders.where(~added), orders.where(~missing).withColumn("o_totalprice", F.when(~added & (key % 1009 == 3), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).cast(orders.schema["o_totalprice"].dataType))
    trees = [scratch.kept(multiset.tree(multiset.leaves(x, ["o_orderkey"], COMPARED_IN), COMPARED_IN)) for x in (one, other)]
    return multiset.altered(one, other, ["o_orderkey"], COMPARED_IN, multiset.differing(*trees, COMPARED_IN))
