"""Who owns a business key that several deliveries hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finlake.contracts import DATASETS
from finlake.functions import expr

CLAIM_FIELDS = ("invoice_id", "shipment_id", "invoice_date", "country_code", "customer_id", "cost_center_id", "currency_code", "revenue_amount", "fx_rate_to_eur", "amount_eur")
IGNORED = {"fx_rate_to_eur", "amount_eur"}


class CrossBatchCollision(RuntimeError):
    """Two active batches hold the same business key with different contents."""


def claim_hash(frame: DataFrame) -> DataFrame:
    return frame.withColumn("claim_hash", expr.payload(*[F.col(c) for c in CLAIM_FIELDS]))


def resolve_claims(claims: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
    """Claims with `_reasons`. If an invoice's claims differ, none is trusted; else the earliest delivery's first row
    owns it. One shuffle: every decision is a window over the invoice id. Needs claim_hash and arrival. `within` are columns
    that an invoice's claims share, by which they are dealt already: then there is no shuffle here."""
    same = Window.partitionBy(*within, "invoice_id")
    first = same.orderBy("arrival", "_batch_id", "_source_row_number")
    whole = first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = claims.withColumns({"_lo": F.min("claim_hash").over(same), "_hi": F.max("claim_hash").over(same), "_nth": F.row_number().over(first), "_owner": F.first("_batch_id").over(whole)})
    differs = F.col("_lo") != F.col("_hi")
    again = ~differs & (F.col("_nth") > 1)
    rules = [
        ("CONFLICTING_DUPLICATE_INVOICE", differs),
        ("DUPLICATE_INVOICE", again & (F.col("_owner") == F.col("_batch_id"))),
        ("CROSS_BATCH_DUPLICATE_INVOICE", again & (F.col("_owner") != F.col("_batch_id"))),
    ]
    return found.withColumn("_reasons", expr.reasons(rules)).drop("_lo", "_hi", "_nth", "_owner")


def replayed(batch: DataFrame, others: DataFrame, dataset: str) -> DataFrame:
    """`batch` with `_replay`: null if no other batch holds the key, else whether its contents are the same.
    `others` holds each key once."""
    d = DATASETS[dataset]
    content = [F.col(f) for f in d.fields if f not in IGNORED]
    held = others.select(*d.key, expr.payload(*content).alias("_held")).groupBy(*d.key).agg(F.min("_held").alias("_held"))
    mine = batch.withColumn("_mine", expr.payload(*content)).join(held, list(d.key), "left")
    return mine.withColumn("_replay", F.col("_held") == F.col("_mine")).drop("_held", "_mine")


def own_records(batch: DataFrame, others: DataFrame, dataset: str) -> DataFrame:
    """`batch` with replays quarantined; a key with other contents stops the batch."""
    seen = replayed(batch, others, dataset)
    if not seen.where((F.size("_reasons") == 0) & ~F.col("_replay")).isEmpty():
        raise CrossBatchCollision(f"{dataset}: another batch holds the same key with different contents")
    repeat = (F.size("_reasons") == 0) & F.coalesce("_replay", F.lit(False))
    return seen.withColumn("_reasons", F.when(repeat, F.array(F.lit("CROSS_BATCH_DUPLICATE_RECORD"))).otherwise(F.col("_reasons"))).drop("_replay")
