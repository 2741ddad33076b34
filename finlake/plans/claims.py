"""Invoice claims of all deliveries, resolved again only where a delivery changes them.

Who owns an invoice depends on its own claims and on the order of arrivals, and on nothing else. So claims and what came of
them (trusted invoices, quarantined claims) lie in buckets of the invoice id; a delivery touches the buckets of its own ids
and of those that it, or the delivery that it supersedes, had before, and only these are read, resolved and written.
"""

from __future__ import annotations

import copy

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.functions import expr
from finlake.operators import ownership
from finlake.plans import buckets
from finlake.plans.store import ALL, ClaimsIntegrityError, Store

BY = ["invoice_id"]
CLAIM_KEYS = ["invoice_id", "_batch_id", "_source_row_number"]
CLAIMS, TRUSTED, AWAY = "claims", "silver_invoices", "quarantine_invoice_claims"
#: Slices that a bucket is resolved in: an invoice's claims are in one, and a task has few buckets' files to write.
SLICES = 32


def with_arrival(claims: DataFrame, arrivals: dict[str, int]) -> DataFrame:
    """Batches are deliveries: a short list, held on the driver as the store's state. Rows of no batch in it go."""
    order = claims.sparkSession.createDataFrame(list(arrivals.items()), "_batch_id string, arrival int")
    return claims.join(order, "_batch_id")


def n_buckets(state: dict, wanted: int = buckets.BUCKETS) -> int:
    """The store's number of buckets, which its first delivery sets."""
    return state.setdefault("claim_buckets", wanted)


def held_by(state: dict, *batches: str | None) -> list[int]:
    """The buckets that these batches' claims lie in, as recorded."""
    return sorted({k for b in batches if b for k in state["batches"].get(b, {}).get("claim_buckets", [])})


def verify(store: Store, state: dict, touched: list[int] | None) -> None:
    """All buckets' files, and the rows of those that a run is going to read (None: of all)."""
    if wrong := buckets.verify(store, state, CLAIMS, touched):
        raise ClaimsIntegrityError(f"PRIOR_ARTIFACT_INTEGRITY_FAILED: claims: {', '.join(wrong)}")


def resolved(store: Store, state: dict, arrivals: dict[str, int], touched: list[int]) -> DataFrame:
    """Claims of the touched buckets with `_reasons`, dealt by bucket and slice: one shuffle."""
    found = with_arrival(buckets.read(store, state, CLAIMS, touched), arrivals)
    dealt = {"_bucket": buckets.bucket_of(BY, n_buckets(state)), "_slice": F.pmod(F.hash(*BY), F.lit(SLICES))}
    found = found.withColumns(dealt).repartition(*dealt)
    return ownership.resolve_claims(found, within=tuple(dealt)).drop("claim_hash", "arrival", *dealt)


def put(store: Store, state: dict, batch: str, rows: DataFrame, replaced: str | None = None, gone: list[int] | None = None, rebalanced: bool = True) -> tuple[list[int], list[int]]:
    """Claims of `batch` (with claim_hash) take the place of those that it and `replaced` had, in `state`. `gone` are the buckets
    these had (by default as recorded). The touched buckets, and those of the batch. `rebalanced` is as in `buckets.stage`: deliveries
    that are large beside the history are better off without."""
    n = n_buckets(state)
    older = buckets.others(state, CLAIMS)
    mine = sorted(buckets.buckets_in(rows, BY, n))
    touched = list(range(n)) if older else sorted({*mine, *(held_by(state, batch, replaced) if gone is None else gone)})
    verify(store, state, touched)
    before = store.read(state, CLAIMS, like=rows) if older else buckets.read(store, state, CLAIMS, touched, like=rows)
    left = before.where(~F.col("_batch_id").isin(*[b for b in (batch, replaced) if b]))
    buckets.stage(store, state, CLAIMS, left.select(*rows.columns).unionByName(rows), BY, n, touched, CLAIM_KEYS, rebalanced)
    for p in older:  # written by delivery, before there were buckets
        state["tables"][CLAIMS].pop(p)
    return touched, mine


def settle(store: Store, state: dict, arrivals: dict[str, int], touched: list[int]) -> DataFrame:
    """Resolves the touched buckets and stages what came of it; their resolved claims."""
    n = n_buckets(state)
    found = resolved(store, state, arrivals, touched)
    # What became of a claim is found once: both tables are written by one pass, and a task has few buckets.
    judged = found.withColumn("_reason_codes", expr.joined(F.col("_reasons")))
    kept, rest = F.size("_reasons") == 0, [c for c in found.columns if c != "_reasons"]
    tables = {TRUSTED: (kept, rest, BY), AWAY: (~kept, [*rest, "_reason_codes"], CLAIM_KEYS)}
    buckets.stage_apart(store, state, judged, tables, BY, n, touched, rebalanced=False)
    for table in tables:
        state["tables"][table].pop(ALL, None)
    return found


def rebucket(spark: SparkSession, root: str, n: int) -> None:
    """Lays a store's claims and what came of them out in another number of buckets, and publishes that."""
    store = Store(spark, root)
    state = store.state()
    verify(store, state, None)
    new = copy.deepcopy(state) | {"claim_buckets": n}
    for table, keys in ((CLAIMS, CLAIM_KEYS), (TRUSTED, BY), (AWAY, CLAIM_KEYS)):
        if table in state["tables"]:
            rows = store.read(state, table)
            new["tables"][table] = {}
            buckets.stage(store, new, table, rows, BY, n, range(n), keys)
    for b, held in new["batches"].items():
        if "claim_buckets" in held:
            held["claim_buckets"] = sorted(buckets.buckets_in(store.read(new, CLAIMS).where(F.col("_batch_id") == b), BY, n))
    store.commit(new)
