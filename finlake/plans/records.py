"""Which deliveries' parts may hold a delivery's business keys, by filters that are kept beside the parts.

Every Silver part of facts has a filter of its keys (about 1.25 bytes a key) in the table `record_keys`. A later delivery asks
all filters for its keys and reads only the parts that answer; whether a key is really there is then decided by a join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.contracts import DATASETS
from finlake.operators import membership
from finlake.plans.store import Store

TABLE, KEYS = "record_keys", ["dataset", "part", "slice"]


def _keys(frames: dict[str, DataFrame]) -> DataFrame:
    """dataset and a hash of the business key, of all frames together."""
    return reduce(DataFrame.unionByName, [f.select(F.lit(n).alias("dataset"), F.xxhash64(F.lit(n), *DATASETS[n].key).alias("k")) for n, f in frames.items()])


def filters(frames: dict[str, DataFrame], batch: str) -> DataFrame:
    """The filters of a delivery's parts of some datasets."""
    return membership.filters(_keys(frames).withColumn("part", F.lit(batch)), ["k"], ["dataset", "part"])


def parts_to_read(store: Store, state: dict, batch: str, frames: dict[str, DataFrame]) -> dict[str, list[str]]:
    """By dataset, the other deliveries' Silver parts that may hold a key of `frames`; parts without a filter are always among
    them. At most one name per delivery and dataset comes to the driver, as the state has."""
    known = [p for p in state["tables"].get(TABLE, {}) if p != batch]
    out = {n: [p for p in state["tables"].get(f"silver_{n}", {}) if p != batch and p not in known] for n in frames}
    if known:
        held = store.read(state, TABLE, among=known)
        for r in membership.may_hold(held, _keys(frames), ["k"], ["dataset", "part"]).collect():
            out[r["dataset"]].append(r["part"])
    return out
