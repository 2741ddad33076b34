"""Gold of a store, kept up by what a run changed.

Each product's sums lie in buckets of its keys. A run takes the parts that its state has and the published one hasn't as rows that
came, and the other way round as rows that went; parts in both are read only for rows that a changed shipment, rate or cost centre
reaches. Buckets without a touched group keep their files.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame

from finlake.contracts import DATASETS, FACTS
from finlake.operators import deltas, gold
from finlake.plans import buckets
from finlake.plans.store import ArtifactIntegrityError, Store


def sums_of(product: str) -> str:
    return f"sums_{product.removeprefix('gold_')}"


def changes_of(store: Store, old: dict, new: dict, before: dict[str, DataFrame] | None, after: dict[str, DataFrame]) -> dict[str, deltas.Change]:
    """What changed in Silver from one state to another; references are compared as tables (None: there were none)."""
    out = {}
    for n in DATASETS:
        none = after[n].limit(0)
        if n not in FACTS:
            out[n] = deltas.Change(none, before[n].select(*after[n].columns) if before else none, after[n])
            continue
        table = f"silver_{n}"
        mine, theirs = ({p: v["path"] for p, v in s["tables"].get(table, {}).items()} for s in (new, old))
        pick = lambda state, held, others, both: store.read(state, table, among=[p for p, path in held.items() if (path in others.values()) == both], like=none)  # noqa: B023, E731
        out[n] = deltas.Change(*(f.select(*none.columns) for f in (pick(new, mine, theirs, True), pick(old, theirs, mine, False), pick(new, mine, theirs, False))))
    return out


def update(store: Store, old: dict, new: dict, before: dict[str, DataFrame] | None, after: dict[str, DataFrame], n: int = buckets.BUCKETS) -> dict[str, DataFrame]:
    """Stages the sums of all products in `new` and gives the products. `old` is the published state, `before` and `after` are the
    Silver tables of both. Where `old` has no sums yet, all rows are new."""
    if any(sums_of(p) not in old["tables"] for p in gold.PRODUCTS):
        old = old | {"tables": {}}
        before = None
        for p in gold.PRODUCTS:
            new["tables"].pop(sums_of(p), None)
    changes = changes_of(store, old, new, before, after)

    def one(product: str) -> DataFrame:
        table, keys = sums_of(product), list(gold.KEYS[product])
        count = next((p["n"] for p in old["tables"].get(table, {}).values() if "n" in p), n)
        delta = deltas.signed(product, changes).persist()  # groups that change: a row each
        try:
            touched = sorted(buckets.buckets_in(delta, keys, count))
            if wrong := buckets.verify(store, old, table, touched):
                raise ArtifactIntegrityError(f"PRIOR_ARTIFACT_INTEGRITY_FAILED: {table}: {', '.join(wrong)}")
            held = buckets.read(store, old, table, touched) if table in old["tables"] else None
            buckets.stage(store, new, table, deltas.applied(product, held, delta, changes), keys, count, touched)
        finally:
            delta.unpersist()
        return deltas.product_of(product, store.read(new, table), after)

    with ThreadPoolExecutor(len(gold.PRODUCTS)) as pool:  # none depends on another
        return dict(zip(gold.PRODUCTS, pool.map(one, gold.PRODUCTS), strict=True))
