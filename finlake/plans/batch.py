"""One delivery from its folder to published Silver, quarantine, quality and Gold."""

from __future__ import annotations

import copy
import hashlib
import json
from collections.abc import Callable, Sequence
from decimal import Decimal
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from finlake.contracts import CONTRACT_VERSION, COVERAGE, DATASETS, EXPECTED_INVOICES_PER_COUNTRY, FACTS, FINANCIAL_MISMATCH, MIN_VOLUME_RATIO, PIPELINE_VERSION, READBACK_MISMATCH, RECONCILIATION_RULES, RULES
from finlake.functions import expr
from finlake.operators import checks, evidence, gold, merge, ownership, quality
from finlake.plans import buckets, claims, gold_deltas, records
from finlake.plans.store import ALL, ArtifactIntegrityError, ClaimsIntegrityError, StateIntegrityError, Store
from finlake.sources import delivery

#: Tables in buckets of the invoice id.
BUCKETED = (claims.CLAIMS, claims.TRUSTED, claims.AWAY)
GOLD_KEYS = gold.KEYS
OWNED = tuple(f for f in FACTS if f != "invoices")
REFERENCES = tuple(n for n in DATASETS if n not in FACTS)
LAYERS = ("bronze", "silver")
#: Changed months and countries that a correction's report lists; `correction_audit` has all of them.
AUDITED = 1000


class ReconciliationError(RuntimeError):
    """Published rows or totals don't add up; nothing was published."""


def _arrivals(state: dict, batch_id: str) -> dict[str, int]:
    found = {b: v["arrival"] for b, v in state["batches"].items()}
    return found | ({} if batch_id in found else {batch_id: max(found.values(), default=0) + 1})


def versions_of(expected: int, ratio: str) -> dict[str, str]:
    """What a run's result depends on besides its delivery: the code, the contract, and the rules with their thresholds in force."""
    rules = hashlib.sha256(json.dumps([RULES, int(expected), str(Decimal(ratio).normalize())], sort_keys=True).encode()).hexdigest()
    return {"pipeline": PIPELINE_VERSION, "contract": CONTRACT_VERSION, "rules": rules}


Step = Callable[[str], None]


def _nothing(step: str) -> None:
    pass


def _is_read(table: str) -> bool:
    """Whether a run reads other deliveries' parts of the table: then their rows are verified, else their files."""
    return table in ("quality", records.TABLE) or table.startswith("silver_")


def _resume(store: Store, batch: str, layer: str) -> dict:
    if not store.exists("pending", f"{batch}.json"):
        raise StateIntegrityError(f"LAYER_MISSING: {batch} has no {layer} yet")
    found = store.json("pending", f"{batch}.json")
    if found.get("base") != store.state()["version"] or LAYERS.index(found["layer"]) < LAYERS.index(layer):
        raise StateIntegrityError(f"LAYER_MISSING: {batch} must be landed again, up to {layer}")
    return found


def land_bronze(spark: SparkSession, root: str | Path, folder: str | Path, at_step: Step = _nothing, expected: int = EXPECTED_INVOICES_PER_COUNTRY, ratio: str = MIN_VOLUME_RATIO) -> dict:
    """The first task: a delivery's rows as they are, after its manifest, header and counts were checked. Gives a summary if the
    same versions, under the same thresholds, have published the delivery already, else {"batch_id", "status": "landed"}."""
    store, folder, versions = Store(spark, root), Path(folder), versions_of(expected, ratio)
    found = delivery.manifest(folder)
    batch, fp, replaced = found["batch_id"], found["fingerprint"], found.get("supersedes_batch_id")
    state = store.state()
    mark = store.inflight()
    if mark and (mark["batch_id"], mark["fingerprint"]) != (batch, fp):
        raise StateIntegrityError(f"INFLIGHT_RECOVERY_REQUIRED: run {mark['batch_id']} first")
    held = state["batches"].get(batch)
    for other in state["batches"]:
        if wrong := store.verify(state, other, _is_read) if other != batch else []:
            raise (ClaimsIntegrityError if "claims" in wrong else ArtifactIntegrityError)(f"PRIOR_ARTIFACT_INTEGRITY_FAILED: {other}: {', '.join(wrong)}")
    if held and held["fingerprint"] == fp and held["versions"] == versions and not store.verify(state, batch) and not store.verify(state, ALL):
        if not any(buckets.verify(store, state, t, None) for t in BUCKETED):
            if mark:  # a run died between its commit and this
                store.mark(None)
                store.remove("pending", f"{batch}.json")
            return store.json("runs", f"{batch}.json") | {"status": "already_processed"}

    new = copy.deepcopy(state)
    arrivals = _arrivals(state, batch)
    gone = claims.held_by(state, batch, replaced)
    if replaced:
        store.drop(new, replaced)
        new["batches"].pop(replaced, None)
    store.drop(new, batch)
    source = delivery.bronze(spark, folder, found)
    delivery.check_counts(source, found)
    at_step("bronze")
    store.stage_all(new, [(f"bronze_{n}", batch, f, list(DATASETS[n].key)) for n, f in source.items()])
    store.write({"layer": "bronze", "base": state["version"], "state": new, "manifest": found, "arrivals": arrivals, "claims_gone": gone, "versions": versions}, "pending", f"{batch}.json")
    return {"batch_id": batch, "status": "landed"}


def build_silver(spark: SparkSession, root: str | Path, batch: str, expected: int = EXPECTED_INVOICES_PER_COUNTRY, ratio: str = MIN_VOLUME_RATIO, at_step: Step = _nothing) -> dict:
    """The second task: typed and checked rows, owners of business keys, Silver and quarantine. May be run again."""
    store = Store(spark, root)
    run = _resume(store, batch, "bronze")
    new, found, arrivals = run["state"], run["manifest"], run["arrivals"]
    replaced = found.get("supersedes_batch_id")
    typed = {n: checks.typed(store.read(new, f"bronze_{n}", among=[batch]), n) for n in DATASETS}
    checks.reject_bad_dates(typed)
    checked = checks.check_batch(typed, expected, ratio)
    near = records.parts_to_read(store, new, batch, {n: typed[n] for n in OWNED})
    for name in OWNED:
        before = store.read(new, f"silver_{name}", among=near[name], like=checks.trusted(checked[name]))
        checked[name] = ownership.own_records(checked[name], before, name)
    # Written once; everything below reads the parts.
    at_step("checked")
    checked = dict(zip(checked, store.stage_all(new, [(f"checked_{n}", batch, f, list(DATASETS[n].key)) for n, f in checked.items()]), strict=True))
    store.mark({"batch_id": batch, "fingerprint": found["fingerprint"]})

    at_step("claims")
    rows = ownership.claim_hash(checks.trusted(checked["invoices"]))
    touched, mine = claims.put(store, new, batch, rows, replaced, sorted({*run["claims_gone"], *run.get("touched", [])}))
    at_step("silver")
    claims.settle(store, new, _active(arrivals, replaced), touched)
    parts = [(f"silver_{n}", batch, merge.last_of_key(checks.trusted(checked[n]), DATASETS[n].key, ["_source_row_number"]), list(DATASETS[n].key)) for n in DATASETS if n != "invoices"]
    parts += [(f"quarantine_{n}", batch, checks.quarantined(checked[n]), [*DATASETS[n].key, "_source_row_number"]) for n in DATASETS]
    parts += [(records.TABLE, batch, records.filters({n: checks.trusted(checked[n]) for n in OWNED}, batch), records.KEYS)]
    store.stage_all(new, parts)
    gone = not checks.dropped_countries(typed["invoices"], typed["countries"], expected, ratio).isEmpty()
    store.write(run | {"layer": "silver", "state": new, "versions": versions_of(expected, ratio), "countries_dropped": gone, "touched": touched, "claim_buckets": mine}, "pending", f"{batch}.json")
    return {"batch_id": batch, "status": "checked"}


def _active(arrivals: dict[str, int], replaced: str | None) -> dict[str, int]:
    return {b: a for b, a in arrivals.items() if b != replaced}


def readback(store: Store, state: dict, batch: str, resolved: DataFrame, touched: list[int]) -> list[Row]:
    """What is committed against what was meant, one row per dataset (`evidence.reconciled`): committed rows are read back
    from the store, meant ones come from the checked rows, and other deliveries' from what was recorded for them. Of invoices
    the touched buckets are compared; the others are the version before's."""
    frames, recorded = [], []
    for n, d in DATASETS.items():
        keys, marks = list(d.key), [*d.key, "_batch_id", "_source_row_number", "_reason_codes"]
        checked = store.read(state, f"checked_{n}", among=[batch])
        meant, away = checks.trusted(checked), checks.quarantined(checked)
        gone = store.read(state, f"quarantine_{n}", among=[batch])
        if n == "invoices":
            here = F.col("_batch_id") == batch
            meant_all, kept_all = checks.trusted(resolved), buckets.read(store, state, claims.TRUSTED, touched)
            meant, kept = meant_all.where(here), kept_all.where(here)
            away = away.unionByName(checks.quarantined(resolved).where(here).select(*away.columns))
            gone = gone.unionByName(buckets.read(store, state, claims.AWAY, touched).where(here).select(*gone.columns))
        else:
            kept = store.read(state, f"silver_{n}", among=[batch])
            meant_all, kept_all = meant, store.read(state, f"silver_{n}")
            recorded.append((n, [p for name, p in state["tables"][f"silver_{n}"].items() if name != batch]))
        frames += [evidence.signature(f, n, what, keys, marks if "quarantine" in what else None) for what, f in (("source", checked), ("trusted", kept), ("meant_trusted", meant), ("quarantine", gone), ("meant_quarantine", away), ("all", kept_all), ("meant_all", meant_all))]
    found = reduce(DataFrame.unionByName, frames)
    others = [(n, sum(p["rows"] for p in parts), Decimal(sum(int(p["key_digest"]) for p in parts)), sum((Decimal(p.get("eur") or 0) for p in parts), Decimal(0))) for n, parts in recorded]
    more = found.sparkSession.createDataFrame(others, "name string, _rows long, _keys decimal(38,0), _eur decimal(20,2)")
    is_all = F.col("what") == "meant_all"
    found = found.join(F.broadcast(more), "name", "left")  # one row per dataset of the contract
    add = lambda c, m: F.when(is_all, F.col(c) + F.coalesce(m, F.lit(0))).otherwise(F.col(c)).cast(dict(found.dtypes)[c]).alias(c)
    found = found.select("name", "what", add("rows", "_rows"), add("key_digest", "_keys"), "row_digest", add("eur", "_eur"))
    return evidence.reconciled(found).collect()


def build_gold_and_validate(spark: SparkSession, root: str | Path, batch: str, at_step: Step = _nothing) -> dict:
    """The third task: read-back reconciliation, quality results and Gold; then all is published at once. May be run again."""
    store = Store(spark, root)
    run = _resume(store, batch, "silver")
    new, found, arrivals = run["state"], run["manifest"], run["arrivals"]
    replaced = found.get("supersedes_batch_id")
    resolved = claims.resolved(store, new, _active(arrivals, replaced), run["touched"])
    graded = {n: store.read(new, f"checked_{n}", among=[batch]) for n in DATASETS}
    columns = graded["invoices"].columns
    graded["invoices"] = graded["invoices"].where(F.size("_reasons") > 0).unionByName(resolved.where((F.col("_batch_id") == batch) & (F.size("_reasons") > 0)).select(*columns))
    results = quality.quality_results(spark, graded, batch, found["generated_at"], run["countries_dropped"])
    rows = readback(store, new, batch, resolved, run["touched"])
    counts = {r["name"]: {"source": r["source_rows"], "trusted": r["trusted_rows"], "quarantined": r["quarantine_rows"], "matches": r["rows_match"], **{c: r[c] for c in ("source_accounted", "batch_keys_match", "global_keys_match", "quarantine_matches")}} for r in rows}
    euros = {r["name"]: {"source": str(r["source_eur"]), "trusted": str(r["trusted_eur"]), "quarantined": str(r["quarantine_eur"]), "matches": r["eur_matches"]} for r in rows if r["name"] in FACTS}
    checked = [(RECONCILIATION_RULES[0], r["name"], r["rows_match"], READBACK_MISMATCH, None) for r in rows]
    checked += [(RECONCILIATION_RULES[1], r["name"], r["eur_matches"], FINANCIAL_MISMATCH, r["eur_difference"]) for r in rows if r["name"] in FACTS]
    made = [(rule, n, "" if ok else reason, 0 if ok else 1, None if ok else off, "PASS" if ok else "FAIL") for rule, n, ok, reason, off in checked]
    recon = spark.createDataFrame(made, "rule_name string, affected_dataset string, failure_reason string, failed_row_count long, affected_financial_amount_eur decimal(20,2), validation_status string")
    recon = recon.withColumns({"batch_id": F.lit(batch), "execution_timestamp": F.to_timestamp(F.lit(found["generated_at"]))}).select(*results.columns)
    at_step("quality")
    results = store.stage(new, "quality", batch, results.unionByName(recon), ["rule_name", "affected_dataset"])
    failed = quality.failed_critical(results)

    at_step("gold")
    tables, old = silver_tables(store, new, [b for b in arrivals if b != replaced]), store.state()
    made = gold_deltas.update(store, old, new, silver_tables(store, old) if old["batches"] else None, tables)
    products = dict(zip(made, store.stage_all(new, [(name, ALL, f, list(gold.KEYS[name])) for name, f in made.items()]), strict=True))
    store.stage(new, "gold_data_quality_summary", ALL, gold.data_quality_summary(store.read(new, "quality")), ["batch_id", "affected_dataset", "rule_name"])
    if bad := [r["control"] for r in gold.reconcile(joined_facts(tables), products).where("not matches").collect()]:
        raise ReconciliationError(f"Gold and Silver differ: {', '.join(bad)}")
    revenue = products["gold_monthly_country_finance"].agg(expr.zero(F.sum("total_revenue_eur")).alias("v")).first()["v"]
    status = "quality_failed" if failed else "success"
    summary = {"batch_id": batch, "status": status, "failed_rules": failed, "counts": counts, "euros": euros, "revenue_eur": str(revenue), "rules": len(COVERAGE)}
    new["batches"][batch] = {"arrival": arrivals[batch], "fingerprint": found["fingerprint"], "versions": run["versions"], "status": status, "supersedes": replaced, "claim_buckets": run["claim_buckets"]}
    if status == "success":
        new["watermark"] = max(filter(None, [new["watermark"], found["generated_at"]]))
    at_step("summary")
    store.write(summary, "runs", f"{batch}.json")
    at_step("state")
    store.commit(new)
    at_step("committed")
    store.mark(None)
    store.remove("pending", f"{batch}.json")
    return summary


def process_batch(spark: SparkSession, root: str | Path, folder: str | Path, expected: int = EXPECTED_INVOICES_PER_COUNTRY, ratio: str = MIN_VOLUME_RATIO, at_step: Step = _nothing) -> dict:
    """The three tasks in turn; the run's summary. A delivery that was published already, by the same versions, is verified and
    left alone.

    `at_step` is called with a name before each step that changes the store; a test may raise there. Until the state is
    replaced, readers see the version before; running the same delivery again completes it."""
    landed = land_bronze(spark, root, folder, at_step, expected, ratio)
    if landed["status"] != "landed":
        return landed
    build_silver(spark, root, landed["batch_id"], expected, ratio, at_step)
    return build_gold_and_validate(spark, root, landed["batch_id"], at_step)


def silver_tables(store: Store, state: dict, active: list[str] | None = None) -> dict[str, DataFrame]:
    """Silver over all active batches: facts as they are, references with each key's row of the latest arrival."""
    arrivals = {b: v["arrival"] for b, v in state["batches"].items()}
    for b in active or []:
        arrivals.setdefault(b, max(arrivals.values(), default=0) + 1)
    out = {}
    for n in DATASETS:
        frame = store.read(state, f"silver_{n}")
        if n in REFERENCES:
            frame = merge.last_of_key(claims.with_arrival(frame, arrivals), DATASETS[n].key, ["arrival", "_source_row_number"]).drop("arrival")
        out[n] = frame
    return out


def joined_facts(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Silver whose invoices and costs have their shipment in Silver: what Gold can attribute."""
    ships = tables["shipments"].select("shipment_id")
    return tables | {n: tables[n].join(ships, "shipment_id", "left_semi") for n in ("invoices", "operational_costs")}


def correction_audit(before: DataFrame, after: DataFrame) -> DataFrame:
    """Monthly totals that a correction changed."""
    keys, values = ["month_start", "country_code"], ["total_revenue_eur", "total_operational_cost_eur", "budget_amount_eur"]
    old = before.select(*keys, *[F.col(v).alias(f"{v}_before") for v in values])
    new = after.select(*keys, *[F.col(v).alias(f"{v}_after") for v in values])
    both = old.join(new, keys, "full")
    changed = reduce(lambda a, b: a | b, [~F.col(f"{v}_before").eqNullSafe(F.col(f"{v}_after")) for v in values])
    return both.where(changed)


def publish_gold(spark: SparkSession, root: str | Path) -> dict[str, int]:
    """Makes Gold again from the Silver that is published, and publishes it; its rows by product."""
    store = Store(spark, root)
    state = store.state()
    new = copy.deepcopy(state)
    tables = silver_tables(store, state)
    made = {name: store.stage(new, name, ALL, f(tables), list(gold.KEYS[name])) for name, f in gold.PRODUCTS.items()}
    if bad := [r["control"] for r in gold.reconcile(joined_facts(tables), made).where("not matches").collect()]:
        raise ReconciliationError(f"Gold and Silver differ: {', '.join(bad)}")
    store.commit(new)
    return {n: new["tables"][n][ALL]["rows"] for n in made}


def run_correction(spark: SparkSession, root: str | Path, folders: Sequence[str | Path], **limits) -> dict:
    """Processes a delivery and then its correction; what the correction changed, month by month, as JSON in the store."""
    store, summaries, products = Store(spark, root), [], []
    for folder in folders:
        summaries.append(process_batch(spark, root, folder, **limits))
        products.append(store.read(store.state(), "gold_monthly_country_finance"))
    changed = [{k: str(v) if v is not None else None for k, v in r.asDict().items()} for r in correction_audit(products[0], products[-1]).orderBy("month_start", "country_code").limit(AUDITED + 1).collect()]
    state = store.state()
    audit = {"batch_id": summaries[-1]["batch_id"], "arrival": state["batches"][summaries[-1]["batch_id"]]["arrival"], "before": summaries[0]["euros"], "after": summaries[-1]["euros"], "changed": changed[:AUDITED], "more_changed": len(changed) > AUDITED}
    store.write(audit, "corrections", f"{summaries[-1]['batch_id']}.json")
    return audit
