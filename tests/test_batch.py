"""Deliveries end to end: publication, replay, corrections, recovery."""

import json
import logging

import pytest

from finlake import config, runlog
from finlake.plans import batch, serving
from finlake.plans.batch import process_batch, silver_tables
from finlake.plans.store import StateIntegrityError, Store
from finlake.sources import delivery, fixtures, package
from finlake.streaming.landing import land

SMALL = {"months": 1, "per_month": 2}


def run(spark, root, folder, **more):
    return process_batch(spark, root, folder, expected=2, **more)


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("published")
    folder = fixtures.generate(base / "in", **SMALL)
    return base / "root", folder, run(spark, base / "root", folder)


def test_healthy_delivery(spark, published):
    root, folder, summary = published
    assert summary["status"] == "success" and not summary["failed_rules"]
    assert all(c["matches"] and not c["quarantined"] for c in summary["counts"].values())
    store = Store(spark, root)
    state = store.state()
    assert store.read(state, "quality").where("rule_name not like 'SOURCE%'").count() == 38
    assert store.read(state, "gold_monthly_country_finance").count() == 5
    assert state["watermark"] and store.inflight() is None


def test_replay_is_a_no_op_and_tampering_is_seen(spark, published, tmp_path):
    root, folder, summary = published
    again = run(spark, root, folder)
    assert again["status"] == "already_processed" and again["revenue_eur"] == summary["revenue_eur"]
    store = Store(spark, root)
    state = store.state()
    part = state["tables"]["silver_shipments"]["demo-healthy"]
    part["rows"] += 1
    assert store.verify(state, "demo-healthy") == ["silver_shipments"]


def test_package_loads_once(spark, published, tmp_path):
    root, _, summary = published
    store = Store(spark, root)
    state = store.state()
    package.build_package(silver_tables(store, state), tmp_path / "package", "load-1", "2026-01-06T00:00:00Z", results=store.read(state, "quality"))
    serving_root = tmp_path / "serving"
    wrong = {"invoice_count": "11", "revenue_eur": summary["revenue_eur"]}
    with pytest.raises(package.PackageError, match="invoice_count"):
        package.load_package(spark, serving_root, tmp_path / "package", wrong)
    tables = package.serving_tables(spark, serving_root)
    assert "fact_invoice" not in tables and tables["load_run"].first()["status"] == "FAILED"
    assert {r["control_name"]: r["status"] for r in tables["reconciliation_result"].collect()} == {"invoice_count": "FAIL", "revenue_eur": "PASS"}
    assert package.load_package(spark, serving_root, tmp_path / "package") == "LOADED"
    assert package.load_package(spark, serving_root, tmp_path / "package") == "UNCHANGED"
    tables = package.serving_tables(spark, serving_root)
    assert [r["status"] for r in tables["load_run"].collect()] == ["SUCCEEDED"] and tables["reconciliation_result"].count() == 9
    items = {r["source_table"]: r for r in tables["load_item"].collect()}
    assert items["invoices"]["target_row_count"] == items["invoices"]["source_row_count"] == 10 and str(items["invoices"]["target_financial_total"]) == summary["revenue_eur"]
    assert items["data_quality_results"]["target_row_count"] == store.read(state, "quality").count()
    counts = package.smoke(spark, serving_root)
    assert counts["fact_invoice"] == counts["transaction_drillthrough"] == 10 and counts["refresh_status"] == 1 and set(counts) == set(serving.VIEWS)
    assert spark.table("reporting_refresh_status").count() == 1
    # Another package upserts quality results and counts as the next arrival.
    package.build_package(silver_tables(store, state), tmp_path / "again", "load-2", "2026-01-07T00:00:00Z", safe=True, results=store.read(state, "quality"))
    found = json.loads((tmp_path / "again" / "manifest.json").read_text())
    found["fingerprint"] = "0" * 64
    (tmp_path / "again" / "manifest.json").write_text(json.dumps(found))
    assert package.load_package(spark, serving_root, tmp_path / "again") == "LOADED"
    assert Store(spark, serving_root).state()["batches"]["package"]["arrival"] == 2
    assert package.serving_tables(spark, serving_root)["fact_data_quality_result"].count() == counts["fact_data_quality_result"]
    found["tables"]["invoices"]["rows"] += 1
    (tmp_path / "package" / "manifest.json").write_text(json.dumps(found))
    with pytest.raises(package.PackageError):
        package.validate_package(spark, tmp_path / "package")


def test_migrations_are_applied_in_order_and_never_changed(spark, tmp_path):
    assert package.migrate(spark, tmp_path) == ["001_control_tables"] and package.migrate(spark, tmp_path) == []
    with pytest.raises(serving.MigrationError, match="changed"):
        serving.pending_migrations({"001_control_tables": "0"})
    with pytest.raises(serving.MigrationError, match="unknown"):
        serving.pending_migrations({"000_other": "0"})


def test_tasks_can_be_run_one_by_one_and_again(spark, tmp_path):
    folder, root = fixtures.generate(tmp_path / "in", **SMALL), tmp_path / "root"
    with pytest.raises(StateIntegrityError, match="LAYER_MISSING"):
        batch.build_silver(spark, root, "demo-healthy")
    assert batch.land_bronze(spark, root, folder)["status"] == "landed"
    with pytest.raises(StateIntegrityError, match="LAYER_MISSING"):
        batch.build_gold_and_validate(spark, root, "demo-healthy")
    for _ in range(2):
        assert batch.build_silver(spark, root, "demo-healthy", expected=2)["status"] == "checked"
    summary = batch.build_gold_and_validate(spark, root, "demo-healthy")
    assert summary["status"] == "success" and all(c["batch_keys_match"] and c["global_keys_match"] and c["quarantine_matches"] for c in summary["counts"].values())
    assert sorted(batch.publish_gold(spark, root)) == sorted(batch.GOLD_KEYS)
    assert Store(spark, root).ordered(Store(spark, root).state(), "quality", ["batch_id", "affected_dataset", "rule_name"]).first()["affected_dataset"] == "budgets"


def test_readback_sees_what_was_committed_otherwise(spark, tmp_path, monkeypatch):
    """A Silver part that lacks a row, and one whose amounts differ, are found after they were written."""
    folder, root = fixtures.generate(tmp_path / "in", **SMALL), tmp_path / "root"
    batch.land_bronze(spark, root, folder)
    batch.build_silver(spark, root, "demo-healthy", expected=2)
    pending = root / "pending" / "demo-healthy.json"
    found, store = json.loads(pending.read_text()), Store(spark, root)
    costs = store.read(found["state"], "silver_operational_costs")
    least = costs.agg({"cost_id": "min"}).first()[0]
    store.stage(found["state"], "silver_operational_costs", "demo-healthy", costs.where(costs.cost_id != least), ["cost_id"])
    pending.write_text(json.dumps(found))
    summary = batch.build_gold_and_validate(spark, root, "demo-healthy")
    assert summary["failed_rules"] == ["SOURCE_TARGET_FINANCIAL_RECONCILIATION", "SOURCE_TARGET_ROW_RECONCILIATION"]
    rows = {(r["rule_name"], r["affected_dataset"]): r for r in store.read(store.state(), "quality").where("validation_status = 'FAIL'").collect()}
    assert {r["failure_reason"] for r in rows.values()} == {"COMMITTED_READBACK_MISMATCH", "COMMITTED_FINANCIAL_MISMATCH"}
    assert rows["SOURCE_TARGET_FINANCIAL_RECONCILIATION", "operational_costs"]["affected_financial_amount_eur"] > 0
    assert set(d for _, d in rows) == {"operational_costs"}


def test_a_correction_is_audited(spark, tmp_path):
    rows = fixtures.datasets(**SMALL)
    fixtures.apply(rows, "correction-initial")
    first = fixtures.write(tmp_path / "first", rows, "demo")
    second = fixtures.write(tmp_path / "second", fixtures.datasets(**SMALL), "demo")
    audit = batch.run_correction(spark, tmp_path / "root", [first, second], expected=2)
    assert audit["arrival"] == 1 and len(audit["changed"]) == 1 and not audit["more_changed"]
    changed = audit["changed"][0]
    assert float(changed["total_operational_cost_eur_after"]) > float(changed["total_operational_cost_eur_before"])
    assert json.loads((tmp_path / "root" / "corrections" / "demo.json").read_text()) == audit


def test_states_of_before_and_broken_ones(spark, tmp_path):
    store = Store(spark, tmp_path)
    old = {"version": 3, "tables": {}, "batches": {"a": {"fingerprint": "f"}}, "watermark": None}
    (tmp_path / "CURRENT.json").write_text(json.dumps(old))
    assert store.state()["batches"]["a"]["arrival"] == 1
    old["batches"]["b"] = {"fingerprint": "g"}
    (tmp_path / "CURRENT.json").write_text(json.dumps(old))
    with pytest.raises(StateIntegrityError, match="STATE_MIGRATION_REQUIRED"):
        store.state()
    for name, read in (("CURRENT.json", store.state), ("inflight.json", store.inflight)):
        for text in ("{", "[]", "{}"):
            (tmp_path / name).write_text(text)
            with pytest.raises(StateIntegrityError, match="STATE_INVALID"):
                read()


def test_a_store_behind_a_uri(spark, tmp_path):
    """The same store through Hadoop's file systems, which object stores are reached by."""
    store = Store(spark, f"file://{tmp_path}/store")
    assert store.state()["version"] == 0 and store.inflight() is None
    state = store.state()
    store.stage(state, "t", "p", spark.range(5).selectExpr("id", "cast(id as decimal(20,2)) as amount_eur"), ["id"])
    store.commit(state)
    store.mark({"batch_id": "b", "fingerprint": "f"})
    store.commit(store.state())  # replaces the file that is there
    local = Store(spark, tmp_path / "store")
    assert local.state()["version"] == 2 and local.inflight()["batch_id"] == "b" and store.read(store.state(), "t").count() == 5
    assert store.verify(store.state(), "p") == local.verify(local.state(), "p") == []
    part = next((tmp_path / "store" / "parts" / "t").rglob("part-*.parquet"))
    part.write_bytes(part.read_bytes() + b"x")
    assert store.verify(store.state(), "p", lambda table: False) == local.verify(local.state(), "p", lambda table: False) == ["t"]
    part.unlink()
    assert local.verify(local.state(), "p") == ["t"]
    store.mark(None)
    assert local.inflight() is None


def test_project_config(tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    assert config.load_project_config() == config.ProjectConfig()
    (tmp_path / "finlake.json").write_text(json.dumps({"expected_invoices_per_country": 3, "min_volume_ratio": "0.25"}))
    (tmp_path / "a" / "b").mkdir(parents=True)
    monkeypatch.chdir(tmp_path / "a" / "b")
    found = config.load_project_config()
    assert found.expected_invoices_per_country == 3 and found.rules_version != config.ProjectConfig().rules_version
    for wrong in ({"what": 1}, {"critical_rules": ["NO_SUCH"]}, {"min_volume_ratio": "2"}):
        (tmp_path / "finlake.json").write_text(json.dumps(wrong))
        with pytest.raises(ValueError):
            config.load_project_config(tmp_path)
    with pytest.raises(FileNotFoundError):
        config.load_project_config(tmp_path / "a")


def test_log_lines_are_json():
    record = logging.LogRecord("finlake", logging.INFO, "", 0, "done %s", ("now",), None)
    record.batch_id = "b"
    assert json.loads(runlog.JsonLines().format(record)) | {"at": ""} == {"at": "", "level": "INFO", "logger": "finlake", "message": "done now", "batch_id": "b"}


def test_names_are_checked_before_they_are_quoted():
    assert serving.quoted("a", "b_1") == "`a`.`b_1`"
    for bad in ((), ("a b",), ("a`",), ("1a",), ("a", "b", "c", "d")):
        with pytest.raises(ValueError):
            serving.quoted(*bad)


def test_broken_values_are_refused(spark, tmp_path):
    rows = fixtures.datasets(**SMALL)
    fixtures.apply(rows, "invalid-costs")
    n = len(fixtures.broken_values("operational_costs")) + 1
    summary = run(spark, tmp_path / "root", fixtures.write(tmp_path / "in", rows, "odd"))
    assert summary["counts"]["operational_costs"]["quarantined"] == n
    assert {"VALID_COST_TYPE", "FINITE_FINANCIAL_VALUES", "REFERENTIAL_INTEGRITY", "EXCHANGE_RATE_EXISTS"} <= set(summary["failed_rules"])


def test_a_crash_at_any_step_is_recovered(spark, tmp_path):
    folder = fixtures.generate(tmp_path / "in", **SMALL)
    for step in ("bronze", "checked", "claims", "silver", "quality", "gold", "summary"):

        def crash(now, step=step):
            if now == step:
                raise RuntimeError(now)

        with pytest.raises(RuntimeError, match=step):
            run(spark, tmp_path / "root", folder, at_step=crash)
        assert Store(spark, tmp_path / "root").state()["version"] == 0
    assert run(spark, tmp_path / "root", folder)["status"] == "success"


def test_crash_before_the_state_changes_nothing_and_a_second_run_completes(spark, tmp_path):
    folder = fixtures.generate(tmp_path / "in", "duplicate", **SMALL)

    def crash(step):
        if step == "state":
            raise RuntimeError(step)

    with pytest.raises(RuntimeError):
        run(spark, tmp_path / "root", folder, at_step=crash)
    store = Store(spark, tmp_path / "root")
    assert store.state()["version"] == 0 and store.inflight()
    other = fixtures.generate(tmp_path / "other", "healthy", batch_id="other", **SMALL)
    with pytest.raises(StateIntegrityError):
        run(spark, tmp_path / "root", other)
    summary = run(spark, tmp_path / "root", folder)
    assert summary["failed_rules"] == ["DUPLICATE_INVOICE"] and summary["counts"]["invoices"]["quarantined"] == 10
    # The same contents under a second batch id add nothing: invoices and facts belong to the first delivery.
    rows = fixtures.datasets(**SMALL)
    again = run(spark, tmp_path / "root", fixtures.write(tmp_path / "again", rows, "again"))
    assert again["revenue_eur"] == summary["revenue_eur"] and again["counts"]["invoices"]["trusted"] == 0
    assert again["counts"]["shipments"]["quarantined"] == 10


def test_landing_stream(spark, tmp_path):
    fixtures.generate(tmp_path / "inbox" / "one", **SMALL)
    fixtures.generate(tmp_path / "inbox" / "two", batch_id="two", **SMALL)
    seen = []
    land(spark, tmp_path / "inbox", tmp_path / "checkpoint", seen.append).awaitTermination(120)
    assert sorted(p.name for p in seen) == ["one", "two"]
    land(spark, tmp_path / "inbox", tmp_path / "checkpoint", seen.append).awaitTermination(120)
    assert len(seen) == 2


@pytest.mark.parametrize("break_it", ["fingerprint", "header", "batch_id", "none"])
def test_bad_deliveries_are_rejected(spark, tmp_path, break_it):
    folder = fixtures.generate(tmp_path / "in", **SMALL)
    path = folder / "manifest.json"
    found = json.loads(path.read_text())
    if break_it == "none":
        path.unlink()
    elif break_it == "header":
        text = (folder / "routes.csv").read_text().replace("route_id,", "id,", 1)
        (folder / "routes.csv").write_text(text)
        found["fingerprint"] = delivery.fingerprint(folder)
        path.write_text(json.dumps(found))
    else:
        found[break_it] = "../x"
        path.write_text(json.dumps(found))
    with pytest.raises(delivery.ContractError):
        run(spark, tmp_path / "root", folder)


def test_csv_cells_keep_quotes_and_line_breaks(spark, tmp_path):
    rows = fixtures.datasets(**SMALL)
    rows["customers"][0]["customer_name"] = '=A "quoted",\nline Ü'
    folder = fixtures.write(tmp_path / "in", rows, "b")
    frame = delivery.read_csv(spark, folder / "customers.csv", "customers")
    assert frame.count() == 15 and frame.first()["customer_name"] == '=A "quoted",\nline Ü'

