"""End-to-end audit job (E1) on the mock data and on the driver tables."""

import glob
import hashlib
import json

import pytest

from tablegate.plans.job import AuditConfig, audit_details, run_audit
from tablegate.sources import dirty
from tablegate.sources.mock import mock_customers, mock_transactions

from .conftest import SF_SMALL

pytestmark = pytest.mark.integration


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


@pytest.fixture(scope="module")
def mock_run(spark):
    return run_audit(spark, mock_customers(spark), mock_transactions(spark))


def test_mock_gate_outcome(mock_run):
    assert (mock_run.dims.clean_rows, mock_run.dims.rejected_rows) == (2, 3)
    assert (mock_run.facts.clean_rows, mock_run.facts.rejected_rows) == (4, 1)
    assert sorted(r.transaction_id for r in mock_run.facts.clean.collect()) == [100, 101, 102, 104]


def test_mock_join_and_totals(mock_run):
    assert [r.transaction_id for r in mock_run.enriched.collect()] == [100]
    assert [(r.country, r.total_amount) for r in mock_run.totals.collect()] == [("Colombia", 200.0)]


def test_mock_checks_exact(mock_run):
    checks = {r.check_name: r for r in audit_details(mock_run).collect()}
    assert [c for c in checks] == ["completeness", "uniqueness", "referential_integrity", "reconciliation"]
    assert checks["completeness"].passed is True
    assert checks["uniqueness"].passed is True
    ri = checks["referential_integrity"]
    assert ri.passed is False and json.loads(ri.details.toJson())["orphan_customer_ids"] == [2, 6]
    rec = checks["reconciliation"]
    assert rec.passed is False
    mism = json.loads(rec.details.toJson())["country_mismatches"]
    assert mism == [{"country": "Mexico", "raw_total": 300.0, "clean_total": 0.0}]


def test_mock_report_and_outbox(mock_run):
    assert mock_run.overall_pass is False
    row = mock_run.report.first()
    assert row.rejected_at_gate == {"customers": 3, "transactions": 1}
    base = _local(mock_run.path)
    files = glob.glob(base + "/audit_report.json/part-*.json")
    loaded = json.loads(open(files[0], encoding="utf-8").read())
    assert loaded["overall_pass"] is False and len(loaded["audit_checks"]) == 4
    outbox = glob.glob(base + "/outbox/part-*.json")
    channels = sorted(json.loads(line)["channel"] for f in outbox for line in open(f, encoding="utf-8"))
    assert channels == ["email", "webhook"]


def test_job_count_is_bounded(mock_run):
    # With AQE every shuffle stage runs as its own Spark job; their number is set by the plan.
    assert 0 < mock_run.jobs <= 40


def test_quarantine_masking(spark):
    run = run_audit(
        spark, mock_customers(spark), mock_transactions(spark), AuditConfig(mask_columns=("name", "email"))
    )
    rej = {r.customer_id: r for r in run.dims.rejected.collect()}
    assert rej[2].email is None and len(rej[3].email) == 64 and rej[5].name is None
    on_disk = spark.read.parquet(run.dims.path + "/_gate=rejected").collect()
    assert "laura_gomez@email.com" not in {r.email for r in on_disk}
    assert {r.name for r in on_disk if r.name} == {hashlib.sha256(n.encode()).hexdigest() for n in ("Juan Pérez", "Laura Gómez")}
    assert {r.email for r in run.dims.clean.collect()} == {"ana@email.com", "juanperez@email.com"}


def test_job_on_driver_tables(spark):
    run = run_audit(spark, dirty.dirty_customers(spark, SF_SMALL), dirty.dirty_transactions(spark, SF_SMALL))
    assert run.dims.clean_rows + run.dims.rejected_rows == 150
    assert run.facts.clean_rows + run.facts.rejected_rows == 1500
    assert run.overall_pass is False
    names = [r.check_name for r in audit_details(run).collect()]
    assert names == ["completeness", "uniqueness", "referential_integrity", "reconciliation"]


def test_passing_run(spark):
    c = dirty.clean_customers_source(spark, SF_SMALL)
    t = dirty.clean_transactions_source(spark, SF_SMALL).filter("customer_id > 0")
    run = run_audit(spark, c, t)
    details = {r.check_name: r.passed for r in audit_details(run).collect()}
    assert details == {
        "completeness": True,
        "uniqueness": True,
        "referential_integrity": True,
        "reconciliation": True,
    }
    assert run.overall_pass is True and run.outbox.count() == 0


def test_job_matches_catalog_queries(spark):
    """The fused e2e path (one pass for clean+raw totals, observed NULL counts)
    gives the same numbers as the separately composed, oracle-checked queries."""
    from tablegate.plans import catalog

    from .conftest import SF_MID

    run = run_audit(spark, dirty.dirty_customers(spark, SF_MID), dirty.dirty_transactions(spark, SF_MID))
    spend = {r.country: r.total_amount for r in catalog.spend_by_country(spark, SF_MID).collect()}
    assert {r.country: r.total_amount for r in run.totals.collect()} == spend
    rec = {(r.country, r.raw_total, r.clean_total) for r in catalog.reconciliation(spark, SF_MID).collect()}
    run_rec = {
        (r.country, float(r.raw_total), float(r.clean_total)) for r in run.checks[3].violations.collect()
    }
    assert run_rec == rec and len(rec) == 25
    summary = {r.check_name: (r.passed, r.violation_count) for r in catalog.audit_summary(spark, SF_MID).collect()}
    details = {r.check_name: (r.passed, r.violation_count) for r in audit_details(run).collect()}
    assert details == summary
    assert (run.dims.rejected_rows, run.facts.rejected_rows) == (348, 1023)


def test_cli_entry(spark, capsys):
    from tablegate.plans.job import main

    assert main(["--sf-dir", SF_SMALL]) == 2
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["overall_pass"] is False
    assert out["clean"]["customers"] + out["rejected"]["customers"] == 150


def test_all_rejected_input_still_reports(spark):
    """The reference fails on an empty clean list (schema inference); here outputs stay typed."""
    from tablegate.sources.mock import CUSTOMER_SCHEMA, TRANSACTION_SCHEMA

    c = spark.createDataFrame([(1, None, "a@b.co", "X"), (2, "B", None, "Y")], CUSTOMER_SCHEMA)
    t = spark.createDataFrame([(1, 1, -5.0, "2025-01-01")], TRANSACTION_SCHEMA)
    run = run_audit(spark, c, t)
    assert (run.dims.clean_rows, run.facts.clean_rows) == (0, 0)
    assert run.totals.count() == 0 and run.enriched.count() == 0
    assert run.totals.columns == ["country", "total_amount"]
    checks = {r.check_name: r.passed for r in audit_details(run).collect()}
    # raw side: amount -5 joined to country X; clean side empty -> mismatch
    assert checks == {
        "completeness": True,
        "uniqueness": True,
        "referential_integrity": True,
        "reconciliation": False,
    }


def test_empty_input(spark):
    from tablegate.sources.mock import CUSTOMER_SCHEMA, TRANSACTION_SCHEMA

    run = run_audit(spark, spark.createDataFrame([], CUSTOMER_SCHEMA), spark.createDataFrame([], TRANSACTION_SCHEMA))
    assert run.overall_pass is True
    assert run.report.first().rejected_at_gate == {"customers": 0, "transactions": 0}


def test_unwritable_report_path_raises(spark, scratch):
    from tablegate.operators import report
    from tablegate.sources.sinks import save_report

    blocker = scratch + "/a_file"
    open(blocker, "w").close()
    rows = spark.createDataFrame([(0, "c", True, 0, "{}")], "ordinal int, check_name string, passed boolean, violation_count bigint, details string")
    with pytest.raises(Exception):
        save_report(report.build_report(rows), blocker + "/report")


def test_inexact_amounts_are_counted_not_hidden(spark):
    from tablegate.sources.mock import CUSTOMER_SCHEMA, TRANSACTION_SCHEMA

    c = spark.createDataFrame([(1, "A", "a@b.co", "X")], CUSTOMER_SCHEMA)
    t = spark.createDataFrame(
        [(1, 1, 10.0, "2025-01-01"), (2, 1, float("nan"), "2025-01-01"), (3, 1, float("inf"), "2025-01-01"),
         (4, 1, 1e20, "2025-01-01"), (5, 1, None, "2025-01-01")],
        TRANSACTION_SCHEMA,
    )
    run = run_audit(spark, c, t)
    assert run.inexact_amounts == 3
    assert [(r.country, r.total_amount) for r in run.totals.collect()] == [("X", 10.0)]
    assert run.overall_pass is False  # NaN equals nothing, so the group cannot be reconciled


@pytest.mark.parametrize("amount", [2e16, 0.004, float("nan"), float("inf")])
def test_removed_inexact_amount_fails_the_audit(spark, amount):
    from tablegate.sources.mock import CUSTOMER_SCHEMA, TRANSACTION_SCHEMA

    c = spark.createDataFrame([(1, "A", "a@b.co", "X")], CUSTOMER_SCHEMA)
    t = spark.createDataFrame([(1, 1, 10.0, "2025-01-01"), (2, 1, amount, "01-2025")], TRANSACTION_SCHEMA)
    run = run_audit(spark, c, t)
    assert run.overall_pass is False and run.inexact_amounts == 1
    details = {r.check_name: r.details for r in audit_details(run).collect()}
    assert details["reconciliation"].toPython()["country_mismatches"][0]["raw_inexact"] == 1 and not run.checks[3].violations.isEmpty()


def test_kept_inexact_amount_is_no_mismatch(spark):
    from tablegate.sources.mock import CUSTOMER_SCHEMA, TRANSACTION_SCHEMA

    c = spark.createDataFrame([(1, "A", "a@b.co", "X")], CUSTOMER_SCHEMA)
    t = spark.createDataFrame([(1, 1, 10.0, "2025-01-01"), (2, 1, 2e16, "2025-01-02")], TRANSACTION_SCHEMA)
    assert run_audit(spark, c, t).overall_pass is True


def test_all_duplicates_are_on_disk_by_default(spark):
    from tablegate.sources.mock import CUSTOMER_SCHEMA, TRANSACTION_SCHEMA

    c = spark.createDataFrame([(i, "A", f"u{i % 100}@b.co", "X") for i in range(1, 201)], CUSTOMER_SCHEMA)
    t = spark.createDataFrame([(1, 1, 10.0, "2025-01-01")], TRANSACTION_SCHEMA)
    run = run_audit(spark, c, t)
    assert spark.read.parquet(run.path + "/violations/uniqueness").count() == 100


@pytest.mark.parametrize("columns", [("phone",), ("country",), ("customer_id",), ("amount",)])
def test_unknown_or_needed_columns_cannot_be_masked(spark, columns):
    with pytest.raises(ValueError, match="cannot mask"):
        run_audit(spark, mock_customers(spark), mock_transactions(spark), AuditConfig(mask_columns=columns))


def test_rerun_into_same_folder_is_idempotent(spark, scratch):
    for _ in range(2):
        run = run_audit(spark, mock_customers(spark), mock_transactions(spark), output_dir=scratch + "/run")
    assert spark.read.json(scratch + "/run/outbox").count() == 2
    assert spark.read.json(scratch + "/run/audit_report.json").count() == 1
    assert run.dims.clean.count() == 2


def test_passing_rerun_clears_old_alerts(spark, scratch):
    run_audit(spark, mock_customers(spark), mock_transactions(spark), output_dir=scratch + "/r")
    c = dirty.clean_customers_source(spark, SF_SMALL)
    t = dirty.clean_transactions_source(spark, SF_SMALL).filter("customer_id > 0")
    run = run_audit(spark, c, t, output_dir=scratch + "/r")
    assert run.overall_pass is True
    import os

    outbox = _local(scratch + "/r/outbox")
    assert not any(open(os.path.join(outbox, f)).read().strip() for f in os.listdir(outbox) if f.startswith("part-"))


def test_cli_with_contract_files(spark, scratch, capsys):
    from tablegate.plans.job import main

    spec = {"name": "customers", "fields": [
        {"name": "customer_id", "type": "bigint"},
        {"name": "country", "type": "string", "rules": ["not_blank"]}]}
    with open(scratch + "/c.json", "w", encoding="utf-8") as fh:
        json.dump(spec, fh)
    assert main(["--sf-dir", SF_SMALL, "--customers-contract", scratch + "/c.json", "--unique", "customer_id"]) == 2
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    # only customer_id and country are checked now: fewer customers rejected than with the full contract
    assert out["rejected"]["customers"] < 37 and out["clean"]["customers"] + out["rejected"]["customers"] == 150


def test_compact_quarantine_table(spark):
    run = run_audit(
        spark, dirty.dirty_customers(spark, SF_SMALL), dirty.dirty_transactions(spark, SF_SMALL),
        AuditConfig(rejected_files=1),
    )
    assert run.facts.rejected.count() == run.facts.rejected_rows and "rejection_reason" in run.facts.rejected.columns
    files = [f for f in run.facts.rejected.inputFiles() if f.endswith(".parquet")]
    assert len(files) == 1 and "transactions_rejected" in files[0]


def test_missing_configured_column_fails_fast(spark):
    with pytest.raises(ValueError, match="region"):
        run_audit(spark, mock_customers(spark), mock_transactions(spark), AuditConfig(group="region"))


def test_write_violations_keeps_full_lists(spark):
    run = run_audit(
        spark, dirty.dirty_customers(spark, SF_SMALL), dirty.dirty_transactions(spark, SF_SMALL),
        AuditConfig(write_violations=True, sample_size=3),
    )
    details = {r.check_name: r for r in audit_details(run).collect()}
    ri = run.checks[2].violations
    assert ri.inputFiles() and "violations/referential_integrity" in ri.inputFiles()[0]
    assert ri.count() == details["referential_integrity"].violation_count > 3  # whole list, sample capped at 3
    assert run.checks[1].violations.count() == details["uniqueness"].violation_count
