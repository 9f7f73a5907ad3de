"""Report, JSON sink, alert outbox, masking."""

import glob
import json

import pytest
from pyspark.sql import functions as F

from tablegate.functions.masking import mask
from tablegate.operators import report
from tablegate.sources.sinks import save_report

pytestmark = pytest.mark.unit


def _summaries(spark, rows):
    return spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)],
        "ordinal int, check_name string, passed boolean, violation_count bigint, details string",
    )


def _gates(spark, c=0, t=0):
    return spark.createDataFrame(
        [("customers", 5, c), ("transactions", 5, t)], "entity string, clean_rows bigint, rejected_rows bigint"
    )


THREE_GOOD = [(name, True, 0, "{}") for name in ("nulls", "keys", "totals")]
KEYS_BAD = [THREE_GOOD[0], ("keys", False, 4, '{"duplicate_emails":["x@y.com"]}'), THREE_GOOD[2]]


@pytest.mark.parametrize("rows,verdict", [(THREE_GOOD, True), (KEYS_BAD, False), (KEYS_BAD[::-1], False)])
def test_verdict_is_that_of_the_worst_check(spark, rows, verdict):
    r = report.build_report(_summaries(spark, rows), _gates(spark, 2, 7)).first()
    assert r.overall_pass is verdict and r.rejected_at_gate == {"customers": 2, "transactions": 7}


def test_no_checks_is_a_pass(spark):
    empty = _summaries(spark, [])
    assert report.build_report(empty).first().overall_pass is True


def test_report_keys_and_check_order(spark):
    rows = [("b_check", True, 0, "{}"), ("a_check", False, 2, "{}"), ("c_check", True, 0, "{}")]
    r = report.build_report(_summaries(spark, rows), _gates(spark))
    assert r.columns == ["timestamp", "overall_pass", "audit_checks", "rejected_at_gate"]
    names = [c.check_name for c in r.first().audit_checks]
    assert names == ["b_check", "a_check", "c_check"]


def test_save_report_writes_valid_json(spark, scratch):
    r = report.build_report(_summaries(spark, KEYS_BAD), _gates(spark, 3, 1))
    save_report(r, scratch + "/report")
    files = glob.glob(scratch + "/report/part-*.json")
    assert len(files) == 1
    loaded = json.loads(open(files[0], encoding="utf-8").read())
    assert loaded["overall_pass"] is False
    assert loaded["rejected_at_gate"] == {"customers": 3, "transactions": 1}
    assert loaded["audit_checks"][1]["details"] == {"duplicate_emails": ["x@y.com"]}
    assert len(loaded["timestamp"]) == 26 and loaded["timestamp"][10] == "T"


def test_outbox_rows_only_when_failing(spark):
    ok = report.build_report(_summaries(spark, THREE_GOOD), _gates(spark))
    assert report.alert_outbox(ok).count() == 0
    bad = report.build_report(_summaries(spark, KEYS_BAD), _gates(spark, 1, 0))
    rows = report.alert_outbox(bad).collect()
    assert [(r.channel, r.target) for r in rows] == [
        ("webhook", report.DEFAULT_WEBHOOK_URL),
        ("email", report.DEFAULT_EMAIL_TO),
    ]
    assert all(r.subject for r in rows)
    body = json.loads(rows[0].body)
    assert body["overall_pass"] is False and body["audit_checks"][1]["check_name"] == "keys"


def test_status_label(spark):
    df = spark.createDataFrame([(True,), (False,)], "passed boolean")
    assert [r[0] for r in df.select(report.status_label()).collect()] == ["PASS", "FAIL"]


def test_mask_sha256(spark):
    df = spark.createDataFrame([("a@b.co", 1), (None, 2)], "email string, k int")
    out = mask(df, ["email"]).collect()
    assert len(out[0].email) == 64
    assert out[1].email is None
    import hashlib

    assert out[0].email == hashlib.sha256(b"a@b.co").hexdigest()
    assert mask(df, ["email"], suffix="_sha256").columns == ["k", "email_sha256"]
    assert df.select(F.sha2("email", 256)).first()[0] == out[0].email


def test_save_report_append_keeps_history(spark, scratch):
    r = report.build_report(_summaries(spark, THREE_GOOD), _gates(spark))
    save_report(r, scratch + "/history", mode="append")
    save_report(r, scratch + "/history", mode="append")
    assert spark.read.json(scratch + "/history").count() == 2
