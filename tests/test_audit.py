"""Audits A1-A3 and their summaries (A7), incl. the reference's check cases."""

import json

import pytest

from tablegate.operators import audit
from tablegate.sources.mock import CUSTOMER_SCHEMA, TRANSACTION_SCHEMA

pytestmark = pytest.mark.unit

GOOD_C = [(1, "Liv", "liv@n.no", "Norway"), (4, "Sol", "sol@c.cl", "Chile")]
ODD_C = [(1, "Liv", "liv@n.no", "Norway"), (2, None, "liv@n.no", "Norway")]
GOOD_T = [(1, 1, 12.5, "2024-03-01"), (2, 4, 40.0, "2024-03-03")]
ODD_T = [(1, 1, 12.5, "2024-03-01"), (5, 3, None, "2024-03-05"), (6, 99, 9.0, "2024-03-06")]


def _c(spark, rows):
    return spark.createDataFrame(rows, CUSTOMER_SCHEMA)


def _t(spark, rows):
    return spark.createDataFrame(rows, TRANSACTION_SCHEMA)


def _summary(check):
    row = check.summary.first()
    return row.passed, row.violation_count, json.loads(row.details)


def _completeness(c, t):
    return audit.completeness([("customers", c, ["name", "email", "country"]), ("transactions", t, ["amount"])])


def test_no_nulls_counts_zero_per_column(spark):
    passed, n, details = _summary(_completeness(_c(spark, GOOD_C), _t(spark, GOOD_T)))
    assert passed is True and n == 0
    assert details == {"null_counts": {"name": 0, "email": 0, "country": 0, "amount": 0}}


def test_nulls_are_counted_per_column_in_order(spark):
    passed, n, details = _summary(_completeness(_c(spark, ODD_C), _t(spark, ODD_T)))
    assert passed is False and n == 2
    assert details["null_counts"] == {"name": 1, "email": 0, "country": 0, "amount": 1}
    assert list(details["null_counts"]) == ["name", "email", "country", "amount"]


def test_completeness_one_scan_per_table(spark):
    from tablegate.plans.explain import plan_text

    plan = plan_text(audit.null_counts(_c(spark, ODD_C), ["name", "email", "country"], "c"))
    assert plan.count("Scan ExistingRDD") == 1 and plan.count("Exchange") == 1  # one scan, one aggregate


def test_completeness_empty_tables_pass(spark):
    passed, n, _ = _summary(_completeness(_c(spark, []), _t(spark, [])))
    assert passed is True and n == 0


def test_distinct_emails_pass(spark):
    passed, n, details = _summary(audit.uniqueness(_c(spark, GOOD_C), "email"))
    assert passed is True and n == 0 and details["duplicate_emails"] == []


def test_shared_email_is_listed(spark):
    passed, n, details = _summary(audit.uniqueness(_c(spark, ODD_C), "email"))
    assert passed is False and n == 1
    assert "liv@n.no" in details["duplicate_emails"]


def test_uniqueness_null_is_a_group(spark):
    rows = [(1, "a", None, "X"), (2, "b", None, "X"), (3, "c", "A@x.com", "X"), (4, "d", "a@x.com", "X")]
    dups = audit.uniqueness(_c(spark, rows), "email").violations.collect()
    assert [(r.email, r.n) for r in dups] == [(None, 2)]


def test_uniqueness_sample_is_bounded_count_is_not(spark):
    rows = [(i, "n", f"u{i // 2}@x.com", "X") for i in range(40)]
    passed, n, details = _summary(audit.uniqueness(_c(spark, rows), "email", sample_size=3))
    assert passed is False and n == 20
    assert details["duplicate_emails"] == sorted(f"u{i}@x.com" for i in range(20))[:3]


def test_uniqueness_multi_column_key(spark):
    rows = [(1, "a", "e@x.com", "X"), (2, "a", "e@x.com", "Y"), (3, "a", "e@x.com", "X")]
    check = audit.uniqueness(_c(spark, rows), ["email", "country"])
    assert [(r.email, r.country, r.n) for r in check.violations.collect()] == [("e@x.com", "X", 2)]
    assert _summary(check)[2]["duplicate_email_countrys"] == [{"email": "e@x.com", "country": "X"}]


def test_referential_integrity_clean_passes(spark):
    passed, n, _ = _summary(audit.referential_integrity(_t(spark, GOOD_T), _c(spark, GOOD_C)))
    assert passed is True and n == 0


def test_referential_integrity_dirty_fails(spark):
    passed, n, details = _summary(audit.referential_integrity(_t(spark, ODD_T), _c(spark, GOOD_C)))
    assert passed is False
    assert 99 in details["orphan_customer_ids"] and 3 in details["orphan_customer_ids"]
    assert n == 2


def test_null_child_key_is_an_orphan(spark):
    t = _t(spark, [(1, None, 5.0, "2025-01-01"), (2, 1, 5.0, "2025-01-01")])
    keys = [r.customer_id for r in audit.orphan_keys(t, _c(spark, GOOD_C)).collect()]
    assert keys == [None]


def test_orphan_keys_distinct_orphan_rows_all(spark):
    t = _t(spark, [(1, 7, 5.0, "d"), (2, 7, 6.0, "d"), (3, 1, 1.0, "d")])
    c = _c(spark, GOOD_C + GOOD_C)  # duplicate parent keys do not matter
    assert [r.customer_id for r in audit.orphan_keys(t, c).collect()] == [7]
    assert sorted(r.transaction_id for r in audit.orphan_rows(t, c).collect()) == [1, 2]


def test_referential_integrity_counts_orphan_rows(spark):
    t = _t(spark, [(1, 7, 5.0, "d"), (2, 7, 6.0, "d"), (3, 8, 1.0, "d"), (4, 1, 1.0, "d")])
    passed, n, details = _summary(audit.referential_integrity(t, _c(spark, GOOD_C)))
    assert (passed, n, details["orphan_rows"], details["orphan_customer_ids"]) == (False, 2, 3, [7, 8])


def test_uniqueness_counts_duplicate_rows(spark):
    rows = [(1, "a", "x@y.co", "X"), (2, "b", "x@y.co", "X"), (3, "c", "x@y.co", "X"), (4, "d", "z@y.co", "X")]
    _, n, details = _summary(audit.uniqueness(_c(spark, rows), "email"))
    assert (n, details["duplicate_rows"]) == (1, 3)


def test_orphan_rows_keep_null_keys_and_duplicates(spark):
    t = _t(spark, [(1, None, 5.0, "d"), (2, None, 6.0, "d"), (3, 9, 1.0, "d"), (4, 9, 2.0, "d"), (5, 1, 1.0, "d")])
    rows = sorted(r.transaction_id for r in audit.orphan_rows(t, _c(spark, GOOD_C)).collect())
    assert rows == [1, 2, 3, 4]
    plain = sorted(r.transaction_id for r in t.join(_c(spark, GOOD_C).select("customer_id"), "customer_id", "left_anti").collect())
    assert rows == plain
