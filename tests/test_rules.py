"""Contract rules and lax coercion (C1-C6), incl. the reference's contract cases."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.functions import rules
from tablegate.operators.contract import Contract, Field, gate
from tablegate.plans.contracts import CUSTOMER_CONTRACT, TRANSACTION_CONTRACT
from tablegate.sources.mock import CUSTOMER_SCHEMA, TRANSACTION_SCHEMA

pytestmark = pytest.mark.unit


def _violations(spark, rows, schema, contract):
    ann = gate(spark.createDataFrame(rows, schema), contract)
    return [[(v["field"], v["rule"]) for v in r["_violations"]] for r in ann.collect()]


def _cust(spark, row):
    return _violations(spark, [row], CUSTOMER_SCHEMA, CUSTOMER_CONTRACT)[0]


def _txn(spark, row):
    return _violations(spark, [row], TRANSACTION_SCHEMA, TRANSACTION_CONTRACT)[0]


# --- the reference's eight contract cases ----------------------------------------


def test_valid_customer_passes(spark):
    assert _cust(spark, (1, "Ana", "ana@email.com", "Colombia")) == []


def test_customer_email_none_rejected(spark):
    assert _cust(spark, (1, "Ana", None, "Colombia")) == [("email", "required")]


def test_customer_name_empty_rejected(spark):
    assert _cust(spark, (1, "", "ana@email.com", "Colombia")) == [("name", "not_blank")]


def test_customer_country_none_rejected(spark):
    assert _cust(spark, (1, "Ana", "ana@email.com", None)) == [("country", "required")]


def test_valid_transaction_passes(spark):
    assert _txn(spark, (100, 1, 200.0, "2025-01-01")) == []


def test_transaction_negative_amount_rejected(spark):
    assert _txn(spark, (100, 1, -1.0, "2025-01-01")) == [("amount", "positive")]


def test_transaction_none_amount_rejected(spark):
    assert _txn(spark, (100, 1, None, "2025-01-01")) == [("amount", "required")]


def test_transaction_wrong_date_format_rejected(spark):
    assert _txn(spark, (100, 1, 100.0, "01-01-2025")) == [("date", "iso_date")]


# --- edge cases the reference leaves untested -------------------------------------


def test_all_field_errors_reported(spark):
    assert _cust(spark, (None, None, "x", " ")) == [
        ("customer_id", "required"),
        ("name", "required"),
        ("email", "email"),
        ("country", "not_blank"),
    ]


@pytest.mark.parametrize("blank", ["", " ", "\t", " ", "　", "\x1c", " \n\r  "])
def test_whitespace_only_is_blank(spark, blank):
    assert _cust(spark, (1, blank, "a@b.co", "X")) == [("name", "not_blank")]


@pytest.mark.parametrize("value", ["a", " a ", "é", "0", "-"])
def test_not_blank_values_pass_untrimmed(spark, value):
    ann = gate(spark.createDataFrame([(1, value, "a@b.co", "X")], CUSTOMER_SCHEMA), CUSTOMER_CONTRACT)
    row = ann.first()
    assert row["_violations"] == [] and row["name"] == value


def test_whitespace_set_matches_python():
    ws = rules.whitespace_chars()
    assert all(c.isspace() for c in ws)
    assert ("x" + ws + "x").strip(ws) == ("x" + ws + "x").strip()


@pytest.mark.parametrize(
    "addr,ok",
    [
        ("ana@email.com", True),
        ("first.last+tag@sub.example.co", True),
        ("jürgen@bücher.de", True),
        ("user@host.test", False),
        ("user@mail.invalid", False),
        ("user@a.localhost", False),
        ("  a@b.com ", True),
        ("a" * 64 + "@x.com", True),
        ("a" * 65 + "@x.com", False),
        ("a@" + "b" * 63 + ".com", True),
        ("a@" + "b" * 64 + ".com", False),
        ("<a@x.com>", True),
        ("Ana <ana>", False),
        ("not-an-email", False),
        ("a@localhost", False),
        ("a..b@x.com", False),
        (".a@x.com", False),
        ("a@-x.com", False),
        ("a@x-.com", False),
        ("a b@x.com", False),
        ('"a"@x.com', False),
        ("a@[1.2.3.4]", False),
        ("Ana <ana@x.com>", True),
        ("a@x.com\n", True),
        ("a@x.c0m1", True),
        ("a@x.1com", False),
    ],
)
def test_email_rule(spark, addr, ok):
    df = spark.createDataFrame([(addr,)], "e string")
    assert df.select(rules.email()(F.col("e"))).first()[0] is ok


def test_email_length_cap(spark):
    long = "a" * 250 + "@x.com"
    df = spark.createDataFrame([(long,)], "e string")
    assert df.select(rules.email()(F.col("e"))).first()[0] is False


@pytest.mark.parametrize(
    "d,ok",
    [
        ("2025-01-01", True),
        ("2025-1-1", True),
        ("2024-02-29", True),
        ("2025-02-29", False),
        ("2025-13-01", False),
        ("0000-01-01", False),
        ("0001-01-01", True),
        (" 2025-01-01", False),
        ("2025-01-01 ", False),
        ("2025-01-01\n", False),
        ("2025-01-01T00:00", False),
        ("25-01-01", False),
        ("01-01-2025", False),
    ],
)
def test_iso_date_rule(spark, d, ok):
    df = spark.createDataFrame([(d,)], "d string")
    assert df.select(rules.iso_date()(F.col("d"))).first()[0] is ok


@pytest.mark.parametrize("cid", [0, -1])
def test_non_positive_customer_id_rejected(spark, cid):
    assert _txn(spark, (1, cid, 5.0, "2025-01-01")) == [("customer_id", "positive")]


def test_zero_amount_rejected(spark):
    assert _txn(spark, (1, 1, 0.0, "2025-01-01")) == [("amount", "positive")]


@pytest.mark.parametrize("amount", [float("nan"), float("inf")])
def test_nan_and_inf_pass_positive_but_not_finite(spark, amount):
    assert _txn(spark, (1, 1, amount, "2025-01-01")) == []
    strict = Contract("t", (Field("amount", T.DoubleType(), (rules.positive_amount(), rules.finite())),))
    df = spark.createDataFrame([(amount,)], "amount double")
    assert [(v["field"], v["rule"]) for v in gate(df, strict).first()["_violations"]] == [("amount", "finite")]


def test_lax_coercion_from_strings(spark):
    schema = "transaction_id string, customer_id string, amount string, date string"
    rows = [
        ("1", "\t2\n", "1e3", "2025-01-01"),
        ("1.5", "x", "abc", "2025-01-01"),
    ]
    ann = gate(spark.createDataFrame(rows, schema), TRANSACTION_CONTRACT).orderBy("_raw_amount").collect()
    good = [r for r in ann if r["_violations"] == []][0]
    assert (good["transaction_id"], good["customer_id"], good["amount"]) == (1, 2, 1000.0)
    bad = [r for r in ann if r["_violations"]][0]
    assert [(v["field"], v["rule"]) for v in bad["_violations"]] == [
        ("transaction_id", "type"),
        ("customer_id", "type"),
        ("amount", "type"),
    ]


def test_whole_floats_coerce_to_int_fractional_do_not(spark):
    c = Contract("x", (Field("id", T.LongType()),))
    df = spark.createDataFrame([(2.0,), (1.5,), (float("nan"),)], "id double")
    out = gate(df, c).collect()
    assert [r["id"] for r in out] == [2, None, None]
    assert [len(r["_violations"]) for r in out] == [0, 1, 1]


def test_string_field_rejects_numbers(spark):
    c = Contract("x", (Field("name", T.StringType()),))
    df = spark.createDataFrame([(5,)], "name bigint")
    assert [(v["field"], v["rule"]) for v in gate(df, c).first()["_violations"]] == [("name", "type")]


def test_missing_column_violates_required(spark):
    df = spark.createDataFrame([(1, "Ana", "Colombia")], "customer_id bigint, name string, country string")
    assert _violations(spark, [(1, "Ana", "Colombia")], df.schema, CUSTOMER_CONTRACT)[0] == [("email", "required")]
