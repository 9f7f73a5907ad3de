"""Gate split, reasons, counts and quarantine sink (C7-C10, S4) on the mock data."""

import pytest
from pyspark.sql import types as T

from tablegate.operators.contract import clean, gate, gate_counts, rejected, violation_counts
from tablegate.plans.contracts import CUSTOMER_CONTRACT, TRANSACTION_CONTRACT
from tablegate.sources.mock import CUSTOMER_SCHEMA, mock_customers, mock_transactions
from tablegate.sources.sinks import write_split

pytestmark = pytest.mark.unit


def test_mock_customers_split(spark):
    ann = gate(mock_customers(spark), CUSTOMER_CONTRACT)
    assert sorted(r.customer_id for r in clean(ann).collect()) == [1, 4]
    rej = {r.customer_id: r.rejection_reason for r in rejected(ann).collect()}
    assert rej == {
        2: "email: is required",
        3: "country: is required",
        5: "name: is required",
    }


def test_mock_transactions_split(spark):
    ann = gate(mock_transactions(spark), TRANSACTION_CONTRACT)
    assert sorted(r.transaction_id for r in clean(ann).collect()) == [100, 101, 102, 104]
    assert [(r.transaction_id, r.rejection_reason) for r in rejected(ann).collect()] == [
        (103, "amount: is required")
    ]


def test_gate_counts_and_rule_counts(spark):
    ann = gate(mock_customers(spark), CUSTOMER_CONTRACT)
    row = gate_counts(ann, "customers").first()
    assert (row.entity, row.clean_rows, row.rejected_rows) == ("customers", 2, 3)
    counts = {(r.field, r.rule): r.n for r in violation_counts(ann).collect()}
    assert counts == {("email", "required"): 1, ("country", "required"): 1, ("name", "required"): 1}


def test_clean_rows_carry_typed_values_rejected_rows_raw(spark):
    df = spark.createDataFrame(
        [("7", "Ana", "a@b.co", "X"), ("x", "Bo", "b@b.co", "Y")],
        "customer_id string, name string, email string, country string",
    )
    ann = gate(df, CUSTOMER_CONTRACT)
    c = clean(ann)
    assert dict(c.dtypes)["customer_id"] == "bigint" and c.first().customer_id == 7
    r = rejected(ann).first()
    assert r.customer_id == "x" and r.rejection_reason == "customer_id: must be of type bigint"


def test_extra_columns_pass_through_and_reason_is_overwritten(spark):
    df = spark.createDataFrame(
        [(1, "", "a@b.co", "X", "old", 9)],
        "customer_id bigint, name string, email string, country string, rejection_reason string, extra int",
    )
    ann = gate(df, CUSTOMER_CONTRACT)
    r = rejected(ann).first()
    assert r.extra == 9 and r.rejection_reason == "name: must be a non-empty string"
    assert rejected(ann).columns.count("rejection_reason") == 1


def test_all_rejected_input_gives_typed_empty_clean(spark):
    df = spark.createDataFrame([(None, None, None, None)], CUSTOMER_SCHEMA)
    c = clean(gate(df, CUSTOMER_CONTRACT))
    assert c.count() == 0
    assert c.schema == T.StructType([T.StructField(f.name, f.dataType, True) for f in CUSTOMER_SCHEMA.fields])


def test_empty_input(spark):
    df = spark.createDataFrame([], CUSTOMER_SCHEMA)
    ann = gate(df, CUSTOMER_CONTRACT)
    row = gate_counts(ann).first()
    assert (row.clean_rows, row.rejected_rows) == (0, 0)


def test_write_split_one_pass_with_observed_counts(spark, scratch):
    split = write_split(gate(mock_customers(spark), CUSTOMER_CONTRACT), scratch + "/c", "customers")
    assert (split.clean_rows, split.rejected_rows) == (2, 3)
    assert sorted(r.customer_id for r in split.clean.collect()) == [1, 4]
    assert sorted(r.customer_id for r in split.rejected.collect()) == [2, 3, 5]
    assert "rejection_reason" in split.rejected.columns
    assert "_violations" not in split.clean.columns


def test_write_split_restores_raw_values(spark, scratch):
    df = spark.createDataFrame(
        [("7", "Ana", "a@b.co", "X"), ("x", "Bo", "b@b.co", "Y")],
        "customer_id string, name string, email string, country string",
    )
    split = write_split(gate(df, CUSTOMER_CONTRACT), scratch + "/s", "c")
    assert [r.customer_id for r in split.clean.collect()] == [7]
    assert [r.customer_id for r in split.rejected.collect()] == ["x"]


def test_quotes_in_field_names_and_messages(spark):
    from pyspark.sql import types as T

    from tablegate.functions.rules import Rule
    from tablegate.operators.contract import Contract, Field

    odd = Rule("it's", "can't be 'x' \\ here", lambda c: c != "x")
    c = Contract("odd", (Field("we'ird", T.StringType(), (odd,)),))
    df = spark.createDataFrame([("x",), ("y",)], "`we'ird` string")
    rows = rejected(gate(df, c)).collect()
    assert [r.rejection_reason for r in rows] == ["we'ird: can't be 'x' \\ here"]


def test_reserved_input_columns_fail_fast(spark):
    for name in ("_violations", "_gate", "_raw_email"):
        df = spark.createDataFrame([(1, "x")], f"customer_id bigint, `{name}` string")
        with pytest.raises(ValueError, match="reserved"):
            gate(df, CUSTOMER_CONTRACT)


def test_duplicate_contract_fields_rejected():
    from tablegate.operators.contract import Contract, Field

    with pytest.raises(ValueError, match="repeats"):
        Contract("x", (Field("a", T.LongType()), Field("a", T.StringType())))


def test_contract_from_spec_equals_builtin(spark):
    import json

    from tablegate.operators.contract import Contract
    from tablegate.sources.mock import mock_customers

    spec = json.loads(
        """{"name": "customers", "fields": [
             {"name": "customer_id", "type": "bigint"},
             {"name": "name", "type": "string", "rules": ["not_blank"]},
             {"name": "email", "type": "string", "rules": ["email"]},
             {"name": "country", "type": "string", "rules": ["not_blank"]}]}"""
    )
    c = Contract.from_spec(spec)
    assert c.schema() == CUSTOMER_CONTRACT.schema()
    mine = {r.customer_id: r.rejection_reason for r in rejected(gate(mock_customers(spark), c)).collect()}
    builtin = {r.customer_id: r.rejection_reason for r in rejected(gate(mock_customers(spark), CUSTOMER_CONTRACT)).collect()}
    assert mine == builtin
    with pytest.raises(ValueError, match="unknown rules"):
        Contract.from_spec({"name": "x", "fields": [{"name": "a", "type": "string", "rules": ["nope"]}]})
    opt = Contract.from_spec({"name": "x", "fields": [{"name": "a", "type": "decimal(10, 2)", "required": False}]})
    assert opt.fields[0].dtype == T.DecimalType(10, 2) and opt.fields[0].required is False
