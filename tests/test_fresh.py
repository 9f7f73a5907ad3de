"""Data that arrives later is seen; outcomes of the gate are masked whatever their type."""

import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.functions.coercion import coerce
from tablegate.operators.contract import Contract, Field, gate
from tablegate.plans.catalog import QUERIES
from tablegate.plans.contracts import CUSTOMER_CONTRACT
from tablegate.sources import dirty
from tablegate.sources.sinks import write_split
from tablegate.streaming.gate_stream import gated_stream, start_gate_stream

from .conftest import SF_SMALL

pytestmark = pytest.mark.integration


def test_rows_appended_between_two_calls_are_seen(spark, scratch):
    for t in ("customer", "nation", "orders"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(f"{scratch}/{t}.parquet")

    def rows():
        return {r.entity: r.clean_rows + r.rejected_rows for r in QUERIES["gate_counts"](spark, scratch).collect()}

    before = rows()
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").write.mode("append").parquet(f"{scratch}/orders.parquet")
    assert rows()["transactions"] == 2 * before["transactions"]


def test_two_streams_of_one_contract_write_all_their_rows(spark, scratch):
    batch = dirty.dirty_customers(spark, SF_SMALL)
    batch.write.parquet(scratch + "/in")
    for out in ("/a", "/b"):
        stream = spark.readStream.schema(batch.schema).parquet(scratch + "/in")
        q = start_gate_stream(stream, CUSTOMER_CONTRACT, scratch + out)
        try:
            q.processAllAvailable()
        finally:
            q.stop()
        assert spark.read.parquet(scratch + out).count() == batch.count()


PHONES = Contract("c", (Field("k", T.LongType()), Field("phone", T.StringType())))


def test_rejected_values_of_any_type_are_masked(spark, scratch):
    df = spark.createDataFrame([(1, 5551234)], "k bigint, phone bigint")
    split = write_split(gate(df, PHONES), scratch + "/s", mask_rejected=["phone"])
    digest = hashlib.sha256(b"5551234").hexdigest()
    assert split.rejected.first().phone == digest
    written = spark.read.parquet(scratch + "/s").drop("_violations").first()
    assert "5551234" not in map(str, tuple(written)) and digest in tuple(written)
    ages = Contract("a", (Field("age", T.LongType()), Field("name", T.StringType())))
    odd = spark.createDataFrame([(41, None)], "age bigint, name string")
    assert write_split(gate(odd, ages), scratch + "/t", mask_rejected=["age"]).rejected.first().age == hashlib.sha256(b"41").hexdigest()


def test_unknown_masked_column_fails(spark, scratch):
    df = spark.createDataFrame([(1, "x")], "k bigint, phone string")
    with pytest.raises(ValueError, match="to mask"):
        write_split(gate(df, PHONES), scratch + "/s", mask_rejected=["fone"])
    with pytest.raises(ValueError, match="to mask"):
        gated_stream(df, PHONES, ("fone",))


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, "x", 2)], "k bigint, phone string, `x.y` int")
    assert gate(df, PHONES).columns[:3] == ["k", "phone", "x.y"]
    with pytest.raises(ValueError, match="upper and lower case"):
        gate(spark.createDataFrame([(1, "x", 2)], "k bigint, phone string, K int"), PHONES)


@pytest.mark.parametrize(
    "value,source,target,want",
    [
        ("12345678901234567.89", "string", "decimal(38,2)", "12345678901234567.89"),
        ("1.239", "string", "decimal(18,2)", None),
        ("1.2300", "string", "decimal(18,2)", "1.23"),
        ("1e3", "string", "decimal(18,2)", "1000.00"),
        ("1e-3", "string", "decimal(18,2)", None),
        ("nan", "string", "decimal(18,2)", None),
        ("9007199254740993.5", "decimal(20,1)", "bigint", None),
        ("9007199254740993.0", "decimal(20,1)", "bigint", "9007199254740993"),
        ("1.239", "double", "decimal(18,2)", None),
        ("1.25", "double", "decimal(18,2)", "1.25"),
        ("2020-01-01 00:00:00", "timestamp", "bigint", None),
        ("2020-01-01", "date", "double", None),
        ("1", "int", "date", None),
    ],
)
def test_conversions_lose_no_digit(spark, value, source, target, want):
    typed, ok = coerce(F.col("v"), T._parse_datatype_string(source), T._parse_datatype_string(target))
    df = spark.createDataFrame([(value,)], "s string").select(F.col("s").cast(source).alias("v"))
    row = df.select(F.when(ok, typed).cast("string").alias("v")).first()
    assert row.v == want


def test_array_source_is_a_type_violation(spark):
    df = spark.createDataFrame([([1],)], "k array<int>")
    out = gate(df, Contract("c", (Field("k", T.LongType()),))).first()
    assert [v.rule for v in out["_violations"]] == ["type"]
