"""Sums of doubles that do not depend on the order of rows (G1, G2), and positions at any number of rows (O1, O2)."""

import math
import struct

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablegate.functions import exact_sum
from tablegate.operators import enrich
from tablegate.plans.explain import plan_text

pytestmark = pytest.mark.unit


def bits(x):
    return None if x is None else struct.pack(">d", x) if x == x else "nan"


def total(df):
    x = F.col("x")
    sums = df.groupBy(exact_sum.bin_of(x).alias("bin")).agg(F.sum(exact_sum.units(x)).alias("units"))
    items = F.collect_list(F.when(F.col("bin").isNotNull(), F.struct("bin", "units")))
    return sums.agg(exact_sum.total(items)).first()[0]


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, min_value=-1e300, max_value=1e300), min_size=1, max_size=60))
def test_sum_is_the_rounded_exact_sum(spark, values):
    got = total(spark.createDataFrame([(v,) for v in values], "x double"))
    want = math.fsum(values)
    # Two doubles hold the sum to over 100 bits, so it is the nearest double but for rare ties.
    assert got == want or abs(got - want) <= math.ulp(want)


@pytest.mark.parametrize("values", [
    [1e17, 0.125, -1e17], [5e-324] * 7, [1.7e308, -1.7e308, 5e-324], [2.0**k for k in range(-1074, 1000, 13)], [-0.0], [0.1] * 10,
    [float(2**53), 1.0, -1.0], [math.nextafter(2.0**k, 0) for k in range(-30, 60)], [2.0**-1022, 2.0**-1074, -(2.0**-1022)],
])
def test_sums_of_odd_doubles(spark, values):
    assert total(spark.createDataFrame([(v,) for v in values], "x double")) == math.fsum(values)


@pytest.mark.parametrize("values,want", [
    ([], None), ([None], None), ([None, 1.5], 1.5), ([float("nan"), 1.0], "nan"), ([float("inf"), 1.0], float("inf")),
    ([float("-inf"), -1.0], float("-inf")), ([float("inf"), float("-inf")], "nan"),
])
def test_sums_without_a_number(spark, values, want):
    got = total(spark.createDataFrame([(v,) for v in values], "x double"))
    assert bits(got) == (want if want == "nan" else bits(want))


def test_totals_have_the_same_bits_however_rows_are_dealt(spark):
    rng = np.random.default_rng(4)
    amounts = np.concatenate([rng.normal(size=1500) * 10.0 ** rng.integers(-12, 25, 1500), rng.integers(0, 9999, 500) / 100])
    facts = spark.createDataFrame([(int(k), float(a)) for k, a in zip(rng.integers(0, 40, 2000), amounts, strict=True)], "customer_id long, amount double")
    dims = spark.createDataFrame([(k, "AB"[k % 2]) for k in range(40)] + [(3, "A")], "customer_id long, country string")
    seen = set()
    for n, seed in ((1, 0), (3, 1), (7, 2), (16, 3)):
        dealt = facts.orderBy(F.rand(seed)).repartition(n)
        seen.add(tuple(sorted((r.country, bits(r.total_amount)) for r in enrich.group_totals(dealt, dims).collect())))
    assert len(seen) == 1
    # Plain sums of the same rows differ.
    plain = {tuple(facts.orderBy(F.rand(s)).coalesce(1).agg(F.sum("amount")).first()) for s in range(6)}
    assert len(plain) > 1


def test_positions_of_many_rows(spark):
    rows = spark.range(0, 20_000, 1, 9).select((F.col("id") % 501).cast("double").alias("v"), F.concat(F.lit("g"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("g"))
    rows = rows.union(spark.createDataFrame([(None, "a"), (None, None), (7.0, None), (7.0, "g000007")], "v double, g string"))
    ranked = enrich.ranked_desc(rows, "v", "g")
    got = [(r.v, r.g) for r in ranked.orderBy("position").collect()]
    want = sorted(((r.v, r.g) for r in rows.collect()), key=lambda r: (r[0] is None, -(r[0] or 0.0), r[1] is None, r[1] or ""))
    assert got == want
    assert sorted(r.position for r in ranked.collect()) == list(range(1, len(want) + 1))
    # The only window without a partition runs over the sizes of the ranges.
    assert plan_text(ranked, "simple").split("== Initial Plan ==")[0].count("Window [") == 1
    assert enrich.ranked_desc(rows.limit(0), "v", "g").collect() == []
