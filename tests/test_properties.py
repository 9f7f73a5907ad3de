"""Property tests: Spark rules agree with Python's own semantics, batch by batch.

Each example is a list of values evaluated in ONE Spark job and compared with
a brute-force Python evaluation (``str.strip`` for blanks, ``strptime`` for
dates, Python's decimal sum for totals).
"""

from datetime import datetime
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablegate.functions import rules
from tablegate.operators import enrich

pytestmark = pytest.mark.unit

SETTINGS = settings(max_examples=8, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))

WS = rules.whitespace_chars()
TEXT = st.text(alphabet=st.sampled_from(list(WS) + list("ab é0-​")), max_size=6)


def _eval(spark, values, rule, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    out = df.select("i", rule(F.col("v")).alias("ok")).collect()
    return [r.ok for r in sorted(out, key=lambda r: r.i)]


@SETTINGS
@given(st.lists(TEXT, min_size=1, max_size=200))
def test_not_blank_equals_python_strip(spark, values):
    got = _eval(spark, values, rules.not_blank())
    assert got == [bool(v.strip()) for v in values]


def _strptime_ok(s: str) -> bool:
    try:
        datetime.strptime(s, "%Y-%m-%d")
        return True
    except ValueError:
        return False


DIGITS = st.text(alphabet="0123456789", min_size=0, max_size=5)
DATES = st.one_of(
    st.builds(lambda y, m, d: f"{y}-{m}-{d}", DIGITS, DIGITS, DIGITS),
    st.dates().map(lambda d: d.strftime("%Y-%m-%d")),
    st.dates().map(lambda d: f"{d.year:04d}-{d.month}-{d.day}"),
    st.text(alphabet="0123456789-", max_size=12),
)


@SETTINGS
@given(st.lists(DATES, min_size=1, max_size=200))
def test_iso_date_equals_strptime_on_ascii_digits(spark, values):
    got = _eval(spark, values, rules.iso_date())
    assert got == [_strptime_ok(v) for v in values]


AMOUNTS = st.decimals(min_value=-10**6, max_value=10**6, places=2, allow_nan=False, allow_infinity=False)


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 5), AMOUNTS), min_size=1, max_size=300), st.integers(1, 7))
def test_exact_totals_equal_python_decimal_sum(spark, rows, parts):
    facts = spark.createDataFrame([(k, float(a)) for k, a in rows], "customer_id bigint, amount double")
    dims = spark.createDataFrame([(k, f"G{k % 2}") for k in range(1, 6)], "customer_id bigint, country string")
    got = {
        r.country: r.total_amount
        for r in enrich.group_totals(facts.repartition(parts), dims, as_double=False).collect()
    }
    want: dict[str, Decimal] = {}
    for k, a in rows:
        g = f"G{k % 2}"
        want[g] = want.get(g, Decimal(0)) + Decimal(repr(float(a))).quantize(Decimal("0.01"), ROUND_HALF_UP)
    assert got == want


KEYS = st.one_of(st.none(), st.integers(1, 6))
GROUPS = st.one_of(st.none(), st.sampled_from(["A", "B", " ", "C"]))
AMTS = st.one_of(st.none(), st.sampled_from([-5.0, 0.0, 1.25, 10.0, 99.99]))


@SETTINGS
@given(
    st.lists(st.tuples(KEYS, AMTS), min_size=0, max_size=60),
    st.lists(st.tuples(KEYS, GROUPS), min_size=0, max_size=12),
)
def test_fused_totals_equal_explicit_joins(spark, facts_rows, dims_rows):
    """One-pass clean+raw totals == raw LEFT JOIN + clean INNER JOIN + FULL OUTER compare."""
    from tablegate.operators import reconcile
    from tablegate.operators.contract import clean, gate
    from tablegate.plans.contracts import CUSTOMER_CONTRACT, TRANSACTION_CONTRACT

    facts = spark.createDataFrame(
        [(i, k, a, "2025-01-01") for i, (k, a) in enumerate(facts_rows)],
        "transaction_id bigint, customer_id bigint, amount double, date string",
    )
    dims = spark.createDataFrame(
        [(k, "n", f"u{i}@x.co", g) for i, (k, g) in enumerate(dims_rows)],
        "customer_id bigint, name string, email string, country string",
    )
    tf, td = gate(facts, TRANSACTION_CONTRACT), gate(dims, CUSTOMER_CONTRACT)
    fused = reconcile.fused_comparison(reconcile.fused_totals(tf, td))
    explicit = reconcile.compare_totals(
        reconcile.raw_totals(facts, dims), enrich.group_totals(clean(tf), clean(td), as_double=False)
    )
    def rows(df):
        return sorted(((r.country, r.raw_total, r.clean_total) for r in df.collect()), key=lambda t: (t[0] is None, t[0] or ""))

    assert rows(fused) == rows(explicit)
