"""Every registered query against its DuckDB twin (the driver's gate, on sf0.001)."""

import pytest

import __spark_entry__ as entry_mod
from tablegate.plans.check import compare

from .conftest import SF_SMALL

pytestmark = pytest.mark.oracle


def test_every_query_has_an_oracle():
    from tablegate.plans.catalog import QUERIES

    assert set(QUERIES) <= set(entry_mod.queries())
    assert set(QUERIES) <= set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


def test_queries_match_oracle(spark):
    results = compare(spark, SF_SMALL)
    bad = {k: v for k, v in results.items() if not v.get("values_match")}
    assert not bad, bad


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert df.columns == ["country", "total_amount"] and len(rows) > 0
    totals = [r.total_amount for r in rows]
    assert totals == sorted(totals, reverse=True)


def test_import_creates_no_session():
    import subprocess
    import sys

    code = (
        "import sys; sys.path.insert(0, '.'); import tablegate, __spark_entry__; "
        "from pyspark import SparkContext; assert SparkContext._active_spark_context is None"
    )
    import os

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    assert subprocess.run([sys.executable, "-c", code], cwd=repo, timeout=120).returncode == 0
