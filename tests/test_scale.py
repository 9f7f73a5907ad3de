"""Scale properties: hot keys, shuffle shape, no cross joins, no Python in plans.

Skewed inputs are derived from the driver tables by Spark (a third of the
orders re-keyed to one customer, a third of the customers sharing one key);
results are checked against the plain, unoptimised formulation.
"""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
from tablegate.operators import audit, enrich, reconcile
from tablegate.plans.explain import plan_text
from tablegate.sources import dirty

from .conftest import SF_MID, SF_SMALL

pytestmark = pytest.mark.integration

HOT = 1


def _hot_facts(spark, sf):
    t = dirty.clean_transactions_source(spark, sf)
    return t.withColumn("customer_id", F.when(F.col("transaction_id") % 3 == 0, F.lit(HOT)).otherwise(F.col("customer_id")))


def _hot_dims(spark, sf):
    c = dirty.clean_customers_source(spark, sf)
    return c.withColumn("customer_id", F.when(F.col("customer_id") % 3 == 0, F.lit(HOT)).otherwise(F.col("customer_id")))


def _plan(df):
    return plan_text(df, "simple")


def _exchanges_sit_on_partial_aggregates(plan: str) -> bool:
    """Every hash exchange's input is a (partial) HashAggregate: no raw-row shuffle."""
    lines = plan.splitlines()
    found = False
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            found = True
            child = lines[i + 1] if i + 1 < len(lines) else ""
            if "HashAggregate" not in child:
                return False
    return found


def test_hot_fact_key_totals_exact(spark):
    t, c = _hot_facts(spark, SF_MID), dirty.clean_customers_source(spark, SF_MID)
    hot_share = t.filter(F.col("customer_id") == HOT).count() / t.count()
    assert hot_share > 0.33
    fast = {r.country: r.total_amount for r in enrich.group_totals(t, c, as_double=False).collect()}
    plain = {
        r.country: r.s
        for r in t.join(c, "customer_id")
        .groupBy("country")
        .agg(F.sum(enrich.exact("amount")).alias("s"))
        .collect()
    }
    assert fast == plain


def test_hot_dim_key_fan_out_exact(spark):
    t, c = dirty.clean_transactions_source(spark, SF_SMALL), _hot_dims(spark, SF_SMALL)
    fast = {r.country: r.total_amount for r in enrich.group_totals(t, c, as_double=False).collect()}
    plain = {
        r.country: r.s
        for r in t.join(c, "customer_id").groupBy("country").agg(F.sum(enrich.exact("amount")).alias("s")).collect()
    }
    assert fast == plain
    raw = {r.country: r.raw_total for r in reconcile.raw_totals(t, c).collect()}
    assert raw == plain


def test_totals_shuffle_only_pre_aggregated_rows(spark):
    t, c = _hot_facts(spark, SF_SMALL), dirty.clean_customers_source(spark, SF_SMALL)
    assert _exchanges_sit_on_partial_aggregates(_plan(enrich.group_totals(t, c)))
    assert _exchanges_sit_on_partial_aggregates(_plan(audit.orphan_keys(t, c)))
    assert _exchanges_sit_on_partial_aggregates(_plan(audit.duplicate_keys(c, ["email"])))


def test_hot_key_orphans_and_duplicates(spark):
    t, c = _hot_facts(spark, SF_SMALL), _hot_dims(spark, SF_SMALL)
    keys = {r.customer_id for r in audit.orphan_keys(t, c).collect()}
    plain = {r.customer_id for r in t.select("customer_id").distinct().collect()} - {
        r.customer_id for r in c.select("customer_id").distinct().collect()
    }
    assert keys == plain
    dup = {r.customer_id: r.n for r in audit.duplicate_keys(c, ["customer_id"]).collect()}
    assert dup[HOT] == c.filter(F.col("customer_id") == HOT).count()


def test_fused_totals_under_skew(spark):
    from tablegate.operators.contract import gate
    from tablegate.plans.contracts import CUSTOMER_CONTRACT, TRANSACTION_CONTRACT

    t, c = _hot_facts(spark, SF_SMALL), _hot_dims(spark, SF_SMALL)
    fused = reconcile.fused_totals(gate(t, TRANSACTION_CONTRACT), gate(c, CUSTOMER_CONTRACT))
    got = {r.country: (r.clean_total, r.raw_total) for r in fused.collect()}
    raw = {r.country: r.raw_total for r in reconcile.raw_totals(t, c).collect()}
    assert {k: v[1] for k, v in got.items()} == raw


@pytest.mark.parametrize("name", sorted(entry_mod.queries()))
def test_plans_have_no_cross_join_and_no_python(spark, name):
    plan = _plan(entry_mod.queries()[name](spark, SF_SMALL))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                   "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas"):
        assert banned not in plan, (name, banned)
    assert not re.search(r"BroadcastExchange.*\n.*Scan parquet .*orders", plan), name
