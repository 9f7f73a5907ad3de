"""How often a plan reads the child table, and orphans whatever the keys."""

import re

import pytest

from tablegate.operators import audit
from tablegate.plans.catalog import QUERIES

from .conftest import SF_SMALL

pytestmark = pytest.mark.integration


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def _scans(plan, column):
    return len(re.findall(r"FileScan parquet \[[^\]]*" + column, plan))


def test_orphan_rows_read_the_child_once(spark):
    assert _scans(_final_plan(QUERIES["orphan_rows"](spark, SF_SMALL)), "o_orderkey") == 1


def test_referential_integrity_counts_and_samples_in_one_scan(spark, scratch):
    spark.range(500).selectExpr("id % 50 AS k").write.parquet(scratch + "/child")
    spark.range(0, 100, 2).selectExpr("id AS k").write.parquet(scratch + "/parent")
    check = audit.referential_integrity(
        spark.read.parquet(scratch + "/child"), spark.read.parquet(scratch + "/parent"), "k"
    )
    plan = _final_plan(check.summary)
    assert len(re.findall(r"FileScan parquet", plan)) == 2, plan
    assert check.summary.first().violation_count == 25


@pytest.mark.parametrize("name", ["audit_summary", "audit_report", "alert_outbox", "audit_violations", "audit_details"])
def test_report_queries_gate_each_source_once(spark, name, monkeypatch):
    from tablegate.plans import catalog

    gated = []
    write = catalog.write_split
    monkeypatch.setattr(catalog, "write_split", lambda df, path, entity, *a: gated.append(entity) or write(df, path, entity, *a))
    plan = _final_plan(QUERIES[name](spark, SF_SMALL))
    # The two writes read the sources; nothing after them does.
    assert gated == ["customers", "transactions"]
    assert _scans(plan, "o_orderkey") == 0 and _scans(plan, "c_custkey") == 0


def test_positions_follow_the_ordered_views(spark):
    shown = [r.country for r in QUERIES["spend_by_country"](spark, SF_SMALL).collect()]
    ranked = {r.position: r.country for r in QUERIES["spend_ranking"](spark, SF_SMALL).collect()}
    assert [ranked[i + 1] for i in range(len(shown))] == shown


def test_folders_without_a_checkpoint_dir():
    from types import SimpleNamespace

    from tablegate.session import run_folder

    def session(master):
        sc = SimpleNamespace(dir=None, getCheckpointDir=lambda: sc.dir, setCheckpointDir=lambda d: setattr(sc, "dir", d))
        conf = SimpleNamespace(get=lambda k, default=None: {"spark.master": master}.get(k, default))
        return SimpleNamespace(sparkContext=sc, conf=conf)

    local = session("local[2]")
    assert run_folder(local).startswith(local.sparkContext.dir) and run_folder(local) != run_folder(local)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        run_folder(session("spark://host:7077"))


def test_repeated_parent_keys_and_null_keys(spark):
    child = spark.createDataFrame([(1, 1), (2, None), (3, 9), (4, 9)], "t int, k int")
    parent = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert sorted(r.t for r in audit.orphan_rows(child, parent, "k").collect()) == [2, 3, 4]
