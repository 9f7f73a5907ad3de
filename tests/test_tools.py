"""The analysis tools: plan summaries (explain.py) and event-log stage times (stages.py)."""

import os
import subprocess
import sys
import textwrap

import pytest

from tablegate.plans.catalog import QUERIES
from tablegate.plans.explain import formatted, summarize

from .conftest import SF_SMALL

pytestmark = pytest.mark.unit


def test_plan_summary_shows_pruned_scans(spark):
    s = summarize(formatted(QUERIES["rule_positive_id"](spark, SF_SMALL)))
    assert s["scans"] == [("orders.parquet", ["o_orderkey", "o_custkey"], "")]
    assert s["hash_shuffles"] == 0 and s["broadcasts"] == 0


def test_stage_times_from_event_log(scratch):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    events = os.path.join(scratch, "events")
    os.makedirs(events)
    code = textwrap.dedent(
        f"""
        from pyspark.sql import SparkSession
        s = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "file://{events}").getOrCreate())
        df = s.range(1000)
        df.groupBy((df.id % 3).alias("k")).count().collect()
        s.stop()
        """
    )
    assert subprocess.run([sys.executable, "-c", code], capture_output=True, timeout=300).returncode == 0
    sys.path.insert(0, repo)
    from tablegate.plans.stages import stage_times

    stages = stage_times(events)
    assert stages and all(st["tasks"] >= 1 and st["wall_s"] >= 0 for st in stages)
    assert any("Exchange" in st["ops"] for st in stages)
