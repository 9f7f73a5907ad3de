"""Task loss: a failed task attempt is retried and counted once.

Runs in a subprocess with its own ``local[2,4]`` session (4 attempts per
task). A test-only row function fails the first attempt of one task of the
gate write; the written split and the counts observed on the write must equal
a run without failures.
"""

import json
import subprocess
import sys
import textwrap

import pytest

from .conftest import SF_SMALL

pytestmark = pytest.mark.integration

SCRIPT = textwrap.dedent(
    """
    import json, sys, tempfile
    sys.path.insert(0, {repo!r})
    from pyspark import TaskContext
    from pyspark.sql import SparkSession, functions as F
    from tablegate.operators.contract import gate
    from tablegate.plans.contracts import CUSTOMER_CONTRACT
    from tablegate.sources import dirty
    from tablegate.sources.sinks import write_split

    spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "3").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")

    @F.udf("boolean")
    def fail_first_attempt(_):
        tc = TaskContext.get()
        if tc.partitionId() == 0 and tc.attemptNumber() == 0:
            raise RuntimeError("injected task failure")
        return True

    def failed_tasks(group):
        st = spark.sparkContext.statusTracker()
        n = 0
        for job in st.getJobIdsForGroup(group):
            for stage in st.getJobInfo(job).stageIds:
                info = st.getStageInfo(stage)
                n += info.numFailedTasks if info else 0
        return n

    src = dirty.dirty_customers(spark, {sf!r}).repartition(3, "customer_id")
    out = {{}}
    for name, frame in (("plain", src), ("flaky", src.filter(fail_first_attempt("customer_id")))):
        spark.sparkContext.setJobGroup(name, name)
        split = write_split(gate(frame, CUSTOMER_CONTRACT), tempfile.mkdtemp() + "/s", name, ["name"])
        failed = failed_tasks(name)
        out[name] = [split.clean_rows, split.rejected_rows, split.clean.count(), split.rejected.count(),
                     split.clean_null_counts["name"]]
        out[name + "_failed_tasks"] = failed
    print("RESULT " + json.dumps(out))
    """
)


def test_failed_task_attempt_is_retried_and_counted_once():
    import os

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    proc = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(repo=repo, sf=SF_SMALL)],
        capture_output=True,
        text=True,
        timeout=600,
    )
    lines = [line for line in proc.stdout.splitlines() if line.startswith("RESULT ")]
    assert lines, proc.stderr[-3000:]
    out = json.loads(lines[-1][len("RESULT "):])
    assert out["flaky_failed_tasks"] >= 1 and out["plain_failed_tasks"] == 0
    assert out["flaky"] == out["plain"]
    clean, rejected, clean_files, rejected_files, _ = out["plain"]
    assert (clean + rejected, clean_files, rejected_files) == (150, clean, rejected)
