"""Benchmark: every registered query plus the end-to-end audit job.

Reads ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``
and prints ONE JSON line. Each query is run to completion with the ``noop``
sink (full execution, nothing collected); ``e2e_audit`` is ``run_audit`` on
the dirty customer / transaction sources, writing its outputs under the
session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tablegate.plans.catalog import QUERIES  # noqa: E402
from tablegate.plans.job import run_audit  # noqa: E402
from tablegate.session import build_session, ensure_checkpoint_dir  # noqa: E402
from tablegate.sources import dirty  # noqa: E402


def _sf(path: str) -> float | str:
    m = re.search(r"sf([0-9.]+)", path)
    return float(m.group(1)) if m else path


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", app_name="tablegate-bench", shuffle_partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="tablegate-bench-ckpt-"))

    # Warm the JVM (class loading, codegen caches) on one query, untimed, and
    # the e2e code path on the smallest tables when they exist (other data, so
    # nothing measured below is computed ahead).
    QUERIES["gate_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if warm_dir != sf_dir and os.path.exists(os.path.join(warm_dir, "orders.parquet")):
        run_audit(spark, dirty.dirty_customers(spark, warm_dir), dirty.dirty_transactions(spark, warm_dir))

    times: dict[str, float] = {}
    for name, query in QUERIES.items():
        t0 = time.perf_counter()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)

    t0 = time.perf_counter()
    run = run_audit(spark, dirty.dirty_customers(spark, sf_dir), dirty.dirty_transactions(spark, sf_dir))
    times["e2e_audit"] = round(time.perf_counter() - t0, 3)

    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total_sec_all_queries_plus_e2e_audit",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": _sf(sf_dir),
                "cpus": cpus,
                "e2e_spark_jobs": run.jobs,
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
