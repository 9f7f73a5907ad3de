"""bench.py prints exactly one JSON line with the agreed keys (smoke, sf0.001)."""

import json
import os
import subprocess
import sys

from tablegate.plans.catalog import QUERIES

import pytest

from .conftest import SF_SMALL

pytestmark = pytest.mark.integration


def test_bench_prints_one_json_line():
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2")
    proc = subprocess.run(
        [sys.executable, os.path.join(repo, "bench.py")], capture_output=True, text=True, timeout=900, env=env
    )
    assert proc.returncode == 0, proc.stderr[-2000:]
    lines = [line for line in proc.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    out = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(out) and out["unit"] == "sec"
    assert out["sf"] == 0.001 and set(out["queries"]) == {*QUERIES, "e2e_audit"}
    assert abs(out["value"] - sum(out["queries"].values())) < 0.01
