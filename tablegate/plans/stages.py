"""Stage timings from a Spark event log (no UI needed).

Run a job with ``spark.eventLog.enabled=true`` and ``spark.eventLog.dir`` set
to a scratch folder, then::

    python -m tablegate.plans.stages <event-log folder> [min_seconds]

prints, per completed stage, its job, wall time, task count and name, plus
the summed task run time (a stage can look long only because it ran next to
others). Reads plain, rolling (``eventlog_v2_*``) and zstd-compressed logs.
"""

from __future__ import annotations

import io
import json
import os
import sys


def _lines(path: str):
    with open(path, "rb") as fh:
        raw = fh.read()
    if path.endswith(".zstd"):
        import zstandard

        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
    yield from raw.decode("utf-8").splitlines()


def _files(root: str):
    for base, _, names in os.walk(root):
        for n in sorted(names):
            if not n.startswith(".") and not n.startswith("appstatus"):
                yield os.path.join(base, n)


def stage_times(root: str) -> list[dict]:
    job_of, task_ms, stages = {}, {}, []
    for path in _files(root):
        for line in _lines(path):
            e = json.loads(line)
            kind = e.get("Event")
            if kind == "SparkListenerJobStart":
                for s in e["Stage IDs"]:
                    job_of[s] = e["Job ID"]
            elif kind == "SparkListenerTaskEnd":
                m = e.get("Task Metrics") or {}
                task_ms[e["Stage ID"]] = task_ms.get(e["Stage ID"], 0) + m.get("Executor Run Time", 0)
            elif kind == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                scopes = []
                for rdd in si.get("RDD Info", []):
                    scope = rdd.get("Scope")
                    if scope:
                        name = json.loads(scope).get("name", "")
                        if name and name not in scopes:
                            scopes.append(name)
                stages.append(
                    {
                        "stage": si["Stage ID"],
                        "wall_s": (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000,
                        "tasks": si["Number of Tasks"],
                        "name": si["Stage Name"],
                        "ops": scopes,
                    }
                )
    for s in stages:
        s["job"] = job_of.get(s["stage"])
        s["task_s"] = task_ms.get(s["stage"], 0) / 1000
    return sorted(stages, key=lambda s: s["stage"])


def main(argv: list[str]) -> int:
    if len(argv) < 2:
        print(__doc__)
        return 1
    floor = float(argv[2]) if len(argv) > 2 else 0.0
    rows = stage_times(argv[1])
    for s in rows:
        if s["wall_s"] >= floor:
            print(f"job {s['job']} stage {s['stage']}: wall {s['wall_s']:.2f}s, tasks {s['tasks']}, "
                  f"task time {s['task_s']:.2f}s  {', '.join(s['ops'])[:90]}")
    print(f"{len(rows)} stages, summed wall {sum(s['wall_s'] for s in rows):.1f}s, "
          f"summed task time {sum(s['task_s'] for s in rows):.1f}s")
    return 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
