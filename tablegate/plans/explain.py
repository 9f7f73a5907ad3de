"""Summarise the physical plan of every registered query as Markdown.

``python -m tablegate.plans.explain /root/testdata/sf0.1 > PLANS.md``

Uses the public ``DataFrame.explain("formatted")`` text (captured from
stdout): per query the parquet scans with their read schema and pushed
filters, the shuffles (hash / range), broadcasts, join strategies and
partial aggregations. The plan is the one Catalyst produces before AQE
re-plans at runtime (AQE may still turn a sort-merge join into a broadcast
join when the measured side is under its threshold).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "simple") -> str:
    """The text ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def formatted(df: DataFrame) -> str:
    return plan_text(df, "formatted")


def summarize(plan: str) -> dict:
    tree = plan.split("\n\n", 1)[0]
    scans = []
    for block in re.findall(r"\(\d+\) Scan parquet[^\n]*\n(.*?)(?:\n\n|\Z)", plan, re.S):
        loc = re.search(r"Location: \w+ \[([^\]]+)\]", block)
        schema = re.search(r"ReadSchema: struct<([^>]*)>", block)
        pushed = re.search(r"PushedFilters: \[([^\]]*)\]", block)
        scans.append(
            (
                os.path.basename(loc.group(1)) if loc else "?",
                [c.split(":")[0] for c in schema.group(1).split(",")] if schema else [],
                pushed.group(1) if pushed else "",
            )
        )
    return {
        "scans": scans,
        "hash_shuffles": len(re.findall(r"Exchange[^\n]*\n", tree)) - tree.count("BroadcastExchange"),
        "broadcasts": tree.count("BroadcastExchange"),
        "joins": sorted(set(re.findall(r"(BroadcastHashJoin \w+|SortMergeJoin \w+|ShuffledHashJoin \w+)", tree))),
        "partial_aggs": len(re.findall(r"partial_", plan)),
        "sorts": tree.count("Sort ("),
    }


def main(argv: list[str]) -> int:
    sys.path.insert(0, os.getcwd())
    from tablegate.plans.catalog import QUERIES
    from tablegate.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    print(f"# Physical plans of the registered queries ({sf_dir})\n")
    print("Generated by `python -m tablegate.plans.explain`; Catalyst's plan before AQE re-planning.\n")
    print("| query | scans (columns read; pushed filters) | shuffles | broadcasts | joins |")
    print("|---|---|---|---|---|")
    full = {}
    for name, q in QUERIES.items():
        plan = formatted(q(spark, sf_dir))
        s = summarize(plan)
        scans = "<br>".join(f"{t}: {', '.join(cols)}" + (f"; {p}" if p else "") for t, cols, p in s["scans"])
        print(f"| {name} | {scans} | {s['hash_shuffles']} | {s['broadcasts']} | {', '.join(s['joins']) or '-'} |")
        full[name] = plan
    for name in ("spend_by_country", "orphan_keys", "uniqueness_clean"):
        print(f"\n## {name}\n\n```\n{full[name].split(chr(10) + chr(10), 1)[0].strip()}\n```")
    spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
