"""Compare catalog queries with their DuckDB twins on one scale factor.

``python -m tablegate.plans.check /root/testdata/sf0.01 [name ...]`` prints
one line per query: rows on each side, column names, and whether the
order-insensitive multiset of rows is exactly equal. Used by the tests and by hand;
results are small enough to compare in the driver process of this tool.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from decimal import Decimal

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def _norm(v):
    """Exact comparison; only NaN (never equal to itself) and Decimal vs float are normalised."""
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if isinstance(v, Decimal):
        return float(v)
    return v


def _rows(records):
    return Counter(tuple(_norm(x) for x in r) for r in records)


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir: str, names: list[str] | None = None) -> dict[str, dict]:
    from tablegate.plans.catalog import QUERIES
    from tablegate.plans.oracle import ORACLE

    con = duck(sf_dir)
    out = {}
    for name in names or list(QUERIES):
        t0 = time.time()
        sdf = QUERIES[name](spark, sf_dir)
        s_cols = sorted(sdf.columns)
        s_rows = _rows([tuple(r[c] for c in s_cols) for r in sdf.collect()])
        t1 = time.time()
        res = {"spark_sec": round(t1 - t0, 2)}
        if name in ORACLE:
            rel = con.execute(ORACLE[name])
            d_names = [d[0] for d in rel.description]
            d_cols = sorted(d_names)
            idx = [d_names.index(c) for c in d_cols]
            d_rows = _rows([tuple(r[i] for i in idx) for r in rel.fetchall()])
            res.update(
                spark_rows=sum(s_rows.values()),
                oracle_rows=sum(d_rows.values()),
                columns_match=s_cols == d_cols,
                values_match=s_cols == d_cols and s_rows == d_rows,
            )
            if not res["values_match"]:
                res["spark_only"] = list((s_rows - d_rows).items())[:3]
                res["oracle_only"] = list((d_rows - s_rows).items())[:3]
                if s_cols != d_cols:
                    res["columns"] = (s_cols, d_cols)
        else:
            res.update(spark_rows=sum(s_rows.values()))
        out[name] = res
    return out


def main(argv: list[str]) -> int:
    import os

    sys.path.insert(0, os.getcwd())
    from tablegate.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    results = compare(spark, sf_dir, argv[2:] or None)
    bad = 0
    for name, r in results.items():
        ok = r.get("values_match", True)
        bad += not ok
        print(("OK  " if ok else "BAD ") + name, r, flush=True)
    print(f"{len(results) - bad}/{len(results)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
