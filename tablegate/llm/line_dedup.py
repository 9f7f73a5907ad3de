"""Line dedup by site-relative frequency, with DataFrame functions only.

For every host: the share of its pages that hold a line (trimmed, once per
page) is that line's boilerplate ratio. Lines above ``max_ratio`` on at least
``min_pages`` pages of the host are removed from the host's pages. The counts
are made per task before anything is shuffled (a host that holds a third of
all pages sends one row per task and line), on a 64-bit hash of the line; the
hashes of a host's boilerplate, at most (mean lines a page / max_ratio) of
them, are written and come to its pages by a join: Spark broadcasts them if
their size allows it, and then no text is shuffled; else it can split a large
host's rows. Texts are never exploded with their lines.

Defined results: a null host is a host of its own; a null text stays null and
has no lines; blank lines are never counted nor removed; a page whose every
line is boilerplate stays as it is (repeats of whole pages are for document
dedup); a line repeated in a page counts once for it and all its occurrences
go; repeated rows are pages of their own; an empty table gives an empty
result. All columns stay; ``n_lines`` and ``n_removed`` are set, in place of
columns of that name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegate.llm.base import quoted, save, workspace

MAX_RATIO = 0.08
MIN_PAGES = 5
_EDGE = "\t\x0b\x0c\r "
_HOST, _LINES, _GONE = "__tg_host", "__tg_lines", "__tg_gone"


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(_EDGE))


def boilerplate(pages: DataFrame, host: Column, text: str, max_ratio: float, min_pages: int) -> DataFrame:
    """(host, hashes): the hashes of each host's boilerplate lines."""
    rows = pages.select(host.alias("host"), F.col(quoted(text)).alias("text"))
    totals = rows.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    lines = F.transform(F.split("text", "\n", -1), _trimmed)
    hashes = F.array_distinct(F.transform(F.filter(lines, lambda x: x != ""), lambda x: F.xxhash64(x)))
    counts = rows.select("host", F.explode(hashes).alias("hash")).groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.where(F.col("n") >= min_pages)
    known = counts.join(totals.withColumnRenamed("host", "total_host"), F.col("host").eqNullSafe(F.col("total_host")))
    return known.where(F.col("n") > max_ratio * F.col("pages")).groupBy("host").agg(F.collect_list("hash").alias("hashes"))


def remove_boilerplate(
    pages: DataFrame,
    host: str | Column = "source",
    text: str = "text",
    max_ratio: float = MAX_RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """``pages`` without boilerplate lines, with ``n_lines`` and ``n_removed`` (lines that are not blank)."""
    of = F.col(quoted(host)) if isinstance(host, str) else host
    # Written, so that Spark knows its size before it plans the join and need not shuffle the texts for it.
    found = save(boilerplate(pages, of, text, max_ratio, min_pages), f"{workspace(pages.sparkSession, 'lines')}/found")
    found = found.select(F.col("host").alias(_HOST), F.col("hashes").alias(_GONE))
    joined = pages.join(found, of.eqNullSafe(F.col(_HOST)), "left").drop(_HOST)
    body = F.col(quoted(text))

    def gone(line: Column) -> Column:
        return (_trimmed(line) != "") & F.array_contains(_GONE, F.xxhash64(_trimmed(line)))

    def full(lines: Column) -> Column:
        return F.size(F.filter(lines, lambda x: _trimmed(x) != ""))

    left = F.filter(F.split(body, "\n", -1), lambda x: ~gone(x))
    out = joined.withColumn(_LINES, F.when(F.col(_GONE).isNotNull(), left))
    n_lines = F.coalesce(full(F.split(body, "\n", -1)), F.lit(0)).cast("long")
    n_left = F.coalesce(full(F.col(_LINES)), F.lit(0)).cast("long")
    out = out.withColumns({"n_lines": n_lines, "n_removed": F.when(F.col(_LINES).isNull(), F.lit(0)).otherwise(n_lines - n_left)})
    out = out.withColumn("n_removed", F.when(F.col("n_removed") == F.col("n_lines"), F.lit(0)).otherwise(F.col("n_removed")).cast("long"))
    out = out.withColumn(text, F.when(F.col("n_removed") > 0, F.array_join(_LINES, "\n")).otherwise(body))
    return out.drop(_LINES, _GONE)
