"""One-row audit summaries with bounded samples.

Every audit check yields a *violations* DataFrame that stays distributed and
a one-row *summary* ``(check_name, passed, violation_count, details)``.
``details`` is a JSON string holding the count and at most ``sample_size``
violations, chosen by a total order: ``orderBy(...).limit(k)`` plans as a
per-task top-k plus a k-row merge, so no task and no driver ever sees more
than k rows however many violations exist.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUMMARY_COLUMNS = ["check_name", "passed", "violation_count", "details"]
DEFAULT_SAMPLE = 20


@dataclass
class AuditCheck:
    """Result of one audit: a one-row summary plus the full violations."""

    name: str
    summary: DataFrame
    violations: DataFrame


def sample_and_count(
    violations: DataFrame,
    order: list[str],
    sample_size: int = DEFAULT_SAMPLE,
    sums: dict[str, str] | None = None,
) -> DataFrame:
    """One row ``(violation_count bigint, sample array<struct<order...>>, *sums)``.

    Counting and sampling are two branches unioned into one global
    aggregate (no join of one-row frames); both branches read the same
    violations plan, which Spark's exchange reuse shares. ``sums`` maps an
    output name to a numeric violations column summed over all violations.
    """
    sums = sums or {}
    item = F.struct(*[F.col(c) for c in order])
    item_type = violations.select(item.alias("s")).schema["s"].dataType
    counted = violations.select(
        F.lit(1).alias("_n"),
        F.lit(None).cast(item_type).alias("_s"),
        *[F.col(src).cast("bigint").alias(f"_sum_{out}") for out, src in sums.items()],
    )
    # The summed columns break ties, and so are read by both branches: pruned
    # from one of them, they would make two exchanges of what is one.
    ties = [src for src in dict.fromkeys(sums.values()) if src not in order]
    sampled = (
        violations.select(item.alias("_s"), *ties)
        .orderBy(*[F.col("_s." + c).asc_nulls_first() for c in order], *ties)
        .limit(sample_size)
        .select(
            F.lit(0).alias("_n"),
            "_s",
            *[F.lit(None).cast("bigint").alias(f"_sum_{out}") for out in sums],
        )
    )
    return counted.unionByName(sampled).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("violation_count"),
        F.sort_array(F.collect_list("_s")).alias("sample"),
        *[F.coalesce(F.sum(f"_sum_{out}"), F.lit(0)).cast("bigint").alias(out) for out in sums],
    )


def summary_row(check_name: str, passed: Column, count: Column, details: Column) -> list[Column]:
    return [
        F.lit(check_name).alias("check_name"),
        passed.alias("passed"),
        count.cast("bigint").alias("violation_count"),
        details.alias("details"),
    ]


def sampled_summary(
    check_name: str,
    violations: DataFrame,
    order: list[str],
    sample_key: str,
    sample_size: int = DEFAULT_SAMPLE,
    flatten: str | None = None,
    sums: dict[str, str] | None = None,
) -> DataFrame:
    """Summary whose details are ``{"violation_count": n, *sums, sample_key: [...]}``.

    ``flatten`` names a single struct field to list bare values instead of
    objects (e.g. ``["a@x.com", ...]`` rather than ``[{"email": ...}]``).
    """
    agg = sample_and_count(violations, order, sample_size, sums)
    sample = F.col("sample")
    if flatten is not None:
        sample = F.transform(sample, lambda s: s[flatten])
    details = F.to_json(
        F.struct(F.col("violation_count"), *[F.col(out) for out in (sums or {})], sample.alias(sample_key))
    )
    return agg.select(*summary_row(check_name, F.col("violation_count") == 0, F.col("violation_count"), details))
