"""Reconciliation of group totals before and after cleaning.

Raw totals follow the reference: raw facts LEFT JOIN raw dimensions, keep
rows whose amount and group are not NULL, sum per group. The NOT NULL filter
on a dimension column turns the left join into an inner join, so it is
planned as one (``group_totals`` with both filters pushed below the
pre-aggregations). All totals are exact decimals; the comparison is exact
unless a ``tolerance`` is given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.operators.contract import is_clean
from tablegate.operators.enrich import DEFAULT_PRECISION, DEFAULT_SCALE, exact, group_totals, inexact, times_copies
from tablegate.operators.summary import DEFAULT_SAMPLE, AuditCheck, sampled_summary


INEXACT = ("raw_inexact", "clean_inexact")
SAME_ROWS = "same_rows"


def raw_totals(
    raw_facts: DataFrame,
    raw_dims: DataFrame,
    key: str = "customer_id",
    group: str = "country",
    amount: str = "amount",
    alias: str = "raw_total",
    precision: int = DEFAULT_PRECISION,
    scale: int = DEFAULT_SCALE,
    as_double: bool = False,
    count_inexact: bool = False,
) -> DataFrame:
    """A4: ``(group, raw_total)`` over raw rows with non-NULL amount and group.

    Duplicate raw dimension keys fan out and inflate the total, as in the
    reference; that is what the comparison is meant to expose.
    """
    return group_totals(
        raw_facts.filter(F.col(amount).isNotNull()),
        raw_dims.filter(F.col(group).isNotNull()),
        key=key,
        group=group,
        amount=amount,
        alias=alias,
        precision=precision,
        scale=scale,
        as_double=as_double,
        count_inexact=count_inexact,
    )


def _as_exact(c: str, scale: int):
    return F.col(c).try_cast(T.DecimalType(38, scale))


def compare_totals(
    raw: DataFrame,
    clean: DataFrame,
    group: str = "country",
    raw_col: str = "raw_total",
    clean_col: str = "total_amount",
    scale: int = DEFAULT_SCALE,
) -> DataFrame:
    """J4 + P2 + P8: every group of either side -> ``(group, raw_total, clean_total)``.

    Full outer join on the group, missing side as 0 (a missing group and a
    zero total are indistinguishable, as in the reference). NULL groups never
    match each other. Both inputs are one row per group, so the join is
    between two compact, duplicate-free frames. Where a side counts amounts that
    are no exact decimals (``<column>_inexact``), ``raw_inexact`` and
    ``clean_inexact`` follow.
    """

    def side(df: DataFrame, column: str, name: str) -> DataFrame:
        n = F.col(f"{column}_inexact") if f"{column}_inexact" in df.columns else F.lit(0)
        return df.select(F.col(group), _as_exact(column, scale).alias(f"{name}_total"), n.cast("bigint").alias(f"{name}_inexact"))

    zero = F.lit(0).cast(T.DecimalType(38, scale))
    none = F.lit(0).cast("bigint")
    counted = f"{raw_col}_inexact" in raw.columns or f"{clean_col}_inexact" in clean.columns
    both = side(raw, raw_col, "raw").join(side(clean, clean_col, "clean"), on=group, how="full_outer")
    totals = [F.coalesce(c, zero).alias(c) for c in ("raw_total", "clean_total")]
    counts = [F.coalesce(c, none).alias(c) for c in INEXACT] if counted else []
    return both.select(group, *totals, *counts)


def mismatches(comparison: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """Groups whose totals differ by more than ``tolerance`` (exact by default).

    Equal decimals prove nothing about amounts that are not in them, so a group
    with such amounts on either side is a mismatch too, unless the comparison
    shows that both sides hold the same rows (``same_rows``).
    """
    if tolerance == 0:
        differs = F.col("raw_total") != F.col("clean_total")
    else:
        differs = F.abs(F.col("raw_total") - F.col("clean_total")) > F.lit(tolerance)
    if set(INEXACT) <= set(comparison.columns):
        unproven = (F.col("raw_inexact") > 0) | (F.col("clean_inexact") > 0)
        if SAME_ROWS in comparison.columns:
            unproven = unproven & ~F.col(SAME_ROWS)
        differs = differs | unproven
    return comparison.filter(differs)


def deltas(comparison: DataFrame, scale: int = DEFAULT_SCALE) -> DataFrame:
    """A6 + P3: every group with ``delta = raw_total - clean_total`` (exact)."""
    return comparison.select(
        "*",
        (F.col("raw_total") - F.col("clean_total")).cast(T.DecimalType(38, scale)).alias("delta"),
    )


def to_double(df: DataFrame, columns: list[str]) -> DataFrame:
    """Cast exact totals to double for display and JSON output."""
    return df.select(*[F.col(c).cast("double").alias(c) if c in columns else F.col(c) for c in df.columns])


def reconciliation(
    raw_facts: DataFrame,
    raw_dims: DataFrame,
    clean_totals: DataFrame,
    key: str = "customer_id",
    group: str = "country",
    amount: str = "amount",
    clean_col: str = "total_amount",
    tolerance: float = 0.0,
    precision: int = DEFAULT_PRECISION,
    scale: int = DEFAULT_SCALE,
    sample_size: int = DEFAULT_SAMPLE,
) -> AuditCheck:
    """A5: pass iff every group total is unchanged by cleaning.

    ``clean_totals`` is ``(group, clean_col)``; pass the exact decimal totals
    (``group_totals(..., as_double=False)``) so equal data compares equal.
    """
    raw = raw_totals(raw_facts, raw_dims, key, group, amount, "raw_total", precision, scale, count_inexact=True)
    comparison = compare_totals(raw, clean_totals, group, "raw_total", clean_col, scale)
    return reconciliation_from(comparison, group, tolerance, sample_size)


def fused_totals(
    facts_annotated: DataFrame,
    dims_annotated: DataFrame,
    key: str = "customer_id",
    group: str = "country",
    amount: str = "amount",
    precision: int = DEFAULT_PRECISION,
    scale: int = DEFAULT_SCALE,
    clean_flag: Column | None = None,
) -> DataFrame:
    """Clean AND raw totals per group in one pass over each gated table.

    Inputs are gated frames holding every row (typed values and
    ``_violations``), e.g. a written split read back whole. Per key the facts
    give the clean sum / row count and the raw sum / row count (amount not
    NULL); per (key, group) the dimensions give the clean copies and the raw
    copies (group not NULL). One join of the two compact frames and one
    group-by yield ``(group, clean_total, clean_pairs, raw_total, raw_pairs)``:
    ``*_pairs`` is the number of joined rows, so ``clean_pairs > 0`` is exactly
    "the group appears in the clean join" and ``raw_pairs > 0`` "in the raw
    join". Equal to ``group_totals`` on the clean halves and ``raw_totals`` on
    the raw rows, without scanning the sources a second time. ``clean_flag``
    replaces the ``_violations`` test when the outcome is already a column
    (e.g. the partition value of a written split). The totals hold the amounts
    that are exact decimals; ``*_inexact`` counts the joined rows whose amount
    is not, ``raw_nan`` those that are NaN.
    """
    facts = fact_sums(facts_annotated, key, amount, precision, scale, clean_flag)
    return totals_of(facts, dim_copies(dims_annotated, key, group, clean_flag), key, group, precision, scale)


def fact_sums(
    facts_annotated: DataFrame,
    key: str = "customer_id",
    amount: str = "amount",
    precision: int = DEFAULT_PRECISION,
    scale: int = DEFAULT_SCALE,
    clean_flag: Column | None = None,
) -> DataFrame:
    """The facts' half of ``fused_totals``, one row per key; halves of parts of the facts add up."""
    ok = is_clean() if clean_flag is None else clean_flag
    odd = inexact(amount, precision, scale)
    amt = F.when(~odd, exact(amount, precision, scale))
    return facts_annotated.groupBy(key).agg(
        F.count_if(ok).alias("_clean_n"),
        F.sum(F.when(ok, amt)).alias("_clean_sum"),
        F.count_if(ok & odd).alias("_clean_odd"),
        F.count_if(F.col(amount).isNotNull()).alias("_raw_n"),
        F.sum(amt).alias("_raw_sum"),
        F.count_if(odd).alias("_raw_odd"),
        F.count_if(odd & F.isnan(F.col(amount).try_cast("double"))).alias("_raw_nan"),
    )


def dim_copies(
    dims_annotated: DataFrame, key: str = "customer_id", group: str = "country", clean_flag: Column | None = None
) -> DataFrame:
    """The dimensions' half of ``fused_totals``, one row per key and group; halves of parts add up."""
    ok = is_clean() if clean_flag is None else clean_flag
    return dims_annotated.groupBy(key, group).agg(
        F.count_if(ok).alias("_clean_copies"),
        F.count_if(F.col(group).isNotNull()).alias("_raw_copies"),
    )


def totals_of(
    facts: DataFrame,
    dims: DataFrame,
    key: str = "customer_id",
    group: str = "country",
    precision: int = DEFAULT_PRECISION,
    scale: int = DEFAULT_SCALE,
) -> DataFrame:
    """``fused_totals`` of its two halves, whole or added up."""
    total = T.DecimalType(38, scale)
    return (
        facts.join(dims, on=key, how="inner")
        .groupBy(group)
        .agg(
            F.sum(times_copies("_clean_sum", "_clean_copies", precision)).cast(total).alias("clean_total"),
            F.sum(F.col("_clean_n") * F.col("_clean_copies")).alias("clean_pairs"),
            F.sum(times_copies("_raw_sum", "_raw_copies", precision)).cast(total).alias("raw_total"),
            F.sum(F.col("_raw_n") * F.col("_raw_copies")).alias("raw_pairs"),
            F.sum(F.col("_clean_odd") * F.col("_clean_copies")).alias("clean_inexact"),
            F.sum(F.col("_raw_odd") * F.col("_raw_copies")).alias("raw_inexact"),
            F.sum(F.col("_raw_nan") * F.col("_raw_copies")).alias("raw_nan"),
        )
        .filter((F.col("clean_pairs") > 0) | (F.col("raw_pairs") > 0))
    )


def clean_side(fused: DataFrame, group: str = "country", alias: str = "total_amount") -> DataFrame:
    """G1 from ``fused_totals``: groups present in the clean join."""
    return fused.filter(F.col("clean_pairs") > 0).select(group, F.col("clean_total").alias(alias))


def fused_comparison(fused: DataFrame, group: str = "country", scale: int = DEFAULT_SCALE) -> DataFrame:
    """``compare_totals`` from ``fused_totals`` (no second join needed).

    The raw side holds groups with raw pairs, the clean side groups with
    clean pairs; a NULL group can only come from the clean side (raw rows
    with a NULL group are filtered), so one row per group is the full outer
    join of the two sides.
    """
    zero = F.lit(0).cast(T.DecimalType(38, scale))
    # Clean rows are raw rows, so as many of them are the same; NaN equals nothing, itself included.
    same = (F.col("raw_pairs") == F.col("clean_pairs")) & (F.col("raw_nan") == 0)
    return fused.select(
        group,
        F.when(F.col("raw_pairs") > 0, F.coalesce("raw_total", zero)).otherwise(zero).alias("raw_total"),
        F.when(F.col("clean_pairs") > 0, F.coalesce("clean_total", zero)).otherwise(zero).alias("clean_total"),
        *INEXACT,
        same.alias(SAME_ROWS),
    )


def reconciliation_from(
    comparison: DataFrame,
    group: str = "country",
    tolerance: float = 0.0,
    sample_size: int = DEFAULT_SAMPLE,
) -> AuditCheck:
    """A5 over an existing ``(group, raw_total, clean_total)`` comparison."""
    diff = mismatches(comparison, tolerance)
    counts = [c for c in INEXACT if c in diff.columns]
    # A count of none is null, which JSON details leave out.
    shown = to_double(diff, ["raw_total", "clean_total"]).withColumns({c: F.nullif(F.col(c), F.lit(0)) for c in counts})
    summary = sampled_summary(
        "reconciliation", shown, [group, "raw_total", "clean_total", *counts], f"{group}_mismatches", sample_size
    )
    return AuditCheck("reconciliation", summary, diff.drop(SAME_ROWS))
