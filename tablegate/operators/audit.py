"""Post-load audits: completeness, uniqueness, referential integrity (A1-A3).

Each check returns an ``AuditCheck``: the full violations as a distributed
DataFrame and a one-row summary whose details carry a bounded sample. No
check collects to the driver; the caller decides which action runs them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.operators.contract import union_all
from tablegate.operators.summary import DEFAULT_SAMPLE, AuditCheck, sampled_summary, summary_row


def null_counts(df: DataFrame, columns: list[str], entity: str, ordinal_base: int = 0) -> DataFrame:
    """A1 core: NULLs per column in ONE scan -> ``(entity, column_name, null_count)``.

    The reference runs one filter+count job per column; here every column
    is a ``count_if`` in a single partial/final aggregate, then ``stack``
    turns the one wide row into long form. A column missing from ``df`` is
    a NULL column (every row counts).
    """
    present = set(df.columns)
    aggs = [
        F.count_if(F.col(c).isNull() if c in present else F.lit(True)).alias(f"_n{i}")
        for i, c in enumerate(columns)
    ]
    stacked = F.stack(
        F.lit(len(columns)),
        *[x for i, c in enumerate(columns) for x in (F.lit(ordinal_base + i), F.lit(c), F.col(f"_n{i}"))],
    ).alias("ordinal", "column_name", "null_count")
    return df.agg(*aggs).select(F.lit(entity).alias("entity"), stacked)


def _completeness_check(long: DataFrame, names: list[str]) -> AuditCheck:
    """Summary over long-form counts ``(entity, ordinal, column_name, null_count)``."""
    label = F.when(
        F.col("column_name").isin([n for n in set(names) if names.count(n) > 1]),
        F.concat_ws(".", "entity", "column_name"),
    ).otherwise(F.col("column_name"))
    agg = long.agg(
        F.coalesce(F.sum("null_count"), F.lit(0)).alias("total"),
        F.sort_array(F.collect_list(F.struct("ordinal", label.alias("k"), F.col("null_count").alias("v")))).alias(
            "entries"
        ),
    )
    null_map = F.map_from_entries(F.transform("entries", lambda e: F.struct(e["k"], e["v"])))
    summary = agg.select(
        *summary_row(
            "completeness",
            F.col("total") == 0,
            F.col("total"),
            F.to_json(F.struct(null_map.alias("null_counts"))),
        )
    )
    return AuditCheck("completeness", summary, long.drop("ordinal"))


def completeness(tables: list[tuple[str, DataFrame, list[str]]]) -> AuditCheck:
    """A1: NULL counts for the given ``(entity, frame, columns)``; pass iff all 0.

    Details are ``{"null_counts": {column: n, ...}}`` in the given column
    order; a column name used by two entities is written ``entity.column``.
    """
    names = [c for _, _, cols in tables for c in cols]
    frames, base = [], 0
    for entity, df, cols in tables:
        frames.append(null_counts(df, cols, entity, base))
        base += len(cols)
    return _completeness_check(union_all(frames), names)


def completeness_from_counts(spark: SparkSession, counts: list[tuple[str, str, int]]) -> AuditCheck:
    """A1 from counts already observed elsewhere (e.g. during the gate write).

    ``counts`` is ``[(entity, column, null_count), ...]`` -- one entry per
    audited column, so the frame is bounded by the contract, not the data.
    """
    from tablegate.session import literal_rows

    schema = T.StructType(
        [
            T.StructField("entity", T.StringType()),
            T.StructField("ordinal", T.IntegerType()),
            T.StructField("column_name", T.StringType()),
            T.StructField("null_count", T.LongType()),
        ]
    )
    long = literal_rows(spark, schema, [(e, i, c, int(n)) for i, (e, c, n) in enumerate(counts)])
    return _completeness_check(long, [c for _, c, _ in counts])


def completeness_of_counts(tables: list[tuple[str, DataFrame, list[str]]]) -> AuditCheck:
    """A1 from frames ``(column_name, n)`` of counts kept elsewhere, one row per column of the list."""
    frames, base = [], 0
    for entity, counts, columns in tables:
        place = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("column_name")) + (base - 1)
        frames.append(
            counts.select(
                F.lit(entity).alias("entity"), place.cast("int").alias("ordinal"), "column_name", F.col("n").alias("null_count")
            )
        )
        base += len(columns)
    return _completeness_check(union_all(frames), [c for _, _, columns in tables for c in columns])


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """A2 core: key values occurring more than once -> ``(*keys, n)``.

    NULL is one group (two NULL e-mails are a duplicate); comparison is
    exact (case-sensitive, untrimmed). Partial aggregation before the
    shuffle makes a key that holds a third of the rows one row per task.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def uniqueness(df: DataFrame, keys: list[str] | str = "email", sample_size: int = DEFAULT_SAMPLE) -> AuditCheck:
    """A2: pass iff no key value repeats; details list repeated values."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return uniqueness_from(duplicate_keys(df, keys), keys, sample_size)


def uniqueness_from(dups: DataFrame, keys: list[str], sample_size: int = DEFAULT_SAMPLE) -> AuditCheck:
    """A2 over the repeated keys ``(*keys, n)``."""
    sample_key = "duplicate_" + "_".join(keys) + "s"
    summary = sampled_summary(
        "uniqueness", dups, keys, sample_key, sample_size,
        flatten=keys[0] if len(keys) == 1 else None, sums={"duplicate_rows": "n"},
    )
    return AuditCheck("uniqueness", summary, dups)


def orphan_key_counts(child: DataFrame, parent: DataFrame, key: str = "customer_id") -> DataFrame:
    """A3 core: child keys with no parent row and their child row counts -> ``(key, n_rows)``.

    Both sides are reduced per key first (partial aggregation), so each key
    crosses the shuffle once per task and a hot key cannot skew the join.
    Written as a left join + ``IS NULL`` rather than a left anti join:
    Catalyst pushes an anti join below the child's aggregation, which would
    shuffle every raw child key whenever the join is not broadcast. A NULL
    child key never matches and is reported as an orphan.
    """
    return keys_without(child.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")), parent.select(key).distinct(), key)


def keys_without(counts: DataFrame, parent_keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``(key, n_rows)`` whose key is none of the distinct ``parent_keys``."""
    found = parent_keys.select(F.col(key), F.lit(True).alias("_has_parent"))
    return counts.join(found, on=key, how="left").filter(F.col("_has_parent").isNull()).select(key, "n_rows")


def orphan_keys(child: DataFrame, parent: DataFrame, key: str = "customer_id") -> DataFrame:
    """Distinct orphan keys -> ``(key)``."""
    return orphan_key_counts(child, parent, key).select(key)


def orphan_rows(child: DataFrame, parent: DataFrame, key: str = "customer_id") -> DataFrame:
    """A3: every child row whose key has no parent row.

    One left anti join over one scan of the child; a NULL key matches nothing
    and so is an orphan. The parent is not made distinct first: with no
    aggregate between its shuffle and the join, AQE can split a child
    partition that a hot key fills, and where the parent's keys are measured
    to be small it broadcasts them and the child does not shuffle.
    """
    parent_keys = parent.select(F.col(key).alias("_parent_key"))
    return child.join(parent_keys, child[key] == parent_keys["_parent_key"], "left_anti")


def referential_integrity(
    child: DataFrame,
    parent: DataFrame,
    key: str = "customer_id",
    sample_size: int = DEFAULT_SAMPLE,
) -> AuditCheck:
    """A3: pass iff every child key exists in the parent.

    Details: distinct orphan keys (``violation_count``), orphan child rows
    (``orphan_rows``) and a bounded sample of keys. Violations: ``(key, n_rows)``.
    """
    return integrity_from(orphan_key_counts(child, parent, key), key, sample_size)


def integrity_from(orphans: DataFrame, key: str = "customer_id", sample_size: int = DEFAULT_SAMPLE) -> AuditCheck:
    """A3 over the orphan keys ``(key, n_rows)``."""
    summary = sampled_summary(
        "referential_integrity", orphans, [key], f"orphan_{key}s", sample_size,
        flatten=key, sums={"orphan_rows": "n_rows"},
    )
    return AuditCheck("referential_integrity", summary, orphans)
