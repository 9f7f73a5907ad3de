"""Sinks: quarantine split, JSON report, alert outbox.

``write_split`` writes the annotated frame ONCE, partitioned by gate
outcome, and gets the clean / rejected counts from an ``Observation`` on
that same write, so splitting and counting cost one scan of the source and
no extra job. Both halves are then read back from shared storage.
"""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tablegate.operators.contract import CORRUPT, VIOLATIONS, gate_count_columns, is_clean, quoted, rejected

logger = logging.getLogger(__name__)

GATE_COLUMN = "_gate"


@dataclass
class Split:
    """Outcome of a materialised gate."""

    path: str
    annotated: DataFrame
    clean: DataFrame
    rejected: DataFrame
    clean_rows: int
    rejected_rows: int
    clean_null_counts: dict[str, int]
    metrics: dict[str, int]


def outcome_columns(annotated: DataFrame, mask_rejected: list[str] | tuple[str, ...] = ()) -> list[Column]:
    """The gated columns as they are written.

    Raw copies are kept in rejected rows only. Of a masked column a rejected
    row holds the digest of what arrived, as text whatever its type: in the
    column itself where that is a string, else in its raw copy, the typed
    value being nulled. A masked column that does not exist is an error.
    """
    ok = is_clean()
    types = dict(annotated.dtypes)
    unknown = [c for c in mask_rejected if c not in types]
    if unknown:
        raise ValueError(f"columns to mask that are not there: {unknown}")

    def digest(c: str) -> Column:
        return F.sha2(F.col(quoted(c)).cast("string"), 256)

    out = []
    for c in annotated.columns:
        col = F.col(quoted(c))
        if c.startswith("_raw_"):
            col = F.when(~ok, digest(c) if c[len("_raw_") :] in mask_rejected else col)
        elif c in mask_rejected:
            col = F.when(ok, col).otherwise(digest(c) if types[c] == "string" else F.lit(None))
        out.append(col.alias(c))
        if c in mask_rejected and types[c] != "string" and "_raw_" + c not in types:
            out.append(F.when(~ok, digest(c)).alias("_raw_" + c))
    return out


def write_split(
    annotated: DataFrame,
    path: str,
    entity: str = "records",
    null_columns: list[str] | tuple[str, ...] = (),
    mask_rejected: list[str] | tuple[str, ...] = (),
    extra_metrics: list[Column] | tuple[Column, ...] = (),
) -> Split:
    """Write clean and rejected rows under ``path/_gate=clean|rejected``.

    Clean rows keep typed values (their ``_raw_`` copies are nulled, so cost
    nothing in parquet); rejected rows keep what arrived. The observation on
    the write also counts NULLs among the clean rows for ``null_columns``
    (the completeness audit), so no later scan is needed for them.
    ``Split.annotated`` is the whole written table (both halves, with the
    ``_gate`` outcome column; see ``clean_flag``).

    ``mask_rejected`` names PII columns whose values rejected rows hold as
    SHA-256 digests only (see ``outcome_columns``); clean rows keep theirs.
    ``extra_metrics`` are more aliased aggregate columns for the same
    observation; their values land in ``Split.metrics``.
    """
    obs = Observation(f"gate_{entity}_{uuid.uuid4().hex[:8]}")
    ok = is_clean()
    cols = outcome_columns(annotated, mask_rejected)
    present = set(annotated.columns)
    null_metrics = [
        F.count_if(ok & (F.col(c).isNull() if c in present else F.lit(True))).alias(f"null:{c}")
        for c in null_columns
    ]
    tagged = annotated.select(
        *cols, F.when(ok, F.lit("clean")).otherwise(F.lit("rejected")).alias(GATE_COLUMN)
    ).observe(obs, *gate_count_columns(), *null_metrics, *extra_metrics)
    # The observation sits in the write's result stage (the gate adds no
    # shuffle), so each task's counts are merged exactly once, retries included.
    tagged.write.mode("overwrite").partitionBy(GATE_COLUMN).parquet(path)
    counts = obs.get
    spark = annotated.sparkSession
    written = spark.read.schema(tagged.schema).parquet(path)
    # The partition value is the outcome: clean reads never touch ``_violations``.
    raw_copies = [c for c in written.columns if c.startswith("_raw_")]
    clean_part = written.filter(F.col(GATE_COLUMN) == "clean").drop(GATE_COLUMN, VIOLATIONS, CORRUPT, *raw_copies)
    rejected_part = written.filter(F.col(GATE_COLUMN) == "rejected").drop(GATE_COLUMN)
    logger.info("%s: %d clean, %d rejected", entity, counts["clean_rows"], counts["rejected_rows"])
    return Split(
        path=path,
        annotated=written,
        clean=clean_part,
        rejected=rejected(rejected_part),
        clean_rows=int(counts["clean_rows"]),
        rejected_rows=int(counts["rejected_rows"]),
        clean_null_counts={c: int(counts[f"null:{c}"]) for c in null_columns},
        metrics={k: int(v) for k, v in counts.items()},
    )


def clean_flag():
    """Outcome of a row of ``Split.annotated`` read from the partition value (free)."""
    return F.col(GATE_COLUMN) == "clean"


def save_report(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The one-row report as a folder with one JSON file (``mode='append'`` keeps history)."""
    report.coalesce(1).write.mode(mode).json(path)
    logger.info("report written under %s", path)


def write_outbox(outbox: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write the alert rows for a delivery process to drain.

    Overwrite by default, like every other output of a run, so re-running a
    run into the same folder is idempotent; ``mode='append'`` for a shared outbox.
    """
    outbox.write.mode(mode).json(path)
