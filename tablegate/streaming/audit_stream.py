"""Audits of streams: mergeable state per key, one version per micro-batch.

Every audit's numbers are counts and exact sums per key, so the state of a
stream is the sum of the states of its batches. ``AuditState`` keeps, in a
folder on shared storage:

* ``rows/batch=<id>``: the gated rows of the batch, written once; all else is
  read from them;
* ``<part>/batch=<id>``: what the batch adds, one row per key;
* ``<part>/upto=<id>``: the sum of all batches up to that one, written every
  ``compact_every`` batches, so reading a version takes one such table and
  fewer than ``compact_every`` batches, however long the stream has run;
* ``versions/batch=<id>``: written last; a batch without it is not counted.

Folders are named by the batch id and overwritten. A batch that is run again,
after a lost driver or a restart from the stream's checkpoint, has the same
rows and so writes the same state: each row counts once. Nothing is listed but
``versions``, and no state passes the driver.

Parts of a fact stream: sums and counts per join key. Parts of a dimension
stream: copies per key and group, and rows per unique key. Both count NULLs.
``audit`` turns the two into the checks of the batch job; their results are
those of one batch over all rows (tests). Key columns keep their NULLs; an
empty batch adds nothing; a state without a version is an error when read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tablegate.operators.audit import completeness_of_counts, integrity_from, keys_without, uniqueness_from
from tablegate.operators.contract import Contract, gate, is_clean
from tablegate.operators.enrich import DEFAULT_SCALE
from tablegate.operators.reconcile import dim_copies, fact_sums, fused_comparison, reconciliation_from, totals_of
from tablegate.operators.summary import DEFAULT_SAMPLE, AuditCheck
from tablegate.session import checkpoint_root
from tablegate.sources.sinks import GATE_COLUMN, clean_flag


@dataclass(frozen=True)
class AuditState:
    """The state of one gated stream; ``group`` makes it a dimension, ``amount`` a fact stream."""

    spark: SparkSession
    path: str
    contract: Contract
    key: str = "customer_id"
    amount: str | None = None
    group: str | None = None
    unique: tuple[str, ...] = ()
    null_columns: tuple[str, ...] = ()
    compact_every: int = 16
    _keys: dict[str, list[str]] = field(init=False, repr=False, default_factory=dict)

    def __post_init__(self) -> None:
        if (self.amount is None) == (self.group is None):
            raise ValueError("give the amount of a fact stream or the group of a dimension stream")
        if self.compact_every < 1:
            raise ValueError("compact_every is 1 at least")
        self._keys["totals"] = [self.key] if self.amount else [self.key, self.group]
        if self.unique:
            self._keys["unique"] = list(self.unique)
        if self.null_columns:
            self._keys["nulls"] = ["column_name"]

    def _partials(self, rows: DataFrame) -> dict[str, DataFrame]:
        """What gated rows add to each part."""
        totals = (
            fact_sums(rows, self.key, self.amount, clean_flag=clean_flag())
            if self.amount
            else dim_copies(rows, self.key, self.group, clean_flag())
        )
        parts, kept = {"totals": totals}, rows.where(clean_flag())
        if self.unique:
            parts["unique"] = kept.groupBy(*self.unique).agg(F.count(F.lit(1)).alias("n"))
        if self.null_columns:
            counts = kept.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{k}") for k, c in enumerate(self.null_columns)])
            pairs = [F.struct(F.lit(c).alias("column_name"), F.col(f"n{k}").alias("n")) for k, c in enumerate(self.null_columns)]
            parts["nulls"] = counts.select(F.inline(F.array(*pairs)))
        return parts

    def _summed(self, part: str, frame: DataFrame) -> DataFrame:
        """Rows of equal keys added up, in the columns' own types."""
        keys = self._keys[part]
        values = [f for f in frame.schema.fields if f.name not in keys]
        return frame.groupBy(*keys).agg(*[F.sum(f.name).cast(f.dataType).alias(f.name) for f in values])

    def _tables(self, part: str, version: int) -> list[str]:
        """Folders whose sum is the part's state after the batch ``version``."""
        done = (version + 1) // self.compact_every * self.compact_every
        batches = [f"{self.path}/{part}/batch={b}" for b in range(done, version + 1)]
        return ([f"{self.path}/{part}/upto={done - 1}"] if done else []) + batches

    def _read(self, part: str, folders: list[str]) -> DataFrame:
        schema = self.spark.read.parquet(folders[-1]).schema
        return self._summed(part, self.spark.read.schema(schema).parquet(*folders))

    def update(self, batch: DataFrame, batch_id: int) -> None:
        """Gate a micro-batch and add it to the state; running a batch again changes nothing."""
        outcome = F.when(is_clean(), F.lit("clean")).otherwise(F.lit("rejected")).alias(GATE_COLUMN)
        folder = f"{self.path}/rows/batch={batch_id}"
        tagged = gate(batch, self.contract).select("*", outcome)
        tagged.write.mode("overwrite").partitionBy(GATE_COLUMN).parquet(folder)
        rows = self.spark.read.schema(tagged.schema).parquet(folder)
        for part, frame in self._partials(rows).items():
            _widened(frame).write.mode("overwrite").parquet(f"{self.path}/{part}/batch={batch_id}")
            if (batch_id + 1) % self.compact_every == 0:
                before = batch_id - self.compact_every
                folders = [f"{self.path}/{part}/upto={before}"] if before >= 0 else []
                folders += [f"{self.path}/{part}/batch={b}" for b in range(before + 1, batch_id + 1)]
                self._read(part, folders).write.mode("overwrite").parquet(f"{self.path}/{part}/upto={batch_id}")
        self.spark.range(1).write.mode("overwrite").parquet(f"{self.path}/versions/batch={batch_id}")

    def version(self) -> int:
        """The last batch that is whole."""
        return int(self.spark.read.parquet(f"{self.path}/versions").agg(F.max("batch")).first()[0])

    def part(self, name: str, version: int | None = None) -> DataFrame:
        """A part's state after the batch ``version`` (the last one): one row per key."""
        return self._read(name, self._tables(name, self.version() if version is None else version))

    def start(self, stream: DataFrame, checkpoint_location: str | None = None, trigger: dict | None = None) -> StreamingQuery:
        """Run the stream into this state; the checkpoint defaults to one named after the state's folder."""
        name = f"audit-{hashlib.sha256(self.path.rstrip('/').encode()).hexdigest()[:16]}"
        location = checkpoint_location or f"{checkpoint_root(self.spark)}/streams/{name}"
        writer = stream.writeStream.foreachBatch(self.update).option("checkpointLocation", location)
        return (writer.trigger(**trigger) if trigger else writer).start()


def _widened(frame: DataFrame) -> DataFrame:
    """Sums with all the digits that a sum of sums may need."""
    fields = frame.schema.fields
    wide = {f.name: T.DecimalType(38, f.dataType.scale) for f in fields if f.name.startswith("_") and isinstance(f.dataType, T.DecimalType)}
    return frame.select(*[F.col(f.name).cast(wide.get(f.name, f.dataType)).alias(f.name) for f in fields])


def audit(facts: AuditState, dims: AuditState, scale: int = DEFAULT_SCALE, sample_size: int = DEFAULT_SAMPLE) -> list[AuditCheck]:
    """A1, A2, A3 and A5 of what both streams have brought so far."""
    sums, copies = facts.part("totals"), dims.part("totals")
    checks = []
    counted = [(s.contract.name, s.part("nulls"), list(s.null_columns)) for s in (dims, facts) if s.null_columns]
    if counted:
        checks.append(completeness_of_counts(counted))
    if dims.unique:
        checks.append(uniqueness_from(dims.part("unique").where("n > 1"), list(dims.unique), sample_size))
    rows = sums.where("_clean_n > 0").select(facts.key, F.col("_clean_n").alias("n_rows"))
    parents = copies.where("_clean_copies > 0").select(dims.key).distinct()
    checks.append(integrity_from(keys_without(rows, parents, facts.key), facts.key, sample_size))
    totals = totals_of(sums.withColumns({c: F.col(c).cast(T.DecimalType(28, scale)) for c in ("_clean_sum", "_raw_sum")}), copies, facts.key, dims.group)
    checks.append(reconciliation_from(fused_comparison(totals, dims.group, scale), dims.group, sample_size=sample_size))
    return checks


def orphan_stream(
    child: DataFrame,
    parent: DataFrame,
    key: str,
    child_time: str,
    parent_time: str,
    patience: str = "1 hour",
    lateness: str = "10 minutes",
) -> DataFrame:
    """A3 on streams: child rows whose parent does not come within ``patience`` of the child's time.

    A stream-stream left outer join. A child waits in the join's state until the
    watermark (the least of both streams' latest times, less ``lateness``)
    has passed its time plus ``patience``; a parent that comes before then, also
    long after the child's arrival, makes it no orphan. Parents are kept for
    good, as any later child may name them. A NULL key matches nothing and is an
    orphan; a child without a time waits for good.
    """
    kids = child.withWatermark(child_time, lateness)
    known = parent.select(F.col(key).alias("_parent_key"), F.col(parent_time).alias("_parent_time"))
    known = known.withWatermark("_parent_time", lateness)
    in_time = F.col("_parent_time") <= F.col(child_time) + F.expr(f"INTERVAL {patience}")
    joined = kids.join(known, (F.col(key) == F.col("_parent_key")) & in_time, "left_outer")
    return joined.where(F.col("_parent_key").isNull()).select(*child.columns)
