"""Session helpers: configuration, the shared checkpoint folder, lineage cuts.

Library code never creates a session on import and never picks a
machine-local folder on a cluster: intermediate tables go under the folder the
cluster names in ``spark.checkpoint.dir``. Only tests, local benches and
sessions on a ``local`` master set one, and only when it is unset.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Settings that matter at any scale: AQE re-plans joins from measured sizes
# (broadcast only under the threshold, sort-merge otherwise), splits skewed
# join partitions and coalesces small shuffle partitions; UTC makes dates and
# the report timestamp independent of the machine.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    # The split write is partitioned by a 2-valued outcome: two open writers per
    # task replace a per-task sort of every row (checked in the physical plan).
    "spark.sql.maxConcurrentOutputFileWriters": "2",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "tablegate",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with ``RECOMMENDED_CONF``; ``master`` only for local runs."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**RECOMMENDED_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, read from the session."""
    root = None
    try:
        root = spark.sparkContext.getCheckpointDir()
    except Exception:  # Spark Connect has no SparkContext
        root = None
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise RuntimeError(
            "spark.checkpoint.dir is not set: point it at a folder every executor "
            "can reach (HDFS, S3, GCS, ...) before running a job that cuts lineage"
        )
    return root.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Use the session's checkpoint folder; set ``fallback`` only when none is set (tests)."""
    try:
        return checkpoint_root(spark)
    except RuntimeError:
        spark.sparkContext.setCheckpointDir(fallback)
        return checkpoint_root(spark)


def run_folder(spark: SparkSession, name: str = "tablegate") -> str:
    """A fresh folder for one job run under the shared checkpoint folder.

    A ``local`` session, whose tasks all share the driver's disk, gets a
    temporary checkpoint folder if it has none; on a cluster that is an error.
    """
    try:
        checkpoint_root(spark)
    except RuntimeError:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
            raise
        ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="tablegate-ckpt-"))
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as parquet at ``path`` and read it back.

    Cuts the lineage so later stages restart from the written files, not
    from the sources, when an executor is lost; the files live on shared
    storage, unlike cached blocks.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def literal_rows(spark: SparkSession, schema: T.StructType, rows: list[tuple]) -> DataFrame:
    """A small table of driver-side values, built from literals in the JVM.

    ``createDataFrame(list)`` ships the rows through a Python RDD, so every
    task starts a Python worker; for a handful of counters that dwarfs the
    work. Only for bounded data (a few rows per contract / entity).
    """
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)]) for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))
