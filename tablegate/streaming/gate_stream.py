"""The contract gate on a Structured Streaming source.

``gate`` is a stateless per-row projection, so it runs unchanged on a
``readStream`` frame. The gated stream goes to a file sink partitioned by
outcome (exactly-once through the sink's commit log), giving the same
clean / rejected layout as the batch ``write_split``.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tablegate.operators.contract import Contract, gate, is_clean
from tablegate.session import checkpoint_root
from tablegate.sources.sinks import GATE_COLUMN, outcome_columns


def gated_stream(stream: DataFrame, contract: Contract, mask_rejected: tuple[str, ...] = ()) -> DataFrame:
    """Annotated stream with the ``_gate`` outcome column; masked as ``write_split`` does."""
    ann = gate(stream, contract)
    ok = is_clean()
    cols = outcome_columns(ann, mask_rejected)
    return ann.select(*cols, F.when(ok, F.lit("clean")).otherwise(F.lit("rejected")).alias(GATE_COLUMN))


def start_gate_stream(
    stream: DataFrame,
    contract: Contract,
    output_path: str,
    checkpoint_location: str | None = None,
    trigger: dict | None = None,
    mask_rejected: tuple[str, ...] = (),
) -> StreamingQuery:
    """Write the gated stream as parquet under ``output_path/_gate=...``.

    The stream checkpoint defaults to a folder under ``spark.checkpoint.dir``
    named after the contract and the output, so that a stream with another
    output never takes up this one's offsets.
    """
    name = f"{contract.name}-{hashlib.sha256(output_path.rstrip('/').encode()).hexdigest()[:16]}"
    location = checkpoint_location or f"{checkpoint_root(stream.sparkSession)}/streams/{name}"
    writer = (
        gated_stream(stream, contract, mask_rejected)
        .writeStream.format("parquet")
        .partitionBy(GATE_COLUMN)
        .option("path", output_path)
        .option("checkpointLocation", location)
        .outputMode("append")
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
