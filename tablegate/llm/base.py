"""Helpers shared by the training-data operators: workspace, batches, word hashes."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.session import run_folder

# Words are separated by these six bytes everywhere in this subpackage.
SPACE = b"\t\n\x0b\x0c\r "
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
BATCH_BYTES = 1 << 20


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``; also lets workers import this package.

    Executors that do not have the package installed find it by the driver's
    path when they share it; on a cluster ship it with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return run_folder(spark, f"llm-{name}")


def save(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (also when it has no rows)."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mapped(df: DataFrame, run: Callable, added: list[T.StructField]) -> DataFrame:
    """``df.mapInArrow`` of a function that adds columns, whatever the names of the others are."""
    safe = [f"c{k}" for k in range(len(df.columns))]
    kept = [T.StructField(c, f.dataType) for c, f in zip(safe, df.schema.fields, strict=True)]
    out = df.toDF(*safe).mapInArrow(run, T.StructType([*kept, *added]))
    return out.toDF(*df.columns, *[f.name for f in added])


def computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with the column ``name``, evaluated once per row.

    The value goes through a generator over an array of one element: Catalyst
    copies the expression of a projected column into filters on it and into
    lambdas that use it, where it would be evaluated again for every element.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def plain_names(df: DataFrame, *named: str) -> tuple[DataFrame, ...]:
    """``df`` with its columns named c0, c1, ..., so that no name of its own is in the way, and the new names of ``named``."""
    return df.toDF(*[f"c{k}" for k in range(len(df.columns))]), *[f"c{df.columns.index(n)}" for n in named]


def quoted(name: str) -> str:
    """A column name that Spark reads as one name, dots included."""
    return "`" + name.replace("`", "``") + "`"


def remainder(column: str, modulus: int):
    """crc32 of an id as text, modulo ``modulus``; ids that are null count as the text ``null``."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("null"))), F.lit(modulus))


def raw_column(column: pa.Array) -> pa.Array:
    """The texts of an Arrow column, nulls as empty texts, each followed by a newline."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    return pc.binary_join_element_wise(texts, pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string()))


def pieces(texts: pa.Array, limit: int = BATCH_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``limit`` bytes: first row, last row + 1, bytes, text offsets.

    A text longer than the limit is a run of its own: texts are never cut.
    """
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=n + 1 + texts.offset)[texts.offset :]
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8)
    low = 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def byte_flags(chars: bytes) -> np.ndarray:
    """A table of 256 booleans that marks the given bytes."""
    table = np.zeros(256, dtype=bool)
    table[list(chars)] = True
    return table


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = byte_flags(SPACE)
# Letters for the classifiers: A-Z, a-z and every byte of a multi-byte character.
IS_LETTER = byte_flags(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) of every run of True."""
    edges = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    return edges[::2], edges[1::2]


_BASE = 0x9E3779B97F4A7C55  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = []


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, 2 * BATCH_BYTES)
        _powers[:] = [np.full(size, b, dtype=np.uint64) for b in (_BASE, _INVERSE)]
        for p in _powers:
            p[0] = 1
            np.multiply.accumulate(p, out=p)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finalizer of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class SpanHash:
    """64-bit hashes of many spans of one byte array, by prefix sums of a polynomial."""

    def __init__(self, data: np.ndarray):
        up, self._down = _power_table(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=self._sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray, salt: int = 0) -> np.ndarray:
        body = (self._sums[end] - self._sums[start]) * self._down[start]
        salted = np.uint64(salt * 0xD6E8FEB86659FD93 % (1 << 64))
        return mix(body + salted + (end - start).astype(np.uint64))
