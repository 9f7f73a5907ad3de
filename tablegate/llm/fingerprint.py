"""Document fingerprints by locally consistent parsing.

A text is a row of code points. Each level cuts its row into phrases and names
each phrase by a hash of what it holds; the names are the next level's row:

* a run of equal symbols becomes one symbol, so neighbours differ;
* deterministic coin tossing: a symbol's label is the place of the lowest bit
  in which it differs from the symbol before, with that bit's value; labels of
  neighbours differ again. Four rounds leave six labels;
* a phrase begins at every local maximum of the labels.

A cut depends on four symbols before it and one after, so equal substrings are
cut alike except near their ends, wherever they stand, and share the names of
their inner phrases on every level.

A fingerprint holds two times ``BINS`` least names (one-permutation MinHash),
whatever the text's length: first of the inner phrases of ``LEVELS``, then of
all phrases of the levels below. Likeness is the share of equal bins among
those that either has. The first bins count alone where both texts fill
``ENOUGH`` of them, the second ones alone where either text fills none (it is
short, or periodic, and has no inner phrase), and in between both count, in
proportion to the number that the text of fewer fills: a pair is compared by
the same levels on either side, and no length changes them at once.

The next document, for the edited text, is found by ranges of id and of the
first ``HEAD`` characters of the text: each range gets a copy of the first
document of the next one, is sorted, and read once. The ranges are Spark's, of
a table of these keys; a row finds its own by a search in halves. So ids of any
ordered type will do, an id of many rows is divided, texts are shuffled once,
no row is numbered over the whole table, and no text passes the driver. The
parsing is numpy inside tasks.

Defined results: null and empty texts have the empty fingerprint, like
(1.0) to each other and unlike (0.0) to all else; a text of one symbol
throughout has that symbol in place of phrases, so all of them are alike; ids that are null come
first; rows of equal id follow one another by their text, and the next of
repeated rows is the next row; a single document is its own next one; an
empty table gives an empty result; columns other than id and text are not
looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.llm.base import BATCH_BYTES, mapped, mix, quoted, save, workspace

BINS = 64
LEVELS = (3, 4, 5)  # phrases of about 20, 60 and 170 characters
ENOUGH = 16  # filled bins of LEVELS that tell two texts apart without the levels below; about 300 characters
ROUNDS = 4
HEAD = 16  # characters of a text by which rows of one id are divided
_BYTES = 2  # of a bin; 0 stands for an empty one
_POWER = np.array([pow(0x9E3779B97F4A7C55, k, 1 << 64) for k in range(64)], dtype=np.uint64)


def _lowest_bit(x: np.ndarray) -> np.ndarray:
    """The place of the lowest set bit (64 if there is none)."""
    return np.bitwise_count((x & (~x + np.ones(1, x.dtype))) - np.ones(1, x.dtype))


def _toss(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One round: labels of symbols that differ from their left neighbour; ``first`` marks where a text begins."""
    before = np.empty_like(x)
    before[1:] = x[:-1]
    before[first] = ~x[first]
    place = _lowest_bit(x ^ before)
    bit = (x >> place.astype(x.dtype)).astype(np.uint8) & np.uint8(1)
    return place * np.uint8(2) + bit


def parse(row: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The next level: (names of phrases, their texts); ``of`` is the rising text number of each symbol."""
    if not len(row):
        return row, of
    # Runs of equal symbols.
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (of[1:] != of[:-1])
    at = np.flatnonzero(new)
    length = np.diff(at, append=len(row))
    row, of = row[at], of[at]
    if length.max() > 1:
        row = mix(row + length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    else:
        row = mix(row + np.uint64(0xD6E8FEB86659FD93))
    begins = np.ones(len(row), dtype=bool)
    begins[1:] = of[1:] != of[:-1]
    first = np.flatnonzero(begins)
    label: np.ndarray = row
    for _ in range(ROUNDS):
        label = _toss(label, first)
    cut = begins
    if len(row) > 2:
        peak = np.zeros(len(row), dtype=bool)
        peak[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
        # A maximum needs both neighbours in its own text, and a phrase two symbols.
        peak[1:] &= ~begins[:-1]
        peak[:-1] &= ~begins[1:]
        cut = begins | peak
    at = np.flatnonzero(cut)
    width = np.diff(at, append=len(row))
    place = np.arange(len(row)) - np.repeat(at, width)
    names = np.add.reduceat(row * _POWER[np.minimum(place, 63)], at)
    return mix(names + width.astype(np.uint64)), of[at]


def _least(names: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """(texts, bins): the least name of each bin, 0 for an empty one."""
    out = np.full(n * BINS, 0xFFFF, dtype=np.uint16)
    spread = mix(names + np.uint64(0x632BE59BD9B4E019))
    value = (spread >> np.uint64(48)).astype(np.uint16)
    np.minimum.at(out, of * BINS + (spread & np.uint64(BINS - 1)).astype(np.int64), np.minimum(value, 0xFFFE))
    return (out + np.uint16(1)).reshape(n, BINS)


def sketches(texts: list[str]) -> np.ndarray:
    """One row of ``2 * BINS`` 16-bit values per text, of ``LEVELS`` and of those below; all 0 for an empty one."""
    n = len(texts)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=n)
    row = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64) + np.uint64(1)
    of = np.repeat(np.arange(n), lengths)
    # Texts of one symbol throughout have it in place of phrases, which would be named by their lengths.
    change = np.flatnonzero((row[1:] != row[:-1]) & (of[1:] == of[:-1]))
    bare = np.bincount(of[change], minlength=n) == 0
    single = np.flatnonzero(bare & (lengths > 0))
    high, low = ([], []), ([mix(row[(np.cumsum(lengths) - lengths)[single]])], [single])
    for level in range(1, max(LEVELS) + 1):
        row, of = parse(row, of)
        if level in LEVELS:
            # A text's first and last phrases depend on where it was cut off.
            begins = np.ones(len(of), dtype=bool)
            begins[1:] = of[1:] != of[:-1]
            ends = np.ones(len(of), dtype=bool)
            ends[:-1] = begins[1:]
            use, into = ~begins & ~ends, high
        else:
            use, into = ~bare[of], low
        into[0].append(mix(row[use] + np.uint64(level)))
        into[1].append(of[use])
    return np.hstack([_least(np.concatenate(names), np.concatenate(at), n) for names, at in (high, low)])


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bins, row by row, among those that either row has; of ``LEVELS`` as far as both have them."""
    used = ((a != 0) | (b != 0)).reshape(len(a), 2, BINS).sum(axis=2)
    same = ((a == b) & (a != 0)).reshape(len(a), 2, BINS).sum(axis=2)
    filled = np.minimum((a[:, :BINS] != 0).sum(axis=1), (b[:, :BINS] != 0).sum(axis=1))
    high = np.minimum(1.0, filled / ENOUGH)
    weight = np.stack((high, 1.0 - high), axis=1)
    used, same = (used * weight).sum(axis=1), (same * weight).sum(axis=1)
    return np.where(used > 0, same / np.where(used > 0, used, 1.0), 1.0)


def text_form(sketch: np.ndarray) -> list[str]:
    """Fingerprints as hex digits."""
    raw = sketch.astype(">u2").tobytes().hex()
    return [raw[i : i + BINS * 8] for i in range(0, len(raw), BINS * 8)]


def fingerprints(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of each text."""
    workspace(docs.sparkSession, "fingerprint")
    docs = docs.select(*[F.col(quoted(c)) for c in docs.columns if c != name or c == text])
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for part in _parts([x or "" for x in batch.column(at).to_pylist()]):
                found.extend(text_form(sketches(part)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*batch.schema.names, name])

    return mapped(docs, run, [T.StructField(name, T.StringType())])


def _parts(texts: list[str], limit: int = BATCH_BYTES // 4) -> Iterator[list[str]]:
    """Runs of whole texts of about ``limit`` characters."""
    part, size = [], 0
    for x in texts:
        part.append(x)
        size += len(x)
        if size >= limit:
            yield part
            part, size = [], 0
    if part:
        yield part


def edited(text: str, following: str) -> str:
    """``text`` with its last half, rounded down, replaced by as much of the beginning of ``following``."""
    m = len(text) // 2
    return text[: len(text) - m] + following[:m]


_TYPES = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
_COLUMNS = [x.split()[0] for x in _TYPES.split(", ")]


def _edited_rows(id_type: pa.DataType):
    def rows(keys: list, texts: list[str]) -> pa.RecordBatch:
        """Of each text but the last, which is only the next one of the one before."""
        both = [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
        own = sketches(texts)
        new = sketches(both)
        columns = [
            pa.array(keys, id_type),
            pa.array([len(x) for x in texts[:-1]], pa.int64()),
            pa.array([hashlib.sha256(x.encode()).hexdigest() for x in both], pa.string()),
            pa.array(text_form(own[:-1]), pa.string()),
            pa.array(text_form(new), pa.string()),
            pa.array(likeness(own[:-1], new), pa.float64()),
            pa.array(likeness(own[:-1], own[1:]), pa.float64()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", *_COLUMNS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, texts, size = [], [], 0
        for batch in batches:
            flags = batch.column(2).to_pylist()
            for key, text, copy in zip(batch.column(0).to_pylist(), batch.column(1), flags, strict=True):
                text = text.as_py() or ""
                keys.append(key)
                texts.append(text)
                size += len(text)
                if copy:  # the end of a range
                    yield rows(keys[:-1], texts)
                    keys, texts, size = [], [], 0
                elif size >= BATCH_BYTES // 4 and len(texts) > 1:
                    yield rows(keys[:-1], texts)
                    keys, texts, size = keys[-1:], texts[-1:], len(texts[-1])

    return run


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text", ranges: int | None = None) -> DataFrame:
    """Per document: fingerprints of its text and of its edited text, and what they are like (see ``_COLUMNS``)."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    path = workspace(spark, "fingerprint")
    id_type = docs.schema[id_col].dataType
    rows = docs.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(text)).alias("text"))
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Ranges of ids and of the beginnings of texts, so that rows of one id are divided too; nulls come first.
    # Strings as bytes have the same order, and come back from JSON as they were.
    body = F.coalesce("text", F.lit(""))
    ordered = F.col("doc_id").cast("binary") if isinstance(id_type, T.StringType) else F.col("doc_id")
    rows = rows.withColumn("key", F.struct(ordered.alias("id"), F.substring(body, 1, HEAD).cast("binary").alias("head")))
    # The first key of every range of keys, found without the texts: a row a range, and no range without rows.
    keys = save(rows.select("key"), f"{path}/keys")
    parts = keys.repartitionByRange(n, "key").select("key", F.spark_partition_id().alias("part"))
    first = parts.groupBy("part").agg(F.min("key").alias("key")).agg(F.sort_array(F.collect_list("key")).alias("keys"))
    # One value of n keys, as a constant of the plan.
    found = first.select(F.to_json("keys", _EXACT)).first()[0]
    starts = F.from_json(F.lit(found), first.schema["keys"].dataType, _EXACT)
    # A search in halves for the last range that begins at or before the row.
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(max(1, (n - 1).bit_length())))])

    def further(at: Column, step: Column) -> Column:
        return F.when((at + step < F.size(starts)) & (F.get(starts, at + step) <= F.col("key")), at + step).otherwise(at)

    rows = rows.withColumn("range", F.aggregate(steps, F.lit(0), further))
    # A copy of a range's first row goes to the range before, that of the first range to the last.
    firsts = rows.where(F.col("key") == F.get(starts, F.col("range")))
    copies = firsts.groupBy("range").agg(F.first("doc_id").alias("doc_id"), F.min(body).alias("text"))
    copies = save(copies, f"{path}/copies")
    copies = copies.withColumn("range", F.pmod(F.col("range") - 1, F.size(starts))).withColumn("copy", F.lit(True))
    whole = rows.drop("key").withColumn("copy", F.lit(False)).unionByName(copies)
    ranged = whole.repartitionById(n, F.col("range")).sortWithinPartitions("range", "copy", F.asc_nulls_first("doc_id"), F.coalesce("text", F.lit("")))
    return ranged.select("doc_id", "text", "copy").mapInArrow(_edited_rows(to_arrow_type(id_type)), f"doc_id {id_type.simpleString()}, {_TYPES}")
