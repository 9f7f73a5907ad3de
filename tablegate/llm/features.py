"""Hashed text features for the classifiers, and what both of them need of Spark.

A document has a feature or not. Features of a text: its words (runs of
letters, lower case), the first 4, 5 and 6 bytes of longer words, the pairs of
adjacent bytes with a sign, blank or capital as they stand, and the orders of
magnitude of its shares of repeated words and lines, signs and capitals. A feature is named by a 64-bit hash, so no
two share a weight in practice, and is found in bytes by prefix sums.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.llm.base import BATCH_BYTES, IS_LETTER, LOWER, SpanHash, mapped, mix, pieces, quoted, raw_column, runs, save
from tablegate.llm.rules import MEASURES, measure

_PREFIXES = (4, 5, 6)
_PAIR = np.uint64(0xA24BAED4963EE407)
_SHARES = np.array([0.0, 0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.8])
_CODES = (1 << 16) + 64  # pairs, then shares


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every occurrence of a feature in texts that lie one after another, each with a newline after it."""
    start, end = runs(IS_LETTER[data])
    hashes = SpanHash(LOWER[data])
    word_of = np.searchsorted(offsets, start, side="right") - 1
    of, found = [word_of], [hashes.of(start, end)]
    for k in _PREFIXES:
        long = np.flatnonzero(end - start > k)
        of.append(word_of[long])
        found.append(hashes.of(start[long], start[long] + k, salt=k))
    return np.concatenate(of), np.concatenate(found)


def pair_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, code) of the pairs of adjacent bytes that are signs, blanks or capitals; letters alone are words' work."""
    code = data[:-1].astype(np.int64) * 256 + data[1:]
    plain = IS_LETTER[data] & (LOWER[data] == data)
    odd = np.flatnonzero(~plain[:-1] | ~plain[1:])
    return np.searchsorted(offsets, odd, side="right") - 1, code[odd]


def shape_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, code) of the orders of magnitude of four shares; codes follow those of pairs."""
    m = dict(zip(MEASURES, measure(data, offsets).T, strict=True))
    shares = (("n_repeat_words", "n_words"), ("n_dup_lines", "n_lines"), ("n_symbols", "n_words"), ("n_capitals", "word_chars"))
    codes = []
    for k, (part, whole) in enumerate(shares):
        share = m[part] / np.maximum(1, m[whole])
        codes.append((1 << 16) + 16 * k + np.searchsorted(_SHARES, share))
    n = len(offsets) - 1
    return np.tile(np.arange(n), len(shares)), np.concatenate(codes)


def pair_hash(code: np.ndarray) -> np.ndarray:
    return mix(code.astype(np.uint64) + _PAIR)


class Lookup:
    """Places of features in a sorted list of chosen hashes."""

    def __init__(self, chosen: np.ndarray):
        self.chosen = chosen
        self._rough = np.zeros(1 << 20, dtype=bool)
        self._rough[(chosen >> np.uint64(44)).astype(np.int64)] = True
        place = np.searchsorted(chosen, hashes := pair_hash(np.arange(_CODES))).clip(max=max(0, len(chosen) - 1))
        self._pair = np.where(chosen[place] == hashes, place, -1) if len(chosen) else np.full(_CODES, -1)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, place) of the chosen features, each once per text."""
        if not len(self.chosen):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        of, found = features(data, offsets)
        near = np.flatnonzero(self._rough[(found >> np.uint64(44)).astype(np.int64)])
        of, found = of[near], found[near]
        place = np.searchsorted(self.chosen, found).clip(max=len(self.chosen) - 1)
        hit = self.chosen[place] == found
        pair_of, code = pair_codes(data, offsets)
        shape_of, shape = shape_codes(data, offsets)
        pair_of = np.concatenate((pair_of, shape_of))
        pair = self._pair[np.concatenate((code, shape))]
        of = np.concatenate((of[hit], pair_of[pair >= 0]))
        place = np.concatenate((place[hit], pair[pair >= 0]))
        both = np.unique(of * len(self.chosen) + place)
        return both // len(self.chosen), both % len(self.chosen)


def document_counts(rows: DataFrame, classes: int) -> DataFrame:
    """(feature, n0, n1, ...) of ``rows(label, text)``: in how many texts of each class a feature is."""
    names = [f"n{k}" for k in range(classes)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(0).to_numpy(zero_copy_only=False)
            for low, _, data, offsets in pieces(raw_column(batch.column(1)), 4 * BATCH_BYTES):
                of, found = features(data, offsets)
                pair_of, code = pair_codes(data, offsets)
                shape_of, shape = shape_codes(data, offsets)
                code = np.unique(np.concatenate((pair_of * _CODES + code, shape_of * _CODES + shape)))
                of = np.concatenate((of, code // _CODES))
                found = np.concatenate((found, pair_hash(code % _CODES)))
                key, inverse = np.unique(found, return_inverse=True)
                once = np.unique(inverse * (len(offsets) - 1) + of)
                which, text = once // (len(offsets) - 1), once % (len(offsets) - 1)
                seen = label[low + text]
                counts = [pa.array(np.bincount(which[seen == k], minlength=len(key)), pa.int64()) for k in range(classes)]
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), *counts], ["feature", *names])

    found = rows.select("label", "text").mapInArrow(run, "feature long, " + ", ".join(f"{n} long" for n in names))
    return found.groupBy("feature").agg(*[F.sum(n).alias(n) for n in names])


def contrast(inside: Column, n_inside: int, outside: Column, n_outside: int) -> Column:
    """How many standard errors apart a feature's shares of two groups are."""
    share = (inside + outside) / F.lit(float(max(1, n_inside + n_outside)))
    error = F.sqrt(share * (1 - share) * (1 / max(1, n_inside) + 1 / max(1, n_outside)))
    apart = inside / F.lit(float(max(1, n_inside))) - outside / F.lit(float(max(1, n_outside)))
    return F.coalesce(F.abs(apart / F.nullif(error, F.lit(0.0))), F.lit(0.0))


def matrix(rows: DataFrame, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labels and a 0/1 matrix of the chosen features, for a bounded sample ``rows(label, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = Lookup(chosen)
        for batch in batches:
            label = batch.column(0)
            for low, high, data, offsets in pieces(raw_column(batch.column(1))):
                bits = np.zeros((high - low, len(chosen)), dtype=bool)
                bits[look(data, offsets)] = True
                packed = [x.tobytes() for x in np.packbits(bits, axis=1)]
                yield pa.RecordBatch.from_arrays([label[low:high].cast(pa.int32()), pa.array(packed, pa.binary())], ["label", "bits"])

    got = rows.select("label", "text").mapInArrow(run, "label int, bits binary").toPandas()
    # Sorted, so that a fit does not depend on the order in which tasks end.
    got = got.sort_values(["label", "bits"], kind="stable")
    bits = np.frombuffer(b"".join(got["bits"]), dtype=np.uint8).reshape(len(got), -(-len(chosen) // 8))
    return got["label"].to_numpy(), np.unpackbits(bits, axis=1)[:, : len(chosen)].astype(np.float32)


def scored(docs: DataFrame, text: str, chosen: np.ndarray, weights: np.ndarray, names: list[str], link: Callable) -> DataFrame:
    """``docs`` with the doubles ``names``: ``link`` of each text's sum of weights, as columns of an array."""
    docs = docs.select(*[F.col(quoted(c)) for c in docs.columns if c not in names or c == text])
    shared = docs.sparkSession.sparkContext.broadcast((chosen, weights))  # at most some thousand features
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, weights = shared.value
        look = Lookup(chosen)
        for batch in batches:
            sums = []
            for low, high, data, offsets in pieces(raw_column(batch.column(at))):
                of, place = look(data, offsets)
                sums.append(np.bincount(of, weights=weights[place], minlength=high - low))
            if sums:
                values = link(np.concatenate(sums))
                extra = [pa.array(values[:, k], pa.float64()) for k in range(len(names))]
                yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*batch.schema.names, *names])

    return mapped(docs, run, [T.StructField(n, T.DoubleType()) for n in names])


def sampled(docs: DataFrame, labels: DataFrame | None, id_col: str, text: str, bound: int, path: str, seed: int) -> DataFrame:
    """(label, text) of at most ``bound`` documents: those of least id hash among the ids that ``labels(id, label)`` and ``docs`` have.

    Without labels, of all documents, with label 0. An id takes one place
    however many rows it has; of its labels, and of its texts if they differ,
    the greatest counts. Rows whose id is null have no place.
    """
    rows = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text)).alias("text"))
    held = rows.where(F.col("id").isNotNull()).select("id").distinct()
    if labels is None:
        known = held.select("id", F.lit(0).alias("label"))
    else:
        known = labels.where(F.col("label").isNotNull()).groupBy("id").agg(F.max("label").alias("label"))
        known = known.join(held, "id", "left_semi")  # ids that docs has not take no place
    few = save(known.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(bound), f"{path}-ids")
    # At most ``bound`` ids and labels are broadcast; each joins its rows once.
    rows = rows.join(F.broadcast(few), "id").groupBy("id").agg(F.max(F.struct("text", "label")).alias("r"))
    # Copies of a text count once, else what is rare in it would look common.
    return save(rows.groupBy("r.text").agg(F.max("r.label").alias("label")).select("label", "text"), path)
