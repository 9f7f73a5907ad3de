"""Quality rules as a ledger: every rule once, failures as bits, then policies over the bits.

``ledger`` reads each text once and stores its measurements and one long whose
bit k is set if rule k fails. Policies are versioned masks: a document is kept
by a policy if ``failed & mask`` is zero, so changing a policy, or asking what
a rule alone removes, never reads a text again. ``ablation`` answers the
latter for all rules in one aggregation over the bits.

The measurements are made in numpy inside tasks (repeated five-word windows
need every word of a text at once); rules, policies and ablations are Column
expressions. No shuffle but for the ablation's sums.

Defined results: a null text counts as empty; an empty text fails the base
rules, as it has no words; texts are measured whole; repeated rows give rows
each; an empty table gives an empty ledger, and an ablation of zeros. Columns
of ``docs`` stay, but for those of the ledger's names, which it replaces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.llm.base import BATCH_BYTES, IS_SPACE, SpanHash, byte_flags, mapped, mix, pieces, quoted, raw_column, runs, workspace

WINDOW = 5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")
_IS_SYMBOL = byte_flags(b"#*$%&|<>")
_IS_CAPITAL = byte_flags(bytes(range(65, 91)))



def rules() -> list[tuple[str, Column]]:
    """Name and failure of each rule; a rule's place is its bit, so new ones go to the end."""
    words = F.col("n_words")
    return [
        ("few_words", words < 10),
        ("repeated_words", 100 * F.col("n_repeat_words") > 20 * words),
        ("symbols", 10 * F.col("n_symbols") > words),
        ("repeated_lines", (10 * F.col("n_dup_lines") > 3 * F.col("n_lines")) & (F.col("n_dup_lines") >= 3)),
        ("long_words", F.col("word_chars") > 15 * words),
        ("short_words", 2 * F.col("word_chars") < 5 * words),
        ("capitals", 10 * F.col("n_capitals") > 3 * F.col("word_chars")),
    ]


# Versions of the policy: the rules that each applies.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "repeated_lines"),
    "v2": ("few_words", "repeated_words", "symbols", "repeated_lines", "long_words", "short_words", "capitals"),
}
CURRENT = "v2"


def mask_of(policy: str) -> int:
    """The bits that a policy looks at."""
    names = [name for name, _ in rules()]
    return sum(1 << names.index(name) for name in POLICIES[policy])


def measure(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The measurements (columns of ``MEASURES``) of texts that lie one after another, each with a newline after it."""
    n = len(offsets) - 1
    out = np.zeros((n, len(MEASURES)), dtype=np.int64)
    solid = ~IS_SPACE[data]
    start, end = runs(solid)
    of = np.searchsorted(offsets, start, side="right") - 1
    out[:, 0] = np.bincount(of, minlength=n)

    def count(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return sums[offsets[1:]] - sums[offsets[:-1]]

    out[:, 1] = count(solid & (data & 0xC0 != 0x80))
    out[:, 2] = count(_IS_SYMBOL[data])
    out[:, 6] = count(_IS_CAPITAL[data])
    hashes = SpanHash(data)
    # Lines with a word: equal to an earlier line of the text.
    line_end = np.flatnonzero(data == 10)
    line_start = np.concatenate(([0], line_end[:-1] + 1)) if len(line_end) else line_end
    held = np.concatenate(([0], np.cumsum(solid, dtype=np.int64)))
    full = held[line_end] > held[line_start]
    line_start, line_end = line_start[full], line_end[full]
    line_of = np.searchsorted(offsets, line_start, side="right") - 1
    out[:, 5] = np.bincount(line_of, minlength=n)
    key = mix(hashes.of(line_start, line_end) ^ mix(line_of.astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    again = order[1:][key[order][1:] == key[order][:-1]]
    out[:, 3] = np.bincount(line_of[again], minlength=n)
    # Words that lie in a window found twice or more in the text.
    if len(start) >= WINDOW:
        word = hashes.of(start, end)
        last = len(word) - WINDOW + 1
        window = np.zeros(last, dtype=np.uint64)
        for k in range(WINDOW):
            window = mix(window + word[k : last + k] + np.uint64(k + 1))
        inside = np.flatnonzero(of[:last] == of[WINDOW - 1 :])
        key = mix(window[inside] ^ mix(of[inside].astype(np.uint64)))
        order = np.argsort(key)
        ranked = key[order]
        same = ranked[1:] == ranked[:-1]
        twice = np.zeros(len(key), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        steps = np.zeros(len(word) + 1, dtype=np.int64)
        np.add.at(steps, inside[twice], 1)
        np.add.at(steps, inside[twice] + WINDOW, -1)
        out[:, 4] = np.bincount(of[np.cumsum(steps[:-1]) > 0], minlength=n)
    return out


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measurements of each text."""
    workspace(docs.sparkSession, "rules")
    docs = docs.select(*[F.col(quoted(c)) for c in docs.columns if c not in MEASURES or c == text])
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measure(data, offsets) for _, _, data, offsets in pieces(raw_column(batch.column(at)), BATCH_BYTES)]
            if found:
                table = np.concatenate(found)
                extra = [pa.array(table[:, k]) for k in range(len(MEASURES))]
                yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*batch.schema.names, *MEASURES])

    return mapped(docs, run, [T.StructField(m, T.LongType()) for m in MEASURES])


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """``measured`` with the long ``failed``: bit k is set if rule k fails."""
    bits = [F.when(rule, F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, (_, rule) in enumerate(rules())]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measured(docs, text).withColumn("failed", failed)


def passes(policy: str = CURRENT) -> Column:
    """Whether a row of the ledger is kept by a policy."""
    return F.col("failed").bitwiseAND(F.lit(mask_of(policy)).cast("long")) == 0


def ablation(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of the policy: documents that fail it, and those that fail no other one of the policy (so return without it)."""
    mask = mask_of(policy)
    names = [name for name, _ in rules()]
    low = F.col("failed").bitwiseAND(F.lit(mask).cast("long"))
    # One row per distinct set of bits; the sets are at most 2 ** rules.
    sets = rows.groupBy(low.alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    bits = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(1 << names.index(n)).cast("long").alias("bit")) for n in POLICIES[policy]])
    each = sets.select("bits", "n", F.inline(bits))
    found = each.groupBy("rule").agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_failed_alone"),
    )
    listed = rows.sparkSession.range(1).select(F.inline(bits)).select("rule")
    return listed.join(found, "rule", "left").select("rule", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_failed", "n_failed_alone")])
