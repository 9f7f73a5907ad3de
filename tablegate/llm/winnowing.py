"""Benchmark decontamination by winnowing.

A text's words are hashed in runs of ``GRAM`` words. Of every window of
``WINDOW`` words the least gram hash is kept; a window of a document that
equals a window of an item has the same least hash, so every shared span of
``WINDOW`` words or more is found, and as neighbouring windows mostly share
their least gram only one fingerprint in several words is looked up:

1. A text's windows in a row with the same least hash are one fingerprint
   ``(hash, first window, number of windows)``.
2. Fingerprints whose hash no item has are left out (a semi-join, so a hash
   that many items or documents have makes no extra rows).
3. Those left are extended to their windows in the texts they come from, and a
   window is a hit if its words are those of an item's window, compared as
   text: hashes only select.
4. Hits are grouped by text; their union is counted, and the items of the
   distinct windows are listed.

An item of fewer words than a window is one window of its own length; windows
of such lengths are compared as text at every place, without a hash before.

DataFrame functions only. Nothing is broadcast by hint: what is joined to the
documents is written first, so Spark broadcasts it below its own size limit and
sorts and merges beyond it. Texts are keyed by two 64-bit hashes, so copies of
a text are one group, aggregated before they are shuffled; texts themselves are
shuffled only where the list of those with a fingerprint is beyond that limit.

Defined results: a null or empty text has no words and no hits; items without
words hit nothing; rows of one item id are one item with all their windows; an
id that is null counts as an item named ``null``; repeated rows and ids of
documents stay rows of their own; empty tables give empty results or no hits.
Other columns than the named ones are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegate.llm.base import computed, quoted, save, workspace

GRAM = 5
WINDOW = 10
# What parts words: all of ASCII but digits and letters. Capitals are lowered before words are compared.
BETWEEN = "".join(c for c in map(chr, range(128)) if not c.isalnum())
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """The words of a text, A-Z in lower case; other letters stay as they are.

    All that parts words becomes a blank as capitals are lowered. Java divides a text at one plain character without
    a pattern; matching a class of characters takes several times as long.
    """
    spaced = F.translate(F.coalesce(text, F.lit("")), CAPITALS + BETWEEN, SMALL + " " * len(BETWEEN))
    return F.array_remove(F.split(spaced, " "), "")


def _at(array: str, i: Column, k: int) -> Column:
    return F.get(F.col(array), i + k)


def _worded(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with the array ``words`` in place of the text."""
    return computed(rows, "words", words_of(F.col(text))).drop(text)


def _places(n: Column) -> Column:
    """0, 1, ..., n - 1; empty where n is not positive."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _joined(words: str, first: Column, n: Column) -> Column:
    return F.array_join(F.slice(words, first + 1, n), " ")


def fingerprints(texts: DataFrame, gram: int, window: int) -> DataFrame:
    """``texts(..., words)`` to ``(..., h, first, n)``: the least hash of the windows first to first + n - 1."""
    keys = [F.col(quoted(c)) for c in texts.columns if c != "words"]
    rows = texts.where(F.size("words") >= window)
    rows = computed(rows, "codes", F.transform("words", lambda w: F.xxhash64(w))).drop("words")
    grams = _places(F.size("codes") - (gram - 1))
    rows = computed(rows, "grams", F.transform(grams, lambda i: F.xxhash64(*[_at("codes", i, k) for k in range(gram)]))).drop("codes")
    wide = window - gram + 1
    windows = _places(F.size("grams") - (wide - 1))
    least = (lambda i: F.least(*[_at("grams", i, k) for k in range(wide)])) if wide > 1 else (lambda i: _at("grams", i, 0))
    rows = computed(rows, "least", F.transform(windows, least)).drop("grams")
    starts = F.filter(_places(F.size("least")), lambda i: (i == 0) | (_at("least", i, 0) != _at("least", i, -1)))
    rows = computed(rows, "starts", starts)
    ends = F.slice(F.concat("starts", F.array(F.size("least"))), 2, F.size("starts"))
    runs = F.transform(
        F.arrays_zip(F.col("starts").alias("first"), ends.alias("last")),
        lambda r: F.struct(
            _at("least", r["first"], 0).alias("h"),
            r["first"].alias("first"),
            (r["last"] - r["first"]).alias("n"),
        ),
    )
    return computed(rows, "runs", runs).select(*keys, F.inline("runs"))


def _windows(bodies: DataFrame, found: DataFrame, keys: list[str], window: int, path: str) -> DataFrame:
    """Fingerprints extended to the windows they stand for: ``(*keys, first, n, words)``, n the window's length in words."""
    # A text has no more fingerprints than words. Written, so that its size is known when it is joined to the texts.
    runs = save(found.groupBy(*keys).agg(F.collect_set(F.struct("first", "n")).alias("runs")), f"{path}/fingerprints")
    each = F.flatten(
        F.transform(
            "runs",
            lambda r: F.transform(
                F.sequence(r["first"], r["first"] + r["n"] - 1), lambda i: F.struct(i.alias("first"), _joined("words", i, F.lit(window)).alias("words"))
            ),
        )
    )
    rows = computed(_worded(bodies.join(runs, keys), "body"), "each", each)
    return rows.select(*keys, F.inline("each")).withColumn("n", F.lit(window))


def _whole(texts: DataFrame, keys: list[str], length: int) -> DataFrame:
    """All windows of one length: ``(*keys, first, n, words)``."""
    each = F.transform(_places(F.size("words") - (length - 1)), lambda i: F.struct(i.alias("first"), _joined("words", i, F.lit(length)).alias("words")))
    return computed(texts, "each", each).select(*keys, F.inline("each")).withColumn("n", F.lit(length))


def item_windows(items: DataFrame, item_id: str, text: str, gram: int, window: int, path: str) -> tuple[DataFrame, DataFrame, list[int]]:
    """The items' windows ``(n, words, item)``, their fingerprints' hashes ``h``, and the lengths of short items."""
    named = items.select(
        F.coalesce(F.col(quoted(item_id)).cast("string"), F.lit("null")).alias("item"), F.col(quoted(text)).alias("body")
    )
    words = _worded(named, "body")
    words = save(words.where(F.size("words") > 0), f"{path}/items")
    hashes = save(fingerprints(words, gram, window).select("h").distinct(), f"{path}/hashes")
    short = words.where(F.size("words") < window).select("item", F.size("words").alias("n"), F.array_join("words", " ").alias("words"))
    table = _whole(words, ["item"], window).select("item", "n", "words").unionByName(short).distinct()
    # At most window - 1 numbers.
    lengths = sorted(r[0] for r in short.select("n").distinct().collect())
    return save(table, f"{path}/windows"), hashes, lengths


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    gram: int = GRAM,
    window: int = WINDOW,
) -> DataFrame:
    """One row per document: id, n_words, n_hit, n_items, items_sha256, contaminated."""
    if not 0 < gram <= window:
        raise ValueError("a gram has from 1 to `window` words")
    path = workspace(docs.sparkSession, "winnowing")
    table, hashes, lengths = item_windows(items, item_id, item_text, gram, window, path)
    body = F.coalesce(F.col(quoted(text)), F.lit(""))
    keys = {"k1": F.xxhash64(body), "k2": F.xxhash64(F.lit(window), body)}
    bodies = docs.select(*[c.alias(k) for k, c in keys.items()], body.alias("body"))
    texts = _worded(bodies, "body")
    found = fingerprints(texts, gram, window).join(hashes, "h", "left_semi").select(*keys, "first", "n")
    seen = _windows(bodies, found, list(keys), window, path)
    for n in lengths:
        seen = seen.unionByName(_whole(texts, list(keys), n))
    known = table.select("n", "words").distinct()
    hits = seen.join(known, ["n", "words"], "left_semi").distinct()
    # One row for each window that a text holds, whatever number of items has it.
    hits = save(hits, f"{path}/hits")
    # A word is hit if a window reaches it: with windows in order of start, each adds what lies beyond the furthest end so far.
    spans = hits.groupBy(*keys).agg(F.array_sort(F.collect_set(F.struct("first", (F.col("first") + F.col("n")).alias("end")))).alias("spans"))
    begun = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).alias("upto"))
    added = F.aggregate(
        "spans",
        begun,
        lambda a, s: F.struct(
            (a["hit"] + F.greatest(s["end"] - F.greatest(s["first"], a["upto"]), F.lit(0))).alias("hit"),
            F.greatest(s["end"], a["upto"]).alias("upto"),
        ),
    )
    words_hit = spans.select(*keys, added["hit"].alias("n_hit"))
    held = hits.select(*keys, "n", "words").distinct().join(table, ["n", "words"]).select(*keys, "item").distinct()
    listed = held.groupBy(*keys).agg(F.array_sort(F.collect_list("item")).alias("items"))
    found = words_hit.join(listed, list(keys))
    found = found.select(*keys, "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("sha"))
    found = save(found, f"{path}/found")
    rows = docs.select(
        F.col(quoted(id_col)).alias("_id"),
        *[c.alias(k) for k, c in keys.items()],
        F.size(words_of(body)).cast("long").alias("n_words"),
    )
    out = rows.join(found, list(keys), "left")
    nothing = F.sha2(F.lit(""), 256)
    return out.select(
        F.col("_id").alias(id_col),
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("sha", nothing).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )
