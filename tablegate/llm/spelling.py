"""Spelling variants: words one edit apart, found by pivotal grams.

1. Words are counted over all texts (one shuffle, summed in tasks first).
2. Every word gets the ranks of its bigrams, rare ones first. Its prefix are
   the three of least rank and all that tie with the third; its pivots are two
   disjoint bigrams of those three whose counts add up to the least, chosen by
   dynamic programming over their places. One edit leaves a pivot whole, and of
   two words one edit apart the pivot left whole in the word whose prefix ends
   at the rarer bigram is in the other's prefix, so pivots are looked up in
   prefixes only.
3. Position limits: a pivot left whole stands at the same place if the edit is
   right of it, and at the same distance from the end if the edit is left of
   it. What lies on its other side is then equal, and of the side with the edit,
   cut in two halves, one half is equal. Place, length, and these equal parts
   are the key of the look-up, so the groups joined are small and no word is
   compared with all words that share a bigram.
4. Candidates are verified by edit distance. Every pair is kept once, then
   counted from both ends; a word's form is its near word of largest count, if
   large enough, and roots follow forms by doubling: counts grow tenfold along
   a chain, so no chain is longer than the digits of a count.

Bigram counts (at most the square of the alphabet) come to the tasks by an
ordinary join whose small side Spark measures. Python makes the keys of a word,
in Arrow batches; all else is DataFrame functions.

Defined results: a null or empty text has no words; an id that is null is the
text ``null`` where runs are hashed; repeated rows count as rows; ties of forms
go to the word that is least in code-point order; an empty table gives an empty
result. Columns other than id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegate.llm.base import computed, quoted, save, workspace

RUN = r"[A-Za-zÀ-ÿ]+"
LEAST_LENGTH = 7
LEAST_COUNT = 2
DROP_EVERY = 31
RATIO = 10
GRAM = 2
# Chains of forms grow by RATIO each step, so a 64-bit count ends them within 2**5 steps.
DOUBLINGS = 5
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(docs: DataFrame, id_col: str, text: str, path: str) -> DataFrame:
    """(word, n) of all words long and frequent enough."""
    rows = docs.select(
        F.coalesce(F.col(quoted(id_col)).cast("string"), F.lit("null")).alias("id"),
        F.translate(F.coalesce(F.col(quoted(text)), F.lit("")), _CAPITALS, _SMALL).alias("text"),
    )
    runs = F.filter(F.regexp_extract_all("text", F.lit(RUN), F.lit(0)), lambda r: F.length(r) >= LEAST_LENGTH)
    rows = computed(rows, "runs", runs).select("id", F.explode("runs").alias("run"))
    code = F.crc32(F.concat_ws(":", "id", "run"))
    place = F.pmod(code, F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), place), F.substring(F.col("run"), place + 2, F.length("run")))
    rows = rows.select(F.when(code % DROP_EVERY == 0, cut).otherwise(F.col("run")).alias("word"))
    counts = rows.where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return save(counts.where(F.col("n") >= LEAST_COUNT), f"{path}/words")


def pivots(places: list[int], weights: list[int], gram: int = GRAM) -> tuple[int, int]:
    """Two disjoint places of least summed weight, by dynamic programming over places in order."""
    best = None  # the least weight of one place so far that is disjoint from the present one, and the place
    chosen = None
    waiting = 0
    order = sorted(zip(places, weights, strict=True))
    for place, weight in order:
        while order[waiting][0] + gram <= place:
            earlier, cost = order[waiting]
            if best is None or cost < best[0]:
                best = (cost, earlier)
            waiting += 1
        if best is not None and (chosen is None or best[0] + weight < chosen[0]):
            chosen = (best[0] + weight, best[1], place)
    return chosen[1], chosen[2]


def index_keys(word: str, places: list[int]) -> Iterator[str]:
    """Keys of a word's prefix bigrams: bigram with one whole side, and either half of the other side."""
    n = len(word)
    for p in places:
        right, left = n - p - GRAM, p
        c = right // 2
        yield f"a|{p}|{right}|{word[: p + GRAM]}|f|{word[p + GRAM : p + GRAM + c]}"
        yield f"a|{p}|{right}|{word[: p + GRAM]}|l|{word[p + GRAM + c :]}"
        c = left // 2
        yield f"b|{p}|{right}|{word[p:]}|f|{word[:c]}"
        yield f"b|{p}|{right}|{word[p:]}|l|{word[c:p]}"


def query_keys(word: str, places: tuple[int, int]) -> Iterator[str]:
    """Keys under which a word one edit away has a bigram that stands at one of the places here."""
    n = len(word)
    for p in places:
        right, left = n - p - GRAM, p
        tail, head = word[p + GRAM :], word[:p]
        for d in (-1, 0, 1):
            # The edit is right of the bigram: the other's right side has ``right + d`` characters.
            m = right + d
            if m >= 0:
                c = m // 2
                if c <= right:
                    yield f"a|{p}|{m}|{word[: p + GRAM]}|f|{tail[:c]}"
                if m - c <= right:
                    yield f"a|{p}|{m}|{word[: p + GRAM]}|l|{tail[right - (m - c) :]}"
            # The edit is left of it.
            m = left + d
            if m >= 0:
                c = m // 2
                if c <= left:
                    yield f"b|{m}|{right}|{word[p:]}|f|{head[:c]}"
                if m - c <= left:
                    yield f"b|{m}|{right}|{word[p:]}|l|{head[left - (m - c) :]}"


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, counts of its bigrams in order) to (key, word, asks)."""
    for batch in batches:
        words, of = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for low in range(0, len(words), 4096):
            key, word, asks = [], [], []
            for w, counts in zip(words[low : low + 4096], of[low : low + 4096], strict=True):
                # Rarest first, equally rare ones by the bigram itself: the same order for all words.
                order = sorted(range(len(counts)), key=lambda p: (counts[p], w[p : p + GRAM], p))
                last = order[GRAM]
                bound = (counts[last], w[last : last + GRAM])
                prefix = [p for p in order if (counts[p], w[p : p + GRAM]) <= bound]
                first = order[: GRAM + 1]
                for kind, made in ((False, index_keys(w, prefix)), (True, query_keys(w, pivots(first, [counts[p] for p in first])))):
                    for k in set(made):
                        key.append(xxhash.xxh64_intdigest(k) - (1 << 63))
                        word.append(w)
                        asks.append(kind)
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(word, pa.string()), pa.array(asks, pa.bool_())], ["key", "word", "asks"])


def near_pairs(words: DataFrame, path: str) -> DataFrame:
    """(a, b), a < b, each once: all pairs of ``words(word)`` with exactly one inserted, deleted or replaced character."""
    grams = F.transform(F.sequence(F.lit(1), F.length("word") - (GRAM - 1)), lambda i: F.substring(F.col("word"), i, F.lit(GRAM)))
    each = words.select("word", F.posexplode(grams).alias("place", "gram"))
    counts = save(each.groupBy("gram").agg(F.count(F.lit(1)).alias("c")), f"{path}/grams")
    ranked = each.join(counts, "gram").groupBy("word").agg(F.array_sort(F.collect_list(F.struct("place", "c"))).alias("g"))
    made = ranked.select("word", F.col("g")["c"].alias("counts")).mapInArrow(_keys, "key long, word string, asks boolean")
    made = save(made, f"{path}/keys")
    asked = made.where("asks").select("key", F.col("word").alias("a"))
    held = made.where("NOT asks").select("key", F.col("word").alias("b"))
    found = asked.join(held, "key").where((F.col("a") != F.col("b")) & (F.levenshtein("a", "b", 1) == 1))
    return save(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{path}/pairs")


def roots(forms: DataFrame, path: str) -> DataFrame:
    """(word, root) for every word that has a form, from ``forms(word, form)``."""
    now = save(forms.select("word", F.col("form").alias("root")), f"{path}/roots-0")
    for k in range(1, DOUBLINGS + 1):
        far = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = save(now.join(far, "root", "left").select("word", F.coalesce("further", "root").alias("root")), f"{path}/roots-{k}")
    return now


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text: str = "text", ratio: int = RATIO) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    path = workspace(docs.sparkSession, "spelling")
    words = word_counts(docs, id_col, text, path)
    pairs = near_pairs(words.select("word"), path)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near")).union(pairs.select("b", "a"))
    sized = both.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = sized.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    best = best.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))
    large = F.col("near_n") >= F.col("n") * ratio
    rows = words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(large, F.col("near")).alias("form"),
        F.when(large, F.col("near_n")).alias("form_n"),
    )
    rows = save(rows, f"{path}/forms")
    named = roots(rows.where("form IS NOT NULL").select("word", "form"), path)
    return rows.join(named, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
