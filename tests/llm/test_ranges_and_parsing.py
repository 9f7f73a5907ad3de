"""Fingerprints: ranges of ids of any type, and the parsing and likeness held against plain versions."""

import hashlib
import itertools

import numpy as np
import pytest

from tablegate.llm import fingerprint

MASK = (1 << 64) - 1


def plain_mix(x):
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & MASK
    return x ^ (x >> 31)


def plain_parse(row):
    symbols = [plain_mix((s + len(list(run)) * 0xD6E8FEB86659FD93) & MASK) for s, run in itertools.groupby(row)]
    labels = symbols
    for _ in range(4):
        tossed = []
        for i, x in enumerate(labels):
            place = 0
            while i and (x ^ labels[i - 1]) >> place & 1 == 0:
                place += 1
            tossed.append(2 * place + (x >> place & 1))
        labels = tossed
    cuts = [0] + [i for i in range(2, len(labels) - 1) if labels[i - 1] < labels[i] > labels[i + 1]] + [len(labels)]
    names = []
    for low, high in zip(cuts, cuts[1:], strict=False):
        total = sum(s * pow(0x9E3779B97F4A7C55, min(k, 63), 1 << 64) for k, s in enumerate(symbols[low:high]))
        names.append(plain_mix((total + high - low) & MASK))
    return names


def plain_sketch(text):
    """Two dictionaries, bin to value: of the inner phrases of the upper levels, and of all phrases below."""
    row = [ord(c) + 1 for c in text]
    high, low = [], []
    if len(set(row)) == 1:
        low.append(plain_mix(row[0]))
    plain = len(set(row)) < 2
    for level in range(1, 6):
        row = plain_parse(row) if row else row
        if level in (3, 4, 5):
            high += [plain_mix((s + level) & MASK) for s in row[1:-1]]
        elif not plain:
            low += [plain_mix((s + level) & MASK) for s in row]
    out = []
    for names in (high, low):
        bins = {}
        for name in names:
            spread = plain_mix((name + 0x632BE59BD9B4E019) & MASK)
            bins[spread % 64] = min(bins.get(spread % 64, MASK), min(spread >> 48, 0xFFFE) + 1)
        out.append(bins)
    return out


def plain_likeness(one, two):
    high = min(1.0, min(len(one[0]), len(two[0])) / 16)
    same = used = 0.0
    for a, b, weight in zip(one, two, (high, 1 - high), strict=True):
        used += weight * len(a.keys() | b.keys())
        same += weight * sum(b.get(k) == v for k, v in a.items())
    return same / used if used else 1.0


def some_texts():
    rng = np.random.default_rng(31)
    vocabulary = ["".join(rng.choice(list("abcdefghé日"), k)) for k in rng.integers(1, 9, 200)]
    texts = [" ".join(rng.choice(vocabulary, n)) for n in (1, 2, 3, 8, 30, 60, 120, 300)]
    return [*texts, "", "a", "ab", "aaaa", "abc" * 60, texts[-1] + " more", texts[-2][50:] + texts[-1], "\U0001f600" * 3 + "x"]


def test_sketches_and_likeness_are_the_plain_ones():
    texts = some_texts()
    sketches, plain = fingerprint.sketches(texts), [plain_sketch(t) for t in texts]
    for row, (high, low) in zip(sketches.tolist(), plain, strict=True):
        assert {k: v for k, v in enumerate(row[:64]) if v} == high
        assert {k: v for k, v in enumerate(row[64:]) if v} == low
    for i, j in itertools.product(range(len(texts)), repeat=2):
        got = fingerprint.likeness(sketches[i : i + 1], sketches[j : j + 1])[0]
        assert got == pytest.approx(plain_likeness(plain[i], plain[j]), abs=1e-12)


def edited_rows(ids, texts):
    """What the rows must be: ids in order, nulls first, one id's rows by their text."""
    rows = sorted(zip(ids, texts, strict=True), key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0, (r[1] or "").encode()))
    out = []
    for k, (i, text) in enumerate(rows):
        text, following = text or "", rows[(k + 1) % len(rows)][1] or ""
        m = len(text) // 2
        changed = text[: len(text) - m] + following[:m]
        likes = [plain_likeness(plain_sketch(text), plain_sketch(t)) for t in (changed, following)]
        out.append((str(i), len(text), hashlib.sha256(changed.encode()).hexdigest(), *[round(x, 9) for x in likes]))
    return sorted(out)


IDS = {
    "long": [None, None, -5, *[7] * 12, 8, 9, 9, 2**62],
    "string": [None, None, "", *["hot"] * 12, "hou", "id, 9", "id, 9", "é"],
    "double": [None, None, -1.5, *[0.0] * 12, 0.5, 2.0, 2.0, float("inf")],
    "date": None,
}


@pytest.mark.parametrize("kind", sorted(IDS))
def test_next_documents_of_ids_of_any_type(spark, kind):
    import datetime

    ids = IDS[kind] or [None if i is None else datetime.date(2000, 1, 1) + datetime.timedelta(i % 400) for i in IDS["long"]]
    base = [t for t in some_texts() if len(t) < 400]
    texts = [base[k % len(base)] if k % 5 else None for k in range(len(ids) - 2)] + ["twin text", "twin text"]
    df = spark.createDataFrame(list(zip(ids, texts, strict=True)), f"doc_id {kind}, text string").repartition(3)
    if kind == "date":
        order = [None if i is None else i.toordinal() for i in ids]
        want = edited_rows(order, texts)
        want = sorted((i if i == "None" else str(datetime.date.fromordinal(int(i))), *r) for i, *r in want)
    else:
        want = edited_rows(ids, texts)
    for ranges in (1, 2, 6, 40):
        got = fingerprint.edited_fingerprints(df, ranges=ranges).collect()
        got = sorted((str(r.doc_id), r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got)
        assert got == want


def test_an_id_of_many_rows_is_divided(spark):
    from pyspark.sql import functions as F

    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    out = fingerprint.edited_fingerprints(df, ranges=12).select("doc_id", F.spark_partition_id().alias("p"))
    hot = {r.p: r.n for r in out.where("doc_id = 5").groupBy("p").agg(F.count("*").alias("n")).collect()}
    assert sum(hot.values()) == 1001 and len(hot) >= 3 and max(hot.values()) < 600
