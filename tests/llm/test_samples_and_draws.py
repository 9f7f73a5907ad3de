"""Bounded samples, classifiers' features and gradients, draws and kept names against plain code."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tablegate.llm import features, mixing, quality_model, simhash, toxicity


def texts_of(sample):
    return sorted(r.text for r in sample.collect())


def test_an_id_of_many_rows_takes_one_place(spark, scratch):
    rows = [(1, f"copy {k}") for k in range(400)] + [(k, f"text {k}") for k in range(2, 202)] + [(None, "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)] * 400 + [(k, k % 2) for k in range(2, 400)] + [(None, 1)], "id long, label int")
    for seed in range(4):
        for given in (None, labels):
            path = f"{scratch}/{seed}-{given is None}"
            got = features.sampled(docs, given, "doc_id", "text", 100, path, seed).collect()
            assert len(got) == 100 and len({r.text for r in got}) == 100
            assert sum(r.text.startswith("copy") for r in got) <= 1 and all(r.text != "none" for r in got)
            if given is not None:
                assert all(r.label == (1 if r.text.startswith("copy") else int(r.text.split()[1]) % 2) for r in got)


def test_the_sample_is_the_least_hashes(spark, scratch):
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(300)], "doc_id long, text string")
    got = texts_of(features.sampled(docs, None, "doc_id", "text", 40, scratch + "/s", 5))
    order = docs.select("doc_id", F.xxhash64("doc_id", F.lit(5)).alias("h")).collect()
    assert got == sorted(f"text {r.doc_id}" for r in sorted(order, key=lambda r: (r.h, r.doc_id))[:40])


# --- features ----------------------------------------------------------------------------


def plain_features(text):
    """The words and prefixes of a text, as bytes with the length that a prefix is cut to."""
    found = set()
    for word in re.findall(rb"[A-Za-z\x80-\xff]+", text.encode()):
        low = bytes(b + 32 if 65 <= b <= 90 else b for b in word)
        found.add((0, low))
        found.update((k, low[:k]) for k in (4, 5, 6) if len(low) > k)
    return found


def counted(texts):
    data = np.frombuffer("".join(t + "\n" for t in texts).encode(), dtype=np.uint8)
    offsets = np.cumsum([0] + [len((t + "\n").encode()) for t in texts])
    return features.features(data, offsets)


def test_features_are_words_and_their_prefixes():
    texts = ["Über die BRÜCKE gehen", "", "gehend gehende, gehen!", "a b a", "Überaus über"]
    of, found = counted(texts)
    got = [set(found[of == k].tolist()) for k in range(len(texts))]
    plain = [plain_features(t) for t in texts]
    assert [len(g) for g in got] == [len(p) for p in plain]
    for i in range(len(texts)):
        for j in range(len(texts)):
            assert len(got[i] & got[j]) == len(plain[i] & plain[j])


def test_counts_and_matrix_equal_plain_ones(spark):
    texts = ["alpha beta", "beta gamma beta", "gamma", "", "alpha alphabet"]
    labels = [0, 1, 1, 0, 1]
    rows = spark.createDataFrame(list(zip(labels, texts, strict=True)), "label int, text string")
    plain = [plain_features(t) for t in texts]
    names = sorted(set().union(*plain))
    hash_of = {}
    for name in names:  # a word alone has its own hash and those of its prefixes
        of, found = counted([name[1].decode()])
        mine = set(found.tolist()) if name[0] == 0 else set()
        hash_of[name] = mine
    counts = {r.feature % (1 << 64): (r.n0, r.n1) for r in features.document_counts(rows, 2).collect()}
    for name in (n for n in names if n[0] == 0):
        word = next(h for h in hash_of[name] if all(h not in hash_of[m] for m in names if m[0] == 0 and m != name))
        want = tuple(sum(name in p for p, y in zip(plain, labels, strict=True) if y == k) for k in (0, 1))
        assert counts[word] == want
    chosen = np.sort(np.array(sorted(counts), dtype=np.uint64))
    y, x = features.matrix(rows, chosen)
    assert sorted(y.tolist()) == sorted(labels) and x.sum() == sum(a + b for a, b in counts.values())
    for k, h in enumerate(chosen.tolist()):
        assert (x[y == 0, k].sum(), x[y == 1, k].sum()) == counts[h]


# --- gradients ---------------------------------------------------------------------------


def test_first_step_follows_the_risk():
    """A first step of Adam goes against the sign of the risk's gradient, taken here by differences."""
    rng = np.random.default_rng(0)
    p, u, prior = (rng.random((40, 5)) < [0.9, 0.1, 0.5, 0.5, 0.2]).astype(float), (rng.random((90, 5)) < [0.2, 0.6, 0.5, 0.4, 0.7]).astype(float), 0.3
    start = np.append(np.zeros(5), math.log(prior / (1 - prior)))

    def risk(theta):
        sp, su = p @ theta[:-1] + theta[-1], u @ theta[:-1] + theta[-1]
        rest = np.logaddexp(0, su).mean() - prior * np.logaddexp(0, sp).mean()
        assert rest > 0
        return prior * np.logaddexp(0, -sp).mean() + rest

    slope = np.array([(risk(start + h) - risk(start - h)) / 2e-6 for h in np.eye(6) * 1e-6])
    weights, intercept = toxicity.fit_nnpu(p, u, prior, steps=1)
    moved = np.append(weights, intercept) - start
    clear = np.abs(slope) > 1e-6
    assert clear.sum() >= 5 and (np.sign(moved[clear]) == -np.sign(slope[clear])).all()


# --- mixing ------------------------------------------------------------------------------


@pytest.mark.parametrize("quality", [1e-9, 0.05, 1.0])
def test_the_draw_takes_the_least_keys(spark, quality):
    rows = [(k, "w " * (1 + k % 7), "a") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = mixing.mix(docs, weights=(1,), volume=0.4, quality=F.lit(quality)).collect()
    taken = {r.doc_id for r in got if r.times}
    target = got[0].target
    body = docs.select("doc_id", F.xxhash64(F.lit(mixing.SEED), "doc_id", "text").alias("h")).collect()
    keys = {r.doc_id: -math.log(((r.h % (1 << 64)) // 2048 + 1) / float(1 << 53)) / max(quality, mixing.LEAST_QUALITY) for r in body}
    order = sorted(keys, key=keys.get)
    n = len(taken)
    assert taken == set(order[:n])
    sizes = {r.doc_id: r.size for r in got}
    assert abs(sum(sizes[d] for d in taken) - target) <= max(sizes.values())


def test_names_of_the_input_keep_their_values(spark):
    docs = spark.createDataFrame([(k, f"word{k} other{k} third{k} " * 3, "s", 100 + k) for k in range(20)], "doc_id long, text string, source string, x long")
    for name in ("__tg_place", "__tg_times", "__tg_row", "__tg_fp", "place", "times", "c0", "quality"):
        odd = docs.withColumnRenamed("x", name)
        for out in (mixing.mixed_documents(odd, quality=F.lit(0.5)), simhash.keep_one(odd)):
            assert out.columns == odd.columns
            assert all(r[name] == 100 + r.doc_id for r in out.collect())
