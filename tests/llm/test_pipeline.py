"""The corpus pipeline, stage by stage, against plain Python over what each stage got."""

from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tablegate.llm.base import save, workspace
from tests.conftest import SF_MID
from tests.llm.test_operators import ODD, ODD_ROWS, plain_budgets, plain_classes, plain_fingerprint, words


@pytest.fixture(scope="module")
def steps(spark):
    """What run() does, with every stage's rows kept for comparison."""
    path = workspace(spark, "pipeline-test")
    out = [spark.read.parquet(f"{SF_MID}/documents.parquet")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out.append(save(stage(spark, out[-1], SF_MID), f"{path}/{k}"))
    return out


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_columns_stay(steps):
    assert all(s.dtypes == steps[0].dtypes for s in steps[1:5])


def test_quality_rejects_junk_and_keeps_clean(spark, steps):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    kept = {r.doc_id for r in steps[1].collect()}
    judged = [(q, i in kept) for i, q in labels.items()]
    assert Counter(rows(steps[1])) <= Counter(rows(steps[0]))
    assert sum(q == 1 and k for q, k in judged) > 0.98 * sum(q == 1 for q, _ in judged)
    assert sum(q == 0 and not k for q, k in judged) > 0.9 * sum(q == 0 for q, _ in judged)


def test_lines(steps):
    got = {r.doc_id: (r.text, r.n_chars) for r in steps[2].collect()}
    docs = steps[1].collect()
    pages, seen = Counter(r.source for r in docs), Counter()
    for r in docs:
        seen.update({(r.source, x) for x in (y.strip("\t\x0b\x0c\r ") for y in r.text.split("\n")) if x})
    bad = {k for k, n in seen.items() if n >= 5 and n > 0.08 * pages[k[0]]}
    assert bad
    for r in docs:
        lines = [(y, y.strip("\t\x0b\x0c\r ")) for y in r.text.split("\n")]
        left = [y for y, x in lines if not x or (r.source, x) not in bad]
        text = "\n".join(left) if any(x and (r.source, x) not in bad for _, x in lines) else r.text
        assert got[r.doc_id] == (text, len(text))


def test_one_of_each_class(steps):
    docs = sorted(steps[2].collect(), key=lambda r: r.doc_id)
    classes = plain_classes([plain_fingerprint(r.text) for r in docs], 2)
    assert sorted(r.doc_id for r in steps[3].collect()) == sorted({docs[c].doc_id for c in classes})


def test_mix(steps):
    docs = steps[3].collect()
    sizes, taken, largest = Counter(), Counter(), Counter()
    times = Counter(r.doc_id for r in steps[4].collect())
    for r in docs:
        n = sum(1 for w in words(r.text) if w)
        sizes[r.source] += n
        taken[r.source] += n * times[r.doc_id]
        largest[r.source] = max(largest[r.source], n)
    want = plain_budgets(sizes)
    assert max(times.values()) <= 2 and all(abs(taken[s] - want[s]) <= largest[s] for s in want)


def test_packing_holds_the_mix(steps):
    times = Counter(r.doc_id for r in steps[4].collect())
    tokens, ends = defaultdict(int), Counter()
    for r in steps[5].collect():
        tokens[r.doc_id, r.doc_tokens] += r.length
        ends[r.doc_id] += r.start + r.length == r.doc_tokens
    assert ends == times and all(n == times[i] * size for (i, size), n in tokens.items())


def test_run_gives_the_last_stage(spark, steps):
    run = corpus_pipeline.run(spark, SF_MID)
    assert run.columns == steps[5].columns
    same = ["doc_id", "doc_tokens"]
    total = F.sum("length").alias("n")
    assert Counter(rows(run.groupBy(*same).agg(total))) == Counter(rows(steps[5].groupBy(*same).agg(total)))


def odd_folder(spark, scratch, docs, labels):
    docs.write.parquet(f"{scratch}/documents.parquet")
    labels.write.parquet(f"{scratch}/labels.parquet")
    return scratch


def test_odd_tables_run_through(spark, scratch):
    schema = f"{ODD}, n_chars long, __tg_row long, __tg_place long"
    rows_ = [(*r, *["x"] * 6, k, k + 100, k + 200) for k, r in enumerate(ODD_ROWS)]
    rows_ += [(50, "long words " * 60_000, "en", "s", *["x"] * 6, 0, 1, 101)]
    labels = spark.createDataFrame([(5, 1, 0), (6, 0, 1), (None, 0, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    folder = odd_folder(spark, scratch, spark.createDataFrame(rows_, schema), labels)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = save(stage(spark, docs, folder), f"{folder}/{k}")
        if k < 4:
            assert out.columns == docs.columns
            docs = out
            # The columns that are only carried along keep their values.
            assert all(r["__tg_place"] == r["__tg_row"] + 100 for r in docs.collect())
    pieces = out.collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in docs.collect()} and 50 in {r.doc_id for r in pieces}


def test_empty_tables_run_through(spark, scratch):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").limit(0)
    folder = odd_folder(spark, scratch, docs, spark.read.parquet(f"{SF_MID}/labels.parquet").limit(0))
    assert corpus_pipeline.run(spark, folder).collect() == []
