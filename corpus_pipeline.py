"""Corpus pipeline: documents to packed token sequences.

``STAGES`` in order: quality classifier, line dedup, SimHash near-dedup, mixing
to source weights, packing. Each stage gets what the one before kept, written
as Parquet in the shared folder and read again, so a lost executor costs a
stage's tasks, not the run. All but the last return the columns of documents;
after mixing a document stands as often as the mix takes it.

Defined results: texts that are null or empty go through as their stages say
(no lines, the zero fingerprint, no words, the end token alone); rows without an
id are documents like others; columns that no stage works on keep their values,
whatever their names; empty documents give an empty result, and with no labels
the classifier keeps every document.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegate.llm import line_dedup, mixing, packing, quality_model, simhash
from tablegate.llm.base import quoted, save, workspace


def _same_columns(out: DataFrame, docs: DataFrame) -> DataFrame:
    return out.select(*[F.col(quoted(c)) for c in docs.columns])


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of a grade above 0 is at least a half."""
    model = quality_model.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _same_columns(model.score(docs).where(quality_model.kept()), docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that many pages of their source share; n_chars follows."""
    out = _same_columns(line_dedup.remove_boilerplate(docs, "source"), docs)
    return out.withColumn("n_chars", F.length("text").cast("long"))


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of least id, of each class of near duplicates."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", classify_quality),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_documents),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Fitted models, fingerprints and token ids are beyond SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the table ``documents``."""
    path = workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = save(stage(spark, docs, sf_dir), f"{path}/{k}")
    return docs
