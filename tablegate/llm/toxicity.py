"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; all other text, whatever it is,
is unlabelled. With class prior p and logistic loss l the risk is
``p E_P[l(s)] + max(0, E_U[l(-s)] - p E_P[l(-s)])``: the unlabelled risk less
what its toxic part adds to it, never let below zero (where it is, a step goes
the other way). The prior is the toxic share of all labels that may be used.

Fitting: bounded samples (``POSITIVES``, ``UNLABELLED`` documents, those of
least hash) give document counts of hashed features in Spark; the features
whose shares differ most between the samples are kept; the 0/1 matrix of those
comes to the driver, where numpy fits the weights. Scoring reads every whole
text once, in numpy inside tasks, with the weights broadcast (``FEATURES``
numbers at most). No shuffle of texts.

Defined results: null and empty texts have no feature and get the score of
the intercept; labels that are null or of unknown ids are not used; an id
labelled twice is toxic if one label says so, and of the rows of one id one text
is learned from; repeated rows get equal scores; a column of the input that is
named as the score is replaced;
without positives or without unlabelled text every score is the prior (0
without labels); an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegate.llm.base import quoted, remainder, workspace
from tablegate.llm.features import contrast, document_counts, matrix, sampled, scored

POSITIVES = 3_000
UNLABELLED = 9_000
FEATURES = 512
LEAST_CONTRAST = 5.0
STEPS = 400
RATE = 0.05
DECAY = 1e-4
SEED = 9


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and intercept of least non-negative risk, by Adam over all rows."""
    n_features = positive.shape[1]
    theta = np.zeros(n_features + 1)
    theta[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(theta), np.zeros_like(theta)

    def mean_gradient(rows: np.ndarray, slope: np.ndarray) -> np.ndarray:
        return np.append(slope @ rows, slope.sum()) / len(rows)

    for t in range(1, steps + 1):
        sp = positive @ theta[:-1] + theta[-1]
        su = unlabelled @ theta[:-1] + theta[-1]
        rest = np.logaddexp(0, su).mean() - prior * np.logaddexp(0, sp).mean()
        of_rest = mean_gradient(unlabelled, _sigmoid(su)) - prior * mean_gradient(positive, _sigmoid(sp))
        if rest < 0:
            gradient = -of_rest
        else:
            gradient = of_rest - prior * mean_gradient(positive, _sigmoid(-sp))
        gradient[:-1] += DECAY * theta[:-1]
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        theta -= RATE * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return theta[:-1], float(theta[-1])


@dataclass(frozen=True)
class ToxicityModel:
    chosen: np.ndarray
    weights: np.ndarray
    intercept: float

    def score(self, docs: DataFrame, text: str = "text", name: str = "score") -> DataFrame:
        """``docs`` with the probability ``name`` of being toxic."""
        intercept = self.intercept
        return scored(docs, text, self.chosen, self.weights, [name], lambda s: _sigmoid(s + intercept)[:, None])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    positives: int = POSITIVES,
    unlabelled: int = UNLABELLED,
    features: int = FEATURES,
) -> ToxicityModel:
    """A model from the positive labels and from texts; pass only rows that may be learned from."""
    path = workspace(docs.sparkSession, "toxicity")
    known = labels.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(label)).cast("int").alias("label"))
    known = known.where(F.col("id").isNotNull() & F.col("label").isNotNull()).groupBy("id").agg(F.max("label").alias("label"))
    share = known.agg(F.avg(F.when(F.col("label") == 1, 1.0).otherwise(0.0))).first()[0]
    prior = float(share or 0.0)
    p = sampled(docs, known.where(F.col("label") == 1), id_col, text, positives, f"{path}/positive", SEED)
    u = sampled(docs, None, id_col, text, unlabelled, f"{path}/unlabelled", SEED + 1)
    n_p, n_u = p.count(), u.count()
    nothing = np.zeros(0, np.uint64)
    if not n_p or not n_u or not 0 < prior < 1:
        odds = np.log(prior / (1 - prior)) if 0 < prior < 1 else (40.0 if prior == 1 else -40.0)
        return ToxicityModel(nothing, np.zeros(0), float(odds))
    both = p.select(F.lit(1).alias("label"), "text").unionByName(u.select(F.lit(0).alias("label"), "text"))
    counts = document_counts(both, 2)
    z = contrast(F.col("n1"), n_p, F.col("n0"), n_u)
    best = counts.withColumn("z", z).where(F.col("z") >= LEAST_CONTRAST).orderBy(F.desc("z"), "feature").limit(features)
    chosen = np.sort(np.array([r[0] for r in best.select("feature").collect()], dtype=np.int64).view(np.uint64))
    y, x = matrix(both, chosen)
    weights, intercept = fit_nnpu(x[y == 1], x[y == 0], prior)
    return ToxicityModel(chosen, weights, intercept)


def score_documents(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted; learned from the rows outside the held-out fold."""
    learn = remainder("doc_id", folds) != held_out
    model = fit(docs.where(learn), labels.where(learn))
    out = model.score(docs.select("doc_id", "text"))
    return out.select("doc_id", (~learn).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
