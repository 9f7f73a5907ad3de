"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades 0, 1, .., K share one weight for every hashed text feature; ordered
thresholds part them: ``P(grade > k) = sigmoid(w.x - t_k)``, t rising. A text
gets its expected grade ``sum_k P(grade > k)`` and the tail probability
``P(grade >= keep_grade)``, by which documents are selected.

Fitting: a bounded sample of rated documents (``RATED``, those of least hash)
gives document counts of features in Spark; the features whose shares differ
most across some threshold are kept; their 0/1 matrix comes to the driver,
where numpy fits weights and thresholds by maximum likelihood. Scoring reads
every whole text once, in numpy inside tasks, weights broadcast (at most
``FEATURES``). No shuffle of texts.

Grades of the table ``labels``: 0 if quality is 0, else 1 if toxic, else 2.

Defined results: null and empty texts have no feature and get the thresholds'
own probabilities; ratings that are null, or of unknown ids, are not used; an
id rated twice has its higher grade; repeated rows get equal scores; without
ratings, or with ratings of one grade alone, every document is kept, with that
grade (the highest without any) and tail probability 1 or 0 accordingly; an
empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegate.llm.base import quoted, remainder, save, workspace
from tablegate.llm.features import contrast, document_counts, matrix, sampled, scored

RATED = 12_000
FEATURES = 512
LEAST_CONTRAST = 6.0
STEPS = 800
RATE = 0.05
DECAY = 1e-4
KEEP_GRADE = 1
KEEP_PROBABILITY = 0.5
GRADES = 3
SEED = 8
_FAR = 40.0


def label_grade() -> Column:
    """The grade of a row of ``labels``; null if its quality is."""
    return F.when(F.col("quality") == 0, 0).when(F.col("quality") == 1, F.when(F.col("toxic") == 1, 1).otherwise(2))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -_FAR, _FAR)))


def fit_ordinal(x: np.ndarray, y: np.ndarray, grades: int, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and rising thresholds of greatest penalized likelihood, by Adam over all rows."""
    w = np.zeros(x.shape[1])
    # Thresholds by their first one and the logarithms of the gaps, so that they stay in order.
    above = np.array([(y > k).mean() for k in range(grades - 1)]).clip(1e-3, 1 - 1e-3)
    start = -np.log(above / (1 - above))
    free = np.concatenate((start[:1], np.log(np.maximum(np.diff(start), 0.1))))
    theta = np.concatenate((w, free))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    rows = np.arange(len(y))
    for t in range(1, steps + 1):
        gaps = np.exp(theta[len(w) + 1 :])
        cut = theta[len(w)] + np.concatenate(([0.0], np.cumsum(gaps)))
        s = x @ theta[: len(w)]
        over = np.column_stack((np.ones(len(y)), _sigmoid(s[:, None] - cut), np.zeros(len(y))))  # P(grade >= k)
        p = np.maximum(over[rows, y] - over[rows, y + 1], 1e-12)
        slope = over * (1 - over)
        slope[:, 0] = slope[:, -1] = 0
        up, down = slope[rows, y] / p, slope[rows, y + 1] / p
        gradient = np.zeros_like(theta)
        gradient[: len(w)] = -((up - down) @ x) / len(y) + DECAY * theta[: len(w)]
        of_cut = np.array([(up[y == k + 1].sum() - down[y == k].sum()) / len(y) for k in range(grades - 1)])
        gradient[len(w)] = of_cut.sum()
        gradient[len(w) + 1 :] = np.cumsum(of_cut[::-1])[::-1][1:] * gaps
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        theta = theta - RATE * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    gaps = np.exp(theta[len(w) + 1 :])
    return theta[: len(w)], theta[len(w)] + np.concatenate(([0.0], np.cumsum(gaps)))


@dataclass(frozen=True)
class QualityModel:
    chosen: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def score(self, docs: DataFrame, text: str = "text", keep_grade: int = KEEP_GRADE) -> DataFrame:
        """``docs`` with ``expected_grade`` and ``tail_probability``."""
        cut = self.thresholds

        def link(s: np.ndarray) -> np.ndarray:
            over = _sigmoid(s[:, None] - cut)
            return np.column_stack((over.sum(axis=1), over[:, keep_grade - 1]))

        return scored(docs, text, self.chosen, self.weights, ["expected_grade", "tail_probability"], link)


def fit(
    docs: DataFrame,
    ratings: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    grade: Column | None = None,
    grades: int = GRADES,
    rated: int = RATED,
    features: int = FEATURES,
) -> QualityModel:
    """A model from rated documents; ``grade`` is a Column of ``ratings`` (that of ``labels`` by default)."""
    path = workspace(docs.sparkSession, "quality")
    of = (grade if grade is not None else label_grade()).cast("int").alias("label")
    known = ratings.select(F.col(quoted(id_col)).alias("id"), of).where(F.col("id").isNotNull() & F.col("label").isNotNull())
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    rows = sampled(docs, known, id_col, text, rated, f"{path}/rated", SEED)
    sizes = {r[0]: r[1] for r in rows.groupBy("label").count().collect()}
    if len(sizes) < 2:
        only = next(iter(sizes), grades - 1)
        cuts = np.array([-_FAR if k < only else _FAR for k in range(grades - 1)])
        return QualityModel(np.zeros(0, np.uint64), np.zeros(0), cuts)
    counts = save(document_counts(rows, grades), f"{path}/counts")  # read once for each threshold
    apart = []
    for k in range(grades - 1):
        low, high = range(k + 1), range(k + 1, grades)
        n_low, n_high = (sum(sizes.get(g, 0) for g in side) for side in (low, high))
        if n_low and n_high:
            apart.append(contrast(sum(F.col(f"n{g}") for g in high), n_high, sum(F.col(f"n{g}") for g in low), n_low))
    chosen: set[int] = set()
    for z in apart:
        best = counts.withColumn("z", z).where(F.col("z") >= LEAST_CONTRAST).orderBy(F.desc("z"), "feature")
        chosen.update(r[0] for r in best.limit(features // len(apart)).select("feature").collect())
    codes = np.sort(np.array(sorted(chosen), dtype=np.int64).view(np.uint64))
    y, x = matrix(rows, codes)
    weights, cuts = fit_ordinal(x, y, grades)
    return QualityModel(codes, weights, cuts)


def kept() -> Column:
    """Whether a scored document is selected."""
    return F.col("tail_probability") >= KEEP_PROBABILITY


def grade_documents(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0) -> DataFrame:
    """doc_id, held_out, expected_grade, tail_probability, kept; learned from the rows outside the held-out fold."""
    learn = remainder("doc_id", folds) != held_out
    model = fit(docs.where(learn), labels.where(learn))
    out = model.score(docs.select("doc_id", "text"))
    return out.select("doc_id", (~learn).alias("held_out"), "expected_grade", "tail_probability", kept().alias("kept"))
