"""Embedding whitening: distributed exact covariance, eigenvectors refined from single precision.

1. Entries become integers ``floor(256 c)``. The fit list is each distinct
   vector once; its size n and sums S are integers.
2. Rows are centred by the nearest integer vector before they are multiplied.
   Tasks multiply blocks of rows small enough that every sum is an exact
   integer, Spark adds up the blocks' matrices by entry, and the remaining
   fraction of the mean is taken off exactly: the covariance V is each entry's
   nearest double, whatever the partitioning.
3. ``eigh`` of V in single precision starts the eigenvectors X. Ogita-Aishima
   steps correct them by matrix products in extended precision: with
   ``R = I - X'X`` and ``S = X'VX``, eigenvalues are ``s_ii / (1 - r_ii)`` and
   ``X += X E``, ``e_ij = (s_ij + l_j r_ij) / (l_j - l_i)``. Where two
   eigenvalues are closer than the present error, ``e_ij = r_ij / 2`` only makes
   the vectors orthogonal; each such cluster is then solved as a small problem
   of its own, shifted by its mean eigenvalue so that the differences show, its
   vectors are turned accordingly, and the steps go on.
4. Every row is projected in tasks, on a broadcast mean and the first
   components (a few vectors of the embedding's length).

The driver holds one matrix of dimensions by dimensions, whatever the number of
rows. Covariance of the whitened fit list is measured by one more pass.

Defined results: rows whose vector is null, empty or holds null or non-finite
entries have no result; so do vectors of another length than most (of equally
frequent lengths, the longest); repeated rows and ids stay rows of their own
and count once in the fit. Where a component has no variance left (beyond the
rank of the fit list) ``whitened`` is 0 and it takes no part in the identity
error; ``explained`` is 0 where nothing varies at all. A ``deviation`` beyond 64
bits is null. Entries beyond 64-bit integers stop at these. An empty table
gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegate.llm.base import quoted, save, workspace

COMPONENTS = 4
SCALE = 256
STEPS = 8
_BLOCK = 4096
_PART = 10**18
_EXACT = 1 << 53  # integers below this are exact doubles


def integer_vectors(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, x) of the rows whose vector is whole: x the entries' integers."""
    v = F.col(quoted(vector))
    whole = (F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    kept = rows.where(v.isNotNull() & F.coalesce(whole, F.lit(False)))
    least = F.lit(-(1 << 63) + 1)
    x = F.transform(v, lambda c: F.greatest(F.floor(c.cast("double") * SCALE).cast("long"), least))
    return kept.select(F.col(quoted(vec_id)).alias("vec_id"), x.alias("x"))


def _blocks(column: pa.Array, dims: int) -> Iterator[np.ndarray]:
    """The vectors of an Arrow list column as matrices of a bounded number of rows."""
    for low in range(0, len(column), _BLOCK):
        part = column.slice(low, _BLOCK)
        yield part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), dims)


def _products(shift: np.ndarray):
    """Tasks' sums of products of the shifted vectors, as rows (i, sums of column i with all columns)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dims = len(shift)
        total = np.zeros((dims, dims), dtype=object)
        for batch in batches:
            for x in _blocks(batch.column(0), dims):
                y = x - shift if np.abs(x).max(initial=0) < 1 << 62 else x.astype(object) - shift.astype(object)
                top = int(np.abs(y).max(initial=0))
                # Sums of so many products stay exact in doubles; larger entries are multiplied as integers.
                rows = (_EXACT - 1) // (top * top) if top else len(y)
                if rows < 1:
                    y = y.astype(object)
                    total = total + y.T @ y
                    continue
                for low in range(0, len(y), rows):
                    z = y[low : low + rows].astype(np.float64)
                    total = total + (z.T @ z).astype(np.int64).astype(object)
        # In two parts, as a sum may have more digits than a decimal.
        parts = [[[str(divmod(v, _PART)[k]) for v in row] for row in total] for k in (0, 1)]
        columns = [pa.array(range(dims), pa.int32()), *[pa.array(p, pa.list_(pa.string())) for p in parts]]
        yield pa.RecordBatch.from_arrays(columns, ["i", "high", "low"])

    return run


@dataclass(frozen=True)
class Whitening:
    """What the fit list says: its size and sums, covariance, components (rows) by falling eigenvalue, and the trace."""

    n: int
    sums: np.ndarray
    covariance: np.ndarray
    components: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def scales(self) -> np.ndarray:
        """1 / sqrt(eigenvalue); 0 for components without variance."""
        least = len(self.covariance) * np.finfo(np.float64).eps * max(self.trace, 0.0)
        return np.array([1 / np.sqrt(e) if e > least else 0.0 for e in self.values])


def _clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Places of the eigenvalues (rising) that lie closer than ``gap`` to their neighbour, two or more at a time."""
    parts = np.split(np.arange(len(values)), np.flatnonzero(np.diff(values) > gap) + 1)
    return [p for p in parts if len(p) > 1]


def _refined(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One Ogita-Aishima step for the symmetric ``a``: better vectors, eigenvalues, and the error they are told apart by."""
    r = np.eye(len(a), dtype=a.dtype) - x.T @ x
    s = x.T @ (a @ x)
    values = np.diag(s) / (1 - np.diag(r))
    spread = s - np.diag(values)
    error = 2 * float(np.linalg.norm(spread.astype(np.float64)) + np.abs(values).max() * np.linalg.norm(r.astype(np.float64)))
    apart = values[None, :] - values[:, None]
    near = np.abs(apart) <= error
    e = np.where(near, r / 2, (s + values[None, :] * r) / np.where(near, 1, apart))
    return x + x @ e, values, error


def eigenvectors(covariance: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors in columns) by rising eigenvalue of a symmetric matrix of doubles."""
    size = float(np.abs(covariance).max(initial=0.0))
    if not size or not len(covariance):
        return np.zeros(len(covariance)), np.eye(len(covariance))
    a = covariance.astype(np.longdouble) / size
    x = np.linalg.eigh((covariance / size).astype(np.float32))[1].astype(np.longdouble)
    eps = float(np.finfo(np.longdouble).eps) * len(a)
    for _ in range(steps):
        x, values, error = _refined(a, x)
        order = np.argsort(values, kind="stable")
        x, values = x[:, order], values[order]
        for places in _clusters(values, error):
            # What differs within a cluster shows once its mean is taken off.
            q = x[:, places]
            mean = values[places].mean()
            t = q.T @ (a @ q - mean * q)
            turn = np.linalg.eigh(((t + t.T) / 2).astype(np.float64))[1]
            x[:, places] = q @ turn.astype(np.longdouble)
        if error <= eps * max(1.0, float(np.abs(values).max())):
            break
    for _ in range(2):  # orthogonal to the last digit, whatever the gaps
        x = x + x @ ((np.eye(len(a), dtype=a.dtype) - x.T @ x) / 2)
    values = (x * (a @ x)).sum(axis=0) / (x * x).sum(axis=0)
    order = np.argsort(values, kind="stable")
    return (values[order] * size).astype(np.float64), x[:, order].astype(np.float64)


def fit(vectors: DataFrame, dims: int, count: int = COMPONENTS) -> Whitening:
    """The whitening of the distinct vectors ``vectors(x)``, all of ``dims`` entries."""
    each = vectors.select(F.posexplode("x").alias("i", "v")).groupBy("i")
    sums = each.agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("n")).collect()
    n = int(sums[0].n)
    total = np.zeros(dims, dtype=object)
    for r in sums:
        total[r.i] = int(r.s)
    shift = np.array([round(Fraction(s, n)) for s in total], dtype=np.int64)
    parts = vectors.select("x").mapInArrow(_products(shift), "i int, high array<string>, low array<string>")
    cells = parts.select("i", F.posexplode(F.arrays_zip("high", "low")).alias("j", "v")).where("j >= i").groupBy("i", "j")
    cells = cells.agg(*[F.sum(F.col("v")[k].cast("decimal(38,0)")).alias(k) for k in ("high", "low")])
    rest = [int(s) - n * int(c) for s, c in zip(total, shift, strict=True)]
    covariance = np.zeros((dims, dims))
    for r in cells.collect():
        products = int(r.high) * _PART + int(r.low)
        covariance[r.i, r.j] = covariance[r.j, r.i] = float(Fraction(n * products - rest[r.i] * rest[r.j], n * n))
    values, x = eigenvectors(covariance)
    kept = np.argsort(-values, kind="stable")[:count]
    components = x[:, kept].T
    # Either sign will do; the entry of largest size is made positive.
    signs = np.sign(components[np.arange(len(components)), np.abs(components).argmax(axis=1)])
    components = components * np.where(signs == 0, 1, signs)[:, None]
    return Whitening(n, total, covariance, components, values[kept], float(np.trace(covariance)))


def _whitened(model: Whitening, x: np.ndarray) -> tuple[np.ndarray, list[int | None]]:
    """Projections of integer vectors on the scaled components, and the exact sums of (n x - S)^2."""
    limit = max(int(np.abs(x).max(initial=0)) * model.n, max(map(abs, model.sums)))
    if limit < 1 << 61:
        z = x * model.n - model.sums.astype(np.int64)
    else:
        z = x.astype(object) * model.n - model.sums
    top = int(np.abs(z).max(initial=0))
    exact = z if top * top * z.shape[1] < 1 << 63 else z.astype(object)
    deviation = [d if d < 1 << 63 else None for d in (exact * exact).sum(axis=1).tolist()]
    return ((z / model.n).astype(np.float64) @ model.components.T) * model.scales, deviation


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest entry, by size, of the whitened fit list's covariance less the identity."""
    used = np.flatnonzero(model.scales)
    if not len(used):
        return 0.0
    dims = len(model.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(used), len(used)))
        for batch in batches:
            for x in _blocks(batch.column(0), dims):
                w = _whitened(model, x)[0][:, used]
                total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(range(len(used)), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], ["i", "v"])

    parts = vectors.select("x").mapInArrow(run, "i int, v array<double>")
    cells = parts.select("i", F.posexplode("v").alias("j", "v")).groupBy("i", "j").agg((F.sum("v") / F.lit(float(model.n))).alias("v"))
    off = F.abs(F.col("v") - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0))
    return float(cells.agg(F.max(off)).first()[0])


def whiten(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """One row per kept row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = rows.sparkSession
    path = workspace(spark, "whitening")
    whole = integer_vectors(rows, vec_id, vector)
    kind = dict(whole.dtypes)["vec_id"]
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    # The commonest length; equally common ones: the longest.
    most = whole.groupBy(F.size("x").alias("dims")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dims")).first()
    if most is None:
        return spark.createDataFrame([], schema).withColumnRenamed("vec_id", vec_id)
    dims = int(most.dims)
    whole = whole.where(F.size("x") == dims)
    vectors = save(whole.select("x").distinct(), f"{path}/fit")
    model = fit(vectors, dims, count)
    error = identity_error(vectors, model)
    shared = spark.sparkContext.broadcast(model)  # one matrix of dims by dims
    explained = [e / model.trace if model.trace > 0 else 0.0 for e in model.values]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        k = len(model.values)
        for batch in batches:
            low = 0
            for x in _blocks(batch.column(1), dims):
                w, deviation = _whitened(model, x)
                m = len(x)
                take = pa.array(np.repeat(np.arange(low, low + m), k))
                columns = [
                    batch.column(0).take(take),
                    pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                    pa.array(np.full(m * k, model.n), pa.int64()),
                    pa.array(np.repeat(np.array(deviation, dtype=object), k), pa.int64()),
                    pa.array(w.ravel(), pa.float64()),
                    pa.array(np.tile(explained, m), pa.float64()),
                    pa.array(np.full(m * k, error), pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
                low += m

    return whole.select("vec_id", "x").mapInArrow(run, schema).withColumnRenamed("vec_id", vec_id)
