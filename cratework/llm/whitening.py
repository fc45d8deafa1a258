"""Whitening of embeddings by shifted CholeskyQR.

Centred rows are never stored: every pass reads the integer rows, centres them, solves them
through the triangular factors found so far and adds up their Gram matrix. The first factor
comes from a shifted Cholesky decomposition, the next ones from what the one before left
short of orthogonal. The factors' product is R, and its SVD gives eigenvalues and components
without ever squaring the condition of the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratework.llm.common import Scratch

MOST_PASSES = 10
EPS = float(np.finfo(np.float64).eps)
# Singular values below this share of the largest are rounding, not variance.
NO_VARIANCE = 1e-11


class Whitening(NamedTuple):
    """What a fit knows; its size is bounded by the square of the dimension."""

    size: int  # entries of a vector
    n: int  # distinct vectors
    sums: list[int]  # of the distinct vectors, by dimension
    components: np.ndarray  # a row for each, by falling eigenvalue
    eigenvalues: np.ndarray
    trace: float  # of the covariance
    identity_error: float
    passes: int


def whole_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, x): floor(scale * entry) of vectors that are not null and have no null or non-finite entry."""
    finite = F.forall("embedding", lambda c: c.isNotNull() & (F.abs(c) < float("inf")))
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * scale).cast("long"))
    return vectors.where(F.col("embedding").isNotNull() & finite).select(F.col("vec_id").cast("long"), x.alias("x"))


def common_size(whole: DataFrame) -> int:
    """The most frequent number of entries (of equally frequent ones the larger); 0 without rows."""
    sizes = whole.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n"))
    row = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    return row["size"] if row else 0


def _rows(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, size)


def _sums(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = 0, [0] * size
        for batch in batches:
            x = _rows(batch.column(0), size)
            if not len(x):
                continue
            if int(np.abs(x).max()) * len(x) >= 1 << 62:
                x = x.astype(object)
            count += len(x)
            total = [a + int(b) for a, b in zip(total, x.sum(axis=0))]
        if count:
            dims, sums = pa.array(range(-1, size), pa.int32()), pa.array([count, *total], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([dims, sums], ["dim", "total"])

    return run


def _centred(x: np.ndarray, mean: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """Rows without their mean, solved through the upper triangular factors one after the other."""
    q = x - mean
    for r in factors:
        for j in range(q.shape[1]):
            q[:, j] = (q[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def _gram(size: int, mean: np.ndarray, factors: list[np.ndarray], to: np.ndarray | None = None):
    """(dim, part, row): a task's Gram matrix of the rows, or of their projection by ``to``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            q = _centred(_rows(batch.column(0), size), mean, factors)
            if to is not None:
                q = q @ to
            total = q.T @ q if total is None else total + q.T @ q
        if total is not None:
            columns = [
                pa.array(range(len(total)), pa.int32()),
                pa.array([TaskContext.get().partitionId()] * len(total), pa.int32()),
                pa.array([r.tobytes() for r in total], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["dim", "part", "row"])

    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (dim, part): sums in a fixed order."""

    def out(dim: int, total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["dim", "row"])

    dim, total = None, None
    for batch in batches:
        for own, raw in zip(batch.column(0).to_pylist(), batch.column(2)):
            part = np.frombuffer(raw.as_py(), np.float64)
            if own == dim:
                total = total + part
                continue
            if dim is not None:
                yield out(dim, total)
            dim, total = own, part
    if dim is not None:
        yield out(dim, total)


def gram(rows: DataFrame, size: int, mean: np.ndarray, factors: list[np.ndarray], to: np.ndarray | None = None) -> np.ndarray:
    """The Gram matrix over all rows: size x size numbers come to the driver, a row of it at a time is added up in tasks."""
    parts = rows.mapInArrow(_gram(size, mean, factors, to), "dim int, part int, row binary")
    added = parts.repartition("dim").sortWithinPartitions("dim", "part").mapInArrow(_add, "dim int, row binary")
    found = {r["dim"]: np.frombuffer(r["row"], np.float64) for r in added.collect()}
    return np.array([found[i] for i in range(len(found))])


def _upper(g: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """The upper Cholesky factor; shifted if asked for, or if there is none without."""
    d = len(g)
    shift = 11 * (n * d + d * (d + 1)) * EPS * np.linalg.norm(g, 2)
    while True:
        try:
            return np.linalg.cholesky(g + (shift if shifted else 0) * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift, shifted = (shift * 10 if shifted else shift), True


def _settled(g: np.ndarray) -> bool:
    """Every direction is either orthonormal or empty."""
    values = np.linalg.eigvalsh(g)
    return bool(np.minimum(np.abs(values - 1), np.abs(values)).max() < 1e-10)


def fit(whole: DataFrame, components: int = 4) -> Whitening | None:
    """Eigenvectors of the covariance of the distinct vectors ``x`` (divisor n), up to ``components``.

    Vectors of another than the most frequent length are left out. A component has its sign from
    its largest entry, which is positive. Directions without variance (constant or dependent
    columns, fewer distinct vectors than dimensions) give no component, so one vector gives none.
    Returns None where there is no vector or no entry.
    """
    size = common_size(whole)
    if not size:
        return None
    scratch = Scratch(whole.sparkSession, "whitening")
    # Partial distinct in every task first: a vector that fills a third of all rows is sent once by each.
    rows = scratch.stage(whole.where(F.size("x") == size).select("x").distinct(), "distinct")
    totals = rows.mapInArrow(_sums(size), "dim int, total decimal(38,0)").groupBy("dim").agg(F.sum("total").alias("t"))
    found = {r["dim"]: int(r["t"]) for r in totals.collect()}  # a row for each dimension
    n, sums = found[-1], [found[i] for i in range(size)]
    mean = np.array([s / n for s in sums])
    factors: list[np.ndarray] = []
    g = gram(rows, size, mean, factors)
    trace = float(np.trace(g)) / n
    passes = 1
    empty = np.empty((0, size))
    if not trace:
        return Whitening(size, n, sums, empty, np.empty(0), 0.0, 0.0, passes)
    while not (factors and _settled(g)) and passes < MOST_PASSES:
        factors.append(_upper(g, n, shifted=not factors))
        g = gram(rows, size, mean, factors)
        passes += 1
    r = np.eye(size)
    for factor in factors:
        r = factor @ r
    # What is left between Q and orthonormal, by its symmetric root: Q'Q is g, so rows'rows is r'gr.
    values, vectors = np.linalg.eigh(g)
    _, singular, v = np.linalg.svd((np.sqrt(np.maximum(values, 0))[:, None] * vectors.T) @ r)
    keep = np.flatnonzero(singular[:components] > NO_VARIANCE * singular[0])
    singular, v = singular[keep], v[keep]
    v = v * np.sign(v[np.arange(len(v)), np.abs(v).argmax(axis=1)])[:, None]
    eigenvalues = singular**2 / n
    spread = gram(rows, size, mean, [], (v / np.sqrt(eigenvalues)[:, None]).T) / n
    error = float(np.abs(spread - np.eye(len(v))).max())
    scratch.drop("distinct")
    return Whitening(size, n, sums, v, eigenvalues, trace, error, passes)


RESULT = "vec_id long, component int, deviation decimal(38,0), whitened double"


def _whiten(model: Whitening):
    to = (model.components / np.sqrt(model.eigenvalues)[:, None]).T
    mean = np.array([s / model.n for s in model.sums])
    most = max(map(abs, model.sums))
    k = len(model.components)

    def deviations(x: np.ndarray) -> pa.Array:
        bound = int(np.abs(x).max()) * model.n + most
        if model.size * bound**2 < 1 << 63:
            off = x * model.n - np.array(model.sums, np.int64)
            return pa.array((off * off).sum(axis=1)).cast(pa.decimal128(38, 0))
        off = x.astype(object) * model.n - np.array(model.sums, object)
        return pa.array([int(d) for d in (off * off).sum(axis=1)], pa.decimal128(38, 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x = _rows(batch.column(1), model.size)
            turn = pa.array(np.repeat(np.arange(len(x)), k))
            columns = [
                batch.column(0).take(turn),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                deviations(x).take(turn),
                pa.array(((x - mean) @ to).reshape(-1)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "deviation", "whitened"])

    return run


def whiten(whole: DataFrame, model: Whitening | None) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every row of the fit's length.

    ``deviation`` is exact, the sum over dimensions of (n * x - sum)^2. Repeated rows and null
    vec_ids have rows each; without a model, or without variance, there are none.
    """
    if model is None or not len(model.components):
        rows = whole.sparkSession.createDataFrame([], RESULT)
        explained, n, error = F.lit(0.0), 0, 0.0
    else:
        rows = whole.where(F.size("x") == model.size).mapInArrow(_whiten(model), RESULT)
        shares = F.array(*[F.lit(float(e / model.trace)) for e in model.eigenvalues])
        explained, n, error = F.element_at(shares, F.col("component")), model.n, model.identity_error
    return rows.select(
        "vec_id",
        "component",
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained.alias("explained"),
        F.lit(error).alias("identity_error"),
    )
