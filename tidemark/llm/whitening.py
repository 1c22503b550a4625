"""Whitening of embeddings by pivoted Cholesky and one-sided Jacobi.

The entries of a vector are put on a grid of whole numbers. The sums of all different grid vectors are exact; their
scatter is added up from vectors that are centred first, one partial matrix a task, the cells of all tasks added by a
shuffle. Only matrices as wide as a vector reach the driver. There the scatter is factored by Cholesky with the largest
pivot first, which stops at its numerical rank, and the columns of the triangular factor are rotated against each other
until they are orthogonal. Their squared norms are then the eigenvalues and the columns themselves, normalised, the
components. No product of the factor with itself is formed, so small eigenvalues keep their digits.

Defined results: vectors that are null or empty, or hold null or non-finite entries, take no part, and neither do those
of another length than most (of equally common lengths the longest counts). Grid entries are limited to 2^53 either way. Repeated
vectors are fitted once and returned each, with a null id too. There are as many components as the rank allows: none if
all vectors are alike, and then no rows. A deviation beyond a long is null. Equal eigenvalues come in any order. Other columns
are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import query, ready, table
from tidemark.session import cut_lineage

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
LIMIT = float(2**53)
SWEEPS = 60


# --- the two factorings ----------------------------------------------------------------------------------------------


def pivoted_cholesky(matrix: np.ndarray) -> np.ndarray:
    """L with L L' = matrix, as many columns as its rank. Its rows are triangular in order of the pivots."""
    size = len(matrix)
    left = np.diag(matrix).astype(float).copy()
    least = size * np.finfo(float).eps * max(left.max(initial=0.0), 0.0)
    factor = np.zeros((size, size))
    open_rows = np.ones(size, dtype=bool)
    for k in range(size):
        pivot = int(np.argmax(np.where(open_rows, left, -np.inf)))
        if not left[pivot] > least:
            return factor[:, :k]
        column = matrix[:, pivot] - factor[:, :k] @ factor[pivot, :k]
        column[~open_rows] = 0.0
        column[pivot] = left[pivot]
        factor[:, k] = column / np.sqrt(left[pivot])
        left -= factor[:, k] ** 2
        open_rows[pivot] = False
    return factor


def _rounds(size: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rounds of disjoint pairs in which every two of ``size`` (even) columns meet once."""
    around = np.arange(size)
    found = []
    for _ in range(size - 1):
        found.append((around[: size // 2].copy(), around[: size // 2 - 1 : -1].copy()))
        around[1:] = np.roll(around[1:], 1)
    return found


def orthogonal_columns(factor: np.ndarray, sweeps: int = SWEEPS) -> np.ndarray:
    """The factor times rotations, so that its columns are orthogonal. Disjoint pairs are rotated together."""
    rank = factor.shape[1]
    # A column of zeros gives every column a partner and stays zero.
    columns = np.concatenate([factor, np.zeros((len(factor), rank % 2))], axis=1)
    rounds = _rounds(columns.shape[1]) if rank > 1 else []
    for _ in range(sweeps):
        worst = 0.0
        for one, other in rounds:
            p, q = columns[:, one], columns[:, other]
            a, b, c = (p * p).sum(axis=0), (q * q).sum(axis=0), (p * q).sum(axis=0)
            scale = np.sqrt(a * b)
            angle = np.divide(np.abs(c), scale, out=np.zeros_like(c), where=scale > 0)
            worst = max(worst, float(angle.max(initial=0.0)))
            turned = angle > 1e-16
            slope = np.divide(b - a, 2 * c, out=np.zeros_like(c), where=turned)
            sign = np.where(slope >= 0, 1.0, -1.0)
            t = np.where(turned, sign / (np.abs(slope) + np.hypot(1.0, slope)), 0.0)
            cos = 1 / np.sqrt(1 + t * t)
            columns[:, one], columns[:, other] = cos * p - cos * t * q, cos * t * p + cos * q
        if worst < 1e-14:
            break
    return columns[:, :rank]


# --- the model -------------------------------------------------------------------------------------------------------


@dataclass
class Whitening:
    """Mean of the fit list as a whole number and a rest for each dimension, components as columns, their variances."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    trace: float

    def __post_init__(self) -> None:
        self.base = np.array([round(Fraction(s, self.n)) for s in self.sums], dtype=np.int64)
        self.over = [s - self.n * int(b) for s, b in zip(self.sums, self.base)]
        self.rest = np.array([over / self.n for over in self.over])

    def centred(self, grid: np.ndarray) -> np.ndarray:
        """Grid vectors less the mean. The large whole part goes before anything is rounded."""
        return (grid - self.base) - self.rest

    def whitened(self, grid: np.ndarray) -> np.ndarray:
        return self.centred(grid) @ (self.components / np.sqrt(self.variances))

    def deviations(self, grid: np.ndarray) -> list[int | None]:
        """Exact sums of (n x - S)^2."""
        off = grid - self.base
        widest = self.n * int(np.abs(off).max(initial=0)) + self.n
        if len(self.sums) * widest**2 < 2**63:
            return ((self.n * off - np.array(self.over, dtype=np.int64)) ** 2).sum(axis=1).tolist()
        over = np.array(self.over, dtype=object)
        exact = [int(((self.n * row - over) ** 2).sum()) for row in off.astype(object)]
        return [value if value < 2**63 else None for value in exact]


def grid(vector: Column) -> Column:
    """floor(64 c) + 1,000,000 of each entry c, as double."""

    def point(entry: Column) -> Column:
        scaled = F.least(F.greatest(SCALE * entry.cast("double"), F.lit(-LIMIT)), F.lit(LIMIT))
        return F.floor(scaled) + F.lit(SHIFT).cast("bigint")

    return F.transform(vector, point)


def usable(vectors: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is whole and finite and as long as most."""
    inf = F.lit(float("inf"))
    # Null entries make the test null, which is not true.
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < inf))
    found = vectors.where((F.size(vector) > 0) & F.coalesce(finite, F.lit(False)))
    most = found.groupBy(F.size(vector).alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return found.where(F.size(vector) == (most["size"] if most else 0))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _added(fit: DataFrame, size: int, measure) -> np.ndarray:
    """The sum over all grid vectors of a measure that gives a row of doubles for a matrix of them; one row of cells a
    task goes through the shuffle."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = measure(_matrix(batch.column(0), size))
                total = found if total is None else total + found
        if total is not None:
            arrays = [pa.array(np.arange(len(total))), pa.array(total)]
            yield pa.RecordBatch.from_arrays(arrays, ["cell", "value"])

    found = fit.mapInArrow(cells, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    return np.array([row["value"] for row in sorted(found)], dtype=float)


def _sums(fit: DataFrame, size: int) -> tuple[int, list[int]]:
    """The number of grid vectors, and the exact sum of each dimension."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * size
        for batch in batches:
            rows = _matrix(batch.column(0), size)
            n += len(rows)
            # Upper and lower halves, so that no sum of a batch overflows.
            high, low = rows >> 32, rows & 0xFFFFFFFF
            total = [t + (int(h) << 32) + int(x) for t, h, x in zip(total, high.sum(axis=0), low.sum(axis=0))]
        if n:
            arrays = [pa.array(range(size), pa.int64()), pa.array([n] * size, pa.int64()), pa.array(total, pa.decimal128(28, 0))]
            yield pa.RecordBatch.from_arrays(arrays, ["cell", "n", "value"])

    found = fit.mapInArrow(added, "cell long, n long, value decimal(28,0)")
    found = sorted(found.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("value").alias("value")).collect())
    return (found[0]["n"] if found else 0), [int(row["value"]) for row in found]


def fit_whitening(fit: DataFrame, size: int, most: int = COMPONENTS) -> Whitening | None:
    """The whitening of a table of different grid vectors of one length; None if there are no two of them."""
    n, sums = _sums(fit, size)
    if n < 2:
        return None
    model = Whitening(n, sums, np.zeros((size, 0)), np.zeros(0), 0.0)
    upper = np.triu_indices(size)

    def scatter(rows: np.ndarray) -> np.ndarray:
        centred = model.centred(rows)
        return (centred.T @ centred)[upper]

    matrix = np.zeros((size, size))
    matrix[upper] = _added(fit, size, scatter) / n
    matrix = matrix + np.triu(matrix, 1).T
    columns = orthogonal_columns(pivoted_cholesky(matrix))
    variances = (columns * columns).sum(axis=0)
    order = np.argsort(-variances, kind="stable")[:most]
    order = order[variances[order] > 0]
    model.variances = variances[order]
    model.components = columns[:, order] / np.sqrt(model.variances)
    model.trace = float(np.trace(matrix))
    return model


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """How far the covariance of the whitened fit list is from the identity, measured on all of it."""
    size, kept = model.components.shape

    def products(rows: np.ndarray) -> np.ndarray:
        found = model.whitened(rows)
        return np.concatenate([found.sum(axis=0), (found.T @ found).ravel()])

    found = _added(fit, size, products) / model.n
    mean = found[:kept]
    covariance = found[kept:].reshape(kept, kept) - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(kept)).max())


def whiten(rows: DataFrame, model: Whitening, id_column: str, grid_column: str) -> DataFrame:
    """(id, component, n, deviation, whitened, explained) for each row and component."""
    size, kept = model.components.shape
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found = _matrix(batch.column(1), size)
            count = len(found)
            each = np.repeat(np.arange(count), kept)
            deviation = pa.array(model.deviations(found), pa.int64())
            arrays = [
                batch.column(0).take(pa.array(each)),
                pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), count)),
                pa.array(np.full(count * kept, model.n, dtype=np.int64)),
                deviation.take(pa.array(each)),
                pa.array(model.whitened(found).ravel()),
                pa.array(np.tile(model.variances / model.trace, count)),
            ]
            yield pa.RecordBatch.from_arrays(arrays, [id_column, "component", "n", "deviation", "whitened", "explained"])

    kind = rows.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, component int, n long, deviation long, whitened double, explained double"
    return rows.select(id_column, grid_column).mapInArrow(apply, schema)


@query("op13_whitening")
def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Sixteen whitened components of every embedding."""
    ready(spark)
    rows = usable(table(spark, folder, "embeddings").select("vec_id", "embedding"), "embedding")
    rows = rows.select("vec_id", grid(F.col("embedding")).alias("x"))
    fit = cut_lineage(rows.select("x").distinct())
    first = fit.first()
    model = fit_whitening(fit, len(first["x"])) if first else None
    if model is None or not model.components.shape[1]:
        kind = rows.schema["vec_id"].dataType.simpleString()
        names = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return spark.createDataFrame([], names)
    found = whiten(rows, model, "vec_id", "x")
    return found.withColumn("identity_error", F.lit(identity_error(fit, model)))
