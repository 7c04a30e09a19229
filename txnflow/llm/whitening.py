"""Whitening of embeddings by the leading principal components.

* Vectors become whole numbers, x = floor(``scale`` c) + ``shift``, so that sums over them are exact. The fit list has each distinct one once; copies
  collapse in a grouped aggregation before and behind its shuffle, so a vector that a third of all rows share sends one row a task.
* Sums, then the centred covariance: each task adds up its own part, centred before it is multiplied, and sends one row for
  each dimension; a grouped sum puts the parts together. What reaches the driver are d rows of d numbers.
* The covariance matrix is made tridiagonal by Householder reflections. Sturm counts, the number of negative pivots of T - x, locate
  each leading eigenvalue by bisection; inverse iteration gives its vector. Vectors of eigenvalues that lie close together
  are made orthogonal to one another in every step of the iteration. Then the reflections are applied backwards.
* The mean and the components are broadcast, at most d (k + 1) numbers, and every row is projected where it is. The covariance of the projected fit
  list is measured in a pass of its own and compared with the identity.

Defined results: rows whose vector is null or empty, holds null or non-finite entries, or entries so large that ``scale`` times them is 2**40 or more, take no part, nor do
those whose length isn't the most frequent one (of equally frequent ones the greatest); rows that repeat id and vector give repeated results; a component with
an eigenvalue below 1e-12 of the largest cannot be scaled to one and is left out, so one distinct vector, or none, gives no rows; a deviation beyond 63 bits is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnflow.llm.common import ship_package
from txnflow.session import stage

#: Eigenvalues closer than this share of the largest are one cluster.
CLUSTER = 1e-3

#: Smaller eigenvalues, as shares of the largest, are taken for zero.
ZERO = 1e-12

#: Numbers of which a square still fits 63 bits with all its neighbours.
EXACT = 1 << 31


def householder(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal and subdiagonal of the tridiagonal matrix, and the unit normals of the reflections that led to it."""
    a = np.array(matrix, np.float64)
    d = len(a)
    normals = []
    for k in range(d - 2):
        x = a[k + 1:, k]
        normal = np.zeros(d)
        length = np.linalg.norm(x)
        if np.abs(x[1:]).max() > 0:
            normal[k + 1:] = x
            normal[k + 1] += np.copysign(length, x[0])
            normal /= np.linalg.norm(normal)
            p = a @ normal
            p -= normal * (normal @ p)
            a -= 2 * (np.outer(normal, p) + np.outer(p, normal))
        normals.append(normal)
    return np.diag(a).copy(), np.diag(a, -1).copy(), normals


def below(diagonal: np.ndarray, side: np.ndarray, x: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix are less than each of ``x``: the negative pivots of T - x."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    squares = np.r_[0.0, side ** 2]
    pivot, count = np.ones(len(x)), np.zeros(len(x), np.int64)
    for entry, square in zip(diagonal, squares, strict=True):
        pivot = entry - x - square / pivot
        pivot[np.abs(pivot) < tiny] = -tiny
        count += pivot < 0
    return count


def leading_values(diagonal: np.ndarray, side: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, by bisection of all of them at once."""
    radius = np.abs(np.r_[side, 0.0]) + np.abs(np.r_[0.0, side])
    low = np.full(k, (diagonal - radius).min())
    high = np.full(k, (diagonal + radius).max())
    margin = np.finfo(float).eps * max(abs(low[0]), abs(high[0]))
    low, high = low - margin, high + margin
    wanted = len(diagonal) - 1 - np.arange(k)
    while True:
        middle = (low + high) / 2
        if ((middle <= low) | (middle >= high)).all():
            return middle
        right = below(diagonal, side, middle) <= wanted
        low, high = np.where(right, middle, low), np.where(right, high, middle)


def solve_shifted(diagonal: np.ndarray, side: np.ndarray, value: float, rhs: np.ndarray) -> np.ndarray:
    """(T - value)^-1 rhs, by elimination with row exchanges; pivots of zero are replaced by tiny ones."""
    n = len(diagonal)
    size = max(np.abs(diagonal).max(), np.abs(side).max(initial=0.0), np.finfo(float).tiny)
    tiny = np.finfo(float).eps * size
    rows = np.zeros((n, 3))
    rows[:, 0] = diagonal - value
    rows[:-1, 1] = side
    x = np.array(rhs, np.float64)
    for i in range(n - 1):
        here, next_row = rows[i].copy(), np.array([side[i], rows[i + 1, 0], rows[i + 1, 1]])
        if abs(next_row[0]) > abs(here[0]):
            here, next_row = next_row, here
            x[i], x[i + 1] = x[i + 1], x[i]
        if abs(here[0]) < tiny:
            here[0] = tiny
        factor = next_row[0] / here[0]
        rows[i] = here
        rows[i + 1] = [next_row[1] - factor * here[1], next_row[2] - factor * here[2], 0.0]
        x[i + 1] -= factor * x[i]
    if abs(rows[-1, 0]) < tiny:
        rows[-1, 0] = tiny
    for i in reversed(range(n)):
        rest = rows[i, 1] * x[i + 1] if i + 1 < n else 0.0
        rest += rows[i, 2] * x[i + 2] if i + 2 < n else 0.0
        x[i] = (x[i] - rest) / rows[i, 0]
    return x


def inverse_iteration(diagonal: np.ndarray, side: np.ndarray, values: np.ndarray, rounds: int = 5) -> np.ndarray:
    """Unit eigenvectors, a column each, of falling eigenvalues ``values``."""
    n, out = len(diagonal), []
    draw = np.random.default_rng(13)
    first = 0
    for i, value in enumerate(values):
        if i and values[i - 1] - value > CLUSTER * max(abs(values[0]), np.finfo(float).tiny):
            first = i
        vector = draw.standard_normal(n)
        for _ in range(rounds):
            vector = solve_shifted(diagonal, side, value, vector / np.abs(vector).max())
            vector /= np.abs(vector).max()
            for _ in range(2):
                for other in out[first:i]:
                    vector -= other * (other @ vector)
            vector /= np.linalg.norm(vector)
        out.append(vector)
    return np.array(out).T.reshape(n, len(values))


def leading_eigen(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns."""
    if not np.any(matrix):
        return np.zeros(min(k, len(matrix))), np.eye(len(matrix))[:, :k]
    diagonal, side, normals = householder(matrix)
    values = leading_values(diagonal, side, min(k, len(diagonal)))
    vectors = inverse_iteration(diagonal, side, values)
    for normal in reversed(normals):
        vectors -= 2 * np.outer(normal, normal @ vectors)
    return values, vectors / np.linalg.norm(vectors, axis=0)


@dataclass(frozen=True)
class Whitening:
    n: int
    sums: np.ndarray
    values: np.ndarray
    #: scaled components, a column each
    projection: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums) @ self.projection


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / n with the whole part of the mean taken off first, so that no digits are lost."""
    whole = sums // n
    return (x - whole) - (sums - whole * n) / n


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Exact sums of (n x - sums)**2 over the dimensions of each row."""
    if n * max(1, int(np.abs(x).max(initial=1))) < 1 << 62:
        apart = n * x - sums
        if int(np.abs(apart).max(initial=0)) < EXACT / np.sqrt(max(1, x.shape[1])):
            return (apart * apart).sum(axis=1).tolist()
    exact = n * x.astype(object) - sums.astype(object)
    return [total if total < 1 << 63 else None for total in (exact * exact).sum(axis=1).tolist()]


def usable(vectors: DataFrame, scale: float, shift: int, id_column: str, vector_column: str) -> DataFrame:
    """``vec_id`` and whole numbers ``x`` of the rows that take part."""
    c = F.col(vector_column).cast("array<double>")

    def fits(e: Column) -> Column:
        return e.isNotNull() & ~F.isnan(e) & (F.abs(e * F.lit(scale)) < F.lit(float(1 << 40)))

    rows = vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), c.alias("c"))
    rows = rows.where(F.col("c").isNotNull() & (F.size("c") > 0)).where(F.forall("c", fits))
    return rows.select("vec_id", F.transform("c", lambda e: F.floor(e * F.lit(scale)).cast("bigint") + F.lit(shift)).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _second_moments(rows: DataFrame, width: int, values) -> np.ndarray:
    """Sum over all rows of the outer products of ``values(x)``, ``width`` numbers each, and in a last row their sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width))
        for batch in batches:
            if batch.num_rows:
                part = values(_matrix(batch.column(0)))
                total[:-1] += part.T @ part
                total[-1] += part.sum(axis=0)
        listed = pa.ListArray.from_arrays(pa.array(np.arange(0, total.size + 1, width, dtype=np.int32)), pa.array(total.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width + 1)), listed], names=["i", "parts"])

    parts = rows.select("x").mapInArrow(run, "i bigint, parts array<double>")
    summed = parts.select("i", F.posexplode("parts").alias("j", "part")).groupBy("i", "j").agg(F.sum("part").alias("part"))
    whole = np.zeros((width + 1, width))
    # So many numbers as the matrix has, whatever the rows.
    found = summed.toPandas()
    whole[found["i"], found["j"]] = found["part"]
    return whole


def fit_whitening(rows: DataFrame, components: int = 16) -> Whitening | None:
    """Fitted to the distinct ``x`` of ``rows``, which have one length; None without two of them."""
    spark = rows.sparkSession
    ship_package(spark)
    distinct = stage(rows.select("x").distinct(), "fit-list")
    width = distinct.select(F.max(F.size("x"))).first()[0]
    n = distinct.count()
    if n < 2:
        return None

    def sums_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, object)
        for batch in batches:
            if batch.num_rows:
                total += _matrix(batch.column(0)).sum(axis=0).astype(object)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array([int(t) for t in total], pa.int64())], names=["i", "part"])

    per_dimension = distinct.mapInArrow(sums_of, "i bigint, part bigint").groupBy("i").agg(F.sum("part").alias("total")).collect()
    sums = np.zeros(width, np.int64)
    for row in per_dimension:
        sums[row["i"]] = row["total"]

    second = _second_moments(distinct, width, lambda x: centred(x, n, sums))
    covariance = second[:-1] / n
    covariance = (covariance + covariance.T) / 2
    values, vectors = leading_eigen(covariance, components)
    good = values > ZERO * max(values[0], 0.0) if values[0] > 0 else np.zeros(len(values), bool)
    values, vectors = values[good], vectors[:, good]
    fitted = Whitening(n, sums, values, vectors / np.sqrt(values), values / np.trace(covariance))
    if not len(values):
        return None
    measured = _second_moments(distinct, len(values), fitted.whitened)
    mean = measured[-1] / n
    error = float(np.abs(measured[:-1] / n - np.outer(mean, mean) - np.eye(len(values))).max())
    return Whitening(n, sums, values, fitted.projection, fitted.explained, error)


WHITENED = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = 16, scale: float = 64.0, shift: int = 1_000_000, id_column: str = "vec_id",
           vector_column: str = "embedding") -> DataFrame:
    """A row for each vector that takes part and each of the leading components: see ``WHITENED``."""
    spark = vectors.sparkSession
    rows = stage(usable(vectors, scale, shift, id_column, vector_column), "whole-vectors")
    widths = rows.groupBy(F.size("x").alias("width")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("width")).first()
    fitted = fit_whitening(rows.where(F.size("x") == widths["width"]), components) if widths else None
    if fitted is None:
        return spark.createDataFrame([], WHITENED)
    shared, k = spark.sparkContext.broadcast(fitted), len(fitted.values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x, rows = _matrix(batch.column(1)), np.repeat(np.arange(batch.num_rows), k)
            each = lambda column: pa.array(np.tile(column, batch.num_rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), each(np.arange(1, k + 1, dtype=np.int32)), pa.array(np.full(len(rows), model.n)),
                 pa.array(deviations(x, model.n, model.sums), pa.int64()).take(pa.array(rows)), pa.array(model.whitened(x).ravel()),
                 each(model.explained), pa.array(np.full(len(rows), model.identity_error))],
                names=[c.split()[0] for c in WHITENED.split(", ")])

    return rows.where(F.size("x") == widths["width"]).mapInArrow(project, WHITENED)
