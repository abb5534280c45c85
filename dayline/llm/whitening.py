"""Whitening of vectors by shifted CholeskyQR.

Entries become integers, so that sums are exact and rows are centred before anything is multiplied.
A Gram pass adds up products of the centred rows, each task its own; the shifted Cholesky factor
of the sum orthogonalises the rows by triangular solves, and further passes over the solved rows
repeat this until their Gram matrix is nearly one.  The factors composed are R of the centred
rows; the singular value decomposition of that small matrix gives the components.  Only sums of the size of
the dimension squared reach the driver; rows stay where they are and are never written.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
#: Entries of this size and above count as not finite: their integers would not be exact.
TOO_LARGE = 2.0**40
#: Passes at most; a Gram matrix this near to one is made one by its own factor; smaller eigenvalues are left to a root.
PASSES, NEAR_ONE, SINGULAR = 8, 1e-4, 1e-8
#: Components whose singular value is below this share of the largest are rounding.
NO_COMPONENT = 1e-12
#: Rows worked on together.
ROWS = 8192
NAMES = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def matrices(batch: pa.RecordBatch, dimension: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows that count, by dimension: their places in the batch, and their entries as integers."""
    vectors = batch["embedding"]
    sizes = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    for size in np.unique(sizes) if dimension is None else [dimension]:
        if size == 0:
            continue
        at = np.flatnonzero(sizes == size)
        for k in range(0, len(at), ROWS):
            part = at[k : k + ROWS]
            values = vectors.take(pa.array(part)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            values = values.reshape(len(part), size)
            good = (np.abs(values) < TOO_LARGE).all(axis=1)  # false for null (as NaN) and what is not finite
            yield part[good], np.floor(SCALE * values[good]).astype(np.int64) + SHIFT


def fit_list(vectors: DataFrame) -> tuple[int, list[int]]:
    """Number of rows that count, and the exact sum of each dimension; of rows of several dimensions the commonest."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for _, x in matrices(batch):
                if len(x):
                    n, total = sums.get(x.shape[1], (0, 0))
                    sums[x.shape[1]] = n + len(x), total + x.sum(axis=0).astype(object)
        rows = [(d, k, n, str(s)) for d, (n, total) in sums.items() for k, s in enumerate(total)]
        columns = list(zip(*rows)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.string()))],
            ["dimension", "k", "n", "sum"],
        )

    parts = vectors.select("embedding").mapInArrow(add, "dimension int, k int, n long, sum string")
    sums = parts.groupBy("dimension", "k").agg(
        F.sum("n").alias("n"), F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum")
    )
    common = sums.where("k = 0").orderBy(F.col("n").desc(), F.col("dimension").desc()).select("dimension", "n").first()
    if common is None:
        return 0, []
    rows = sums.where(F.col("dimension") == common["dimension"]).orderBy("k").collect()
    return common["n"], [int(r["sum"]) for r in rows]


def solved(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """``rows`` times the inverse of an upper triangle, column by column."""
    out = np.empty_like(rows)
    for k in range(factor.shape[0]):
        out[:, k] = (rows[:, k] - out[:, :k] @ factor[:k, k]) / factor[k, k]
    return out


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """Integers less their mean: whole parts are taken off exactly, then the fraction."""
    whole = np.array([s // n for s in sums], np.int64)
    part = np.array([s % n / n for s in sums])
    return (x - whole) - part


def gram(vectors: DataFrame, dimension: int, width: int, rows_of: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Gram matrix and sums of the ``width`` columns that ``rows_of`` makes of the integers of each row that counts."""
    upper = np.triu_indices(width + 1)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width + 1))
        for batch in batches:
            for _, x in matrices(batch, dimension):
                made = np.column_stack([rows_of(x), np.ones(len(x))])
                total += made.T @ made
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(upper[0]))), pa.array(total[upper])], ["at", "value"])

    parts = vectors.select("embedding").mapInArrow(add, "at long, value double")
    found = parts.groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    total = np.zeros((width + 1, width + 1))
    at = found["at"].to_numpy()
    total[upper[0][at], upper[1][at]] = found["value"].to_numpy()
    total = total + np.triu(total, 1).T
    return total[:width, :width], total[:width, width]


def factor_of(products: np.ndarray, rows: int, first: bool) -> tuple[np.ndarray, bool]:
    """Upper triangle whose square is the Gram matrix, shifted in the first pass; False where only a root will do."""
    d = len(products)
    values, axes = np.linalg.eigh(products)
    if first:
        shift = 11 * (rows * d + d * (d + 1)) * np.finfo(float).eps / 2 * values[-1]
        return np.linalg.cholesky(products + shift * np.eye(d)).T, True
    if values[0] < SINGULAR * values[-1]:
        return np.sqrt(np.maximum(values, 0))[:, None] * axes.T, False
    return np.linalg.cholesky(products).T, True


def decomposed(vectors: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """R of the centred rows (up to a rotation from the left), composed of the factors of all passes."""
    d = len(sums)
    factors: list[np.ndarray] = []
    composed = np.eye(d)
    for k in range(PASSES):

        def rows_of(x: np.ndarray, factors: tuple = tuple(factors)) -> np.ndarray:
            rows = centred(x, n, sums)
            for factor in factors:
                rows = solved(rows, factor)
            return rows

        products, _ = gram(vectors, d, d, rows_of)
        if not products.any():
            return products  # all rows are equal
        factor, triangle = factor_of(products, n, first=k == 0)
        composed = factor @ composed
        if not triangle or np.abs(products - np.eye(d)).max() < NEAR_ONE:
            break
        factors.append(factor)
    return composed


def components(composed: np.ndarray, n: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit components (as columns), square roots of their eigenvalues, and shares of the trace."""
    _, sigma, axes = np.linalg.svd(composed)
    kept = min(most, int((sigma > NO_COMPONENT * max(sigma[0], np.finfo(float).tiny)).sum()))
    axes = axes[:kept]
    if kept:  # of both signs, the one whose largest entry is positive
        largest = axes[np.arange(kept), np.abs(axes).argmax(axis=1)]
        axes = axes * np.sign(largest)[:, None]
    return axes.T, sigma[:kept] / np.sqrt(n), sigma[:kept] ** 2 / max((sigma**2).sum(), np.finfo(float).tiny)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sum over dimensions of ``(n*x - S)**2`` per row; null where a long does not hold it."""
    whole, left = np.array([s // n for s in sums], np.int64), np.array([s % n for s in sums], np.int64)
    apart = x - whole
    most = (int(np.abs(apart).max(initial=0)) + 1) * n
    if most * most * len(sums) < 1 << 63:
        return ((apart * n - left) ** 2).sum(axis=1).tolist()
    exact = ((apart.astype(object) * n - left.astype(object)) ** 2).sum(axis=1)
    return [v if v < 1 << 63 else None for v in exact]


def whiten(vectors: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` of ``vectors(vec_id, embedding)``.

    One row per vector that counts and component, of at most ``most``; components whose eigenvalue is nothing but
    rounding aren't there, so equal vectors, a single one and an empty table give no rows.  Vectors that are null, empty, hold null or
    non-finite entries (or entries from ``TOO_LARGE`` up), or have not the commonest dimension, do not count.  Rows that repeat count
    each and get equal results; other columns are not read.
    """
    spark = vectors.sparkSession
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    kinds = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    schema = f"vec_id {id_type}, {kinds}"
    n, sums = fit_list(vectors)
    axes, roots, shares = components(decomposed(vectors, n, sums), n, most) if n else (np.zeros((0, 0)), [], [])
    kept = len(roots)
    if not kept:
        return spark.createDataFrame([], schema)
    scaled = axes / roots

    def project(x: np.ndarray) -> np.ndarray:
        return centred(x, n, sums) @ scaled

    d = len(sums)
    _, total = gram(vectors, d, kept, project)
    mean = total / n
    products, _ = gram(vectors, d, kept, lambda x: project(x) - mean)
    error = float(np.abs(products / n - np.eye(kept)).max())

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in matrices(batch, d):
                times = len(at) * kept
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["vec_id"].take(pa.array(np.repeat(at, kept))),
                        pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), len(at))),
                        pa.array(np.full(times, n, np.int64)),
                        pa.array([v for v in deviations(x, n, sums) for _ in range(kept)], pa.int64()),
                        pa.array(project(x).ravel()),
                        pa.array(np.tile(shares, len(at))),
                        pa.array(np.full(times, error)),
                    ],
                    NAMES,
                )

    return vectors.select("vec_id", "embedding").mapInArrow(make, schema)
