"""Whitening of embeddings by shifted CholeskyQR.

Entries become whole numbers first, ``floor(scale * c) + offset``, so that sums over the corpus are exact in any order.

1. One pass counts the rows and adds up every dimension.
2. *Gram passes.* Each pass goes over all rows, centres them (``(n x - S) / n``, the numerator exact), multiplies them by the inverse of the triangular factor
   found so far, and adds up the Gram matrix of the result. Its Cholesky factor is one more triangular factor. The first pass shifts the
   diagonal, which keeps the factor well conditioned however long or flat the cloud of rows is; the next ones make the rows orthogonal to rounding.
   Passes go on until a Gram matrix is the identity to 1e-13 (in the directions that hold anything), three to six times.
3. The composed factor R of the centred rows has their singular values and right singular vectors: its SVD on the driver gives the components. Directions that
   hold nothing in the last Gram matrix hold nothing in R.
4. A last pass projects every row, and one before it measures the covariance of the projections against the identity.

Tasks reduce their rows to one Gram matrix each; matrices are added up by row of the matrix, and only sums (dimension x dimension numbers) reach the driver.

Rows whose vector is null, empty, or holds a null, non-finite or huge entry (2 ** 42 and more) are dropped. Vectors of each length are whitened by
themselves. Every row counts, repeated rows and rows without id too. Components whose eigenvalue is zero to rounding are left
out, so a table of equal vectors, and an empty one, give no rows. A deviation that does not fit a long is null. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlark.llm.batches import small_batches

MOST_PASSES = 6
RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str, scale: int, offset: int) -> DataFrame:
    """``(id, x)``: usable rows with their entries as whole numbers."""
    rows = small_batches(vectors).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    usable = (F.size("v") > 0) & F.forall("v", lambda c: c.isNotNull() & (F.abs(c) < float(1 << 42)))  # false for NaN, which counts as largest
    return rows.where(F.coalesce(usable, F.lit(False))).select("id", F.transform("v", lambda c: F.floor(c * scale) + F.lit(offset).cast("long")).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _sums(rows: DataFrame) -> tuple[int, np.ndarray]:
    """Number of rows and the exact sum of every dimension."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.num_rows], pa.int64()), pa.array([_matrix(batch.column(0)).sum(0)], pa.list_(pa.int64()))], names=["n", "s"])

    parts = rows.select("x").mapInArrow(add, "n long, s array<long>").select("n", F.posexplode("s").alias("i", "s"))
    found = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("i").collect()  # one row per dimension
    return found[0]["n"], np.array([r["s"] for r in found], "i8")


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return (n * x - sums) / n


def _gram(rows: DataFrame, prepare: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of the outer products of all prepared rows: one matrix per task, added up row by row of the matrix."""
    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                y = prepare(_matrix(batch.column(0)))
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "g"])

    def add(group: pa.Table) -> pa.Table:
        total = np.stack(group.column("g").to_pylist()).sum(0)
        return pa.table({"i": group.column("i")[:1], "g": pa.array([total], pa.list_(pa.float64()))})

    parts = rows.select("x").mapInArrow(reduce, "i int, g array<double>")
    found = parts.groupBy("i").applyInArrow(add, "i int, g array<double>").collect()  # a group has one row per task
    total = np.array([r["g"] for r in sorted(found, key=lambda r: r["i"])])
    return (total + total.T) / 2


def _factor(gram: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """The upper triangular Cholesky factor, of the shifted matrix at first and where some direction holds nothing."""
    dim = len(gram)
    shift = 11 * (n * dim + dim * (dim + 1)) * np.finfo("f8").eps / 2 * np.linalg.norm(gram, 2)
    if not shifted:
        try:
            return np.linalg.cholesky(gram).T
        except np.linalg.LinAlgError:
            pass
    return np.linalg.cholesky(gram + min(shift, 1e-3 * np.linalg.norm(gram, 2)) * np.eye(dim)).T


def components(rows: DataFrame, n: int, sums: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """``(eigenvectors in columns, eigenvalues, trace)`` of the covariance of ``rows``, at most ``most``, by falling eigenvalue."""
    composed, inverse = np.eye(len(sums)), np.eye(len(sums))
    for k in range(MOST_PASSES):
        gram = _gram(rows, lambda x, r=inverse: _centred(x, n, sums) @ r)
        if not gram.any():
            return np.zeros((len(sums), 0)), np.zeros(0), 0.0
        values, axes = np.linalg.eigh(gram)
        if k and np.minimum(np.abs(values - 1), np.abs(values)).max() < 1e-13 * len(sums):  # ones, and zeros in directions without any extent
            break
        factor = _factor(gram, n, shifted=not k)
        composed = factor @ composed
        inverse = np.linalg.solve(composed, np.eye(len(sums)))
    extent = np.sqrt(np.where(values > 0.5, values, 0.0))
    _, singular, right = np.linalg.svd(extent[:, None] * (axes.T @ composed))
    real = singular > 1e-14 * len(sums) * singular[0]
    kept = min(most, int(real.sum()))
    vectors = right[:kept].T
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), range(kept)])  # of the two signs the one whose largest entry is positive
    return vectors, singular[:kept] ** 2 / n, float((singular ** 2).sum() / n)


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    apart = n * x - sums
    if len(sums) * max(1, int(np.abs(apart).max())) ** 2 < 1 << 63:
        return pa.array((apart * apart).sum(1), pa.int64())
    exact = (sum(int(v) ** 2 for v in row) for row in apart)
    return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = 8, scale: int = 1024, offset: int = 100_000) -> DataFrame:
    """``(id_col, component, n, deviation, whitened, explained, identity_error)``: a row for each usable vector and each of its first ``most`` components.

    ``deviation`` is the sum over the dimensions of (n x - S) squared; ``explained`` a component's share of the variance.
    """
    every = whole_numbers(vectors, id_col, vector_col, scale, offset)
    id_type = every.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, {RESULT}"
    lengths = sorted(r[0] for r in every.groupBy(F.size("x").alias("dim")).count().collect())
    out = vectors.sparkSession.createDataFrame([], schema)
    for dim in lengths:
        rows = every.where(F.size("x") == dim)
        n, sums = _sums(rows)
        directions, values, trace = components(rows, n, sums, most)
        if not len(values):
            continue
        scaled = directions / np.sqrt(values)
        covariance = _gram(rows, lambda x, n=n, s=sums, w=scaled: _centred(x, n, s) @ w) / n
        error = float(np.abs(covariance - np.eye(len(values))).max())

        def project(batches, n=n, sums=sums, scaled=scaled, shares=values / trace, error=error):
            k = len(shares)
            for batch in batches:
                if batch.num_rows:
                    x = _matrix(batch.column(1))
                    each = pa.array(np.repeat(np.arange(batch.num_rows), k))
                    size = batch.num_rows * k
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype="i4"), batch.num_rows)), pa.array(np.full(size, n)),
                        _deviations(x, n, sums).take(each), pa.array((_centred(x, n, sums) @ scaled).reshape(-1)),
                        pa.array(np.tile(shares, batch.num_rows)), pa.array(np.full(size, error))],
                        names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

        out = out.unionByName(rows.mapInArrow(project, schema))
    return out.withColumnRenamed("id", id_col)
