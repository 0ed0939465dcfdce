"""Embedding whitening by pivoted Cholesky and one-sided Jacobi.

1. A vector's entries become longs: ``floor(64 * entry) + OFFSET``. The fit list holds each distinct long vector once; its
   row count n and the sums per dimension S are exact.
2. The centred scatter is summed per task from ``(n * x - S) / n`` (the subtraction in integers), then over tasks by matrix cell.
3. On the driver, a matrix of dimension x dimension numbers: Cholesky with the largest remaining diagonal entry as pivot
   gives ``V = L L'``, stopped at the numerical rank; one-sided Jacobi rotates pairs of columns of the triangular factor
   itself until all are orthogonal. The columns' squared norms are the eigenvalues, the normalised columns
   the components. V is never diagonalised, so small eigenvalues keep their relative precision.
4. Every row is projected in numpy, and the covariance of the whitened fit list is measured against the identity.

The driver holds a few d x d matrices for vectors of length d, whatever the number of rows; a component is a closure of at
most ``top`` x d numbers.

Rows are left out whose vector is null or empty, holds a null or non-finite entry, has an entry of 2**56 or more (its long
would not exist), or has another length than most of them (the longer length on ties). Ids may be null or repeat: every row
gives its own result rows. If all remaining vectors are equal (or there are none) there is no component, and the result is
empty; there are never more components than the rank. ``deviation`` is null where it exceeds a long. Other columns are not
read. Components have the sign that makes their largest entry positive.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.llm import common as c

SCALE, OFFSET = 64, 1_000_000
LARGEST = float(1 << 56)
ROWS = 2048
COMPONENTS = 16
OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double"


def long_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, x: the scaled vectors without ``OFFSET``, as arrays of longs of one length."""
    entry = F.col("embedding").cast("array<double>")
    usable = F.forall(entry, lambda v: v.isNotNull() & (F.abs(v) < LARGEST)) & (F.size("embedding") > 0)
    longs = vectors.select(F.col("vec_id").cast("long"), entry.alias("embedding")).filter(usable).select(
        "vec_id", F.transform("embedding", lambda v: F.floor(SCALE * v).cast("long")).alias("x"))
    lengths = longs.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("rows"))
    most = lengths.agg(F.max(F.struct("rows", "d")).alias("m")).first()["m"]
    return longs.filter(F.size("x") == (most["d"] if most else 0))


def _matrices(batches):
    """(ids, x) blocks of at most ROWS rows; ids only where the batch has them."""
    for batch in batches:
        named = "vec_id" in batch.schema.names
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            column = part.column("x")
            x = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)
            yield part.column("vec_id") if named else None, x


def _sums(batches):
    """Rows and exact sums per dimension of a task."""
    n, total = 0, None
    for _, x in _matrices(batches):
        wide = x if np.abs(x).max() < 1 << 50 else x.astype(object)
        part = [int(v) for v in wide.sum(0)]
        total = part if total is None else [a + b for a, b in zip(total, part)]
        n += len(x)
    if n:
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(total)), pa.int32()), pa.array([n] * len(total), pa.int64()), pa.array([str(v) for v in total])], ["i", "n", "s"])


def numerators(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: longs if they fit, Python integers otherwise."""
    largest = max(int(np.abs(x).max()), 1) if x.size else 1
    if n * largest < 1 << 61:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _centred(n, sums):
    return lambda x: (numerators(x, n, sums) / n).astype(np.float64)


def _scatter(n, sums):
    """Upper triangle of a task's sum of outer products of centred rows."""

    def run(batches):
        centred, total = _centred(n, sums), None
        for _, x in _matrices(batches):
            y = centred(x)
            total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], ["i", "j", "v"])

    return run


def _collect(cells: DataFrame, d: int) -> np.ndarray:
    """The d x d matrix summed over tasks: d * (d + 1) / 2 numbers reach the driver."""
    rows = cells.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros((d, d))
    i, j = rows.column("i").to_numpy(), rows.column("j").to_numpy()
    out[i, j] = out[j, i] = rows.column("v").to_numpy()
    return out


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """L with V = L L', one column for each step; steps end where no pivot stands out of rounding.

    Rows keep their places; ordered by pivots, L is lower triangular.
    """
    d = len(v)
    rest, columns = v.astype(np.float64).copy(), []
    floor = d * np.finfo(np.float64).eps * max(v.diagonal().max(), 0) if d else 0
    for _ in range(d):
        p = int(np.argmax(rest.diagonal()))
        if rest[p, p] <= floor:
            break
        column = rest[:, p] / math.sqrt(rest[p, p])
        rest -= np.outer(column, column)
        # what is eliminated stays exactly zero
        rest[p, :] = rest[:, p] = 0
        columns.append(column)
    return np.array(columns).T if columns else np.zeros((d, 0))


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The factor's columns rotated pairwise until all are orthogonal to working precision."""
    a = factor.copy()
    k = a.shape[1]
    limit = max(len(a), 1) * np.finfo(np.float64).eps
    for _ in range(sweeps):
        worst = 0.0
        for p in range(k - 1):
            for q in range(p + 1, k):
                x, y = a[:, p], a[:, q]
                pp, qq, pq = x @ x, y @ y, x @ y
                if pq == 0 or abs(pq) <= limit * math.sqrt(pp * qq):
                    continue
                worst = max(worst, abs(pq) / math.sqrt(pp * qq))
                zeta = (qq - pp) / (2 * pq)
                t = math.copysign(1, zeta) / (abs(zeta) + math.hypot(1, zeta))
                cos = 1 / math.hypot(1, t)
                a[:, p], a[:, q] = cos * (x - t * y), cos * (t * x + y)
        if worst == 0:
            return a
    raise ArithmeticError(f"the columns are not orthogonal after {sweeps} sweeps")


def components(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of V in falling order and their unit eigenvectors as columns."""
    rotated = one_sided_jacobi(pivoted_cholesky(v))
    values = (rotated ** 2).sum(0)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], rotated[:, order] / np.sqrt(values[order])
    if vectors.size:
        largest = vectors[np.abs(vectors).argmax(0), range(vectors.shape[1])]
        vectors = vectors * np.where(largest < 0, -1.0, 1.0)
    return values, vectors


def _deviations(part: np.ndarray) -> list[int | None]:
    """Exact sums of squares per row; None beyond a long."""
    if part.dtype != object and (part.astype(np.float64) ** 2).sum(1).max() < float(1 << 62):
        return (part * part).sum(1).tolist()
    exact = [sum(int(v) ** 2 for v in row) for row in part]
    return [v if v < 1 << 63 else None for v in exact]


def _project(n, sums, vectors, values, explained):
    def run(batches):
        k = len(values)
        for ids, x in _matrices(batches):
            top = numerators(x, n, sums)
            white = (top / n).astype(np.float64) @ vectors / np.sqrt(values)
            rows = len(x)
            yield pa.RecordBatch.from_arrays([
                ids.take(pa.array(np.repeat(np.arange(rows), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, n)), pa.array(_deviations(top), pa.int64()).take(pa.array(np.repeat(np.arange(rows), k))),
                pa.array(white.ravel()), pa.array(np.tile(explained, rows))], ["vec_id", "component", "n", "deviation", "whitened", "explained"])

    return run


def _white_scatter(n, sums, vectors, values):
    def run(batches):
        centred, total = _centred(n, sums), None
        for _, x in _matrices(batches):
            y = centred(x) @ vectors / np.sqrt(values)
            total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], ["i", "j", "v"])

    return run


def whiten(vectors: DataFrame, top: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for the first ``top`` components."""
    longs = long_vectors(vectors)
    fit = c.written(longs.select("x").distinct())
    parts = c.map_batches(fit, _sums, "i int, n long, s string")
    rows = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("i").collect()
    d, n, sums = len(rows), rows[0]["n"] if rows else 0, [int(r["s"]) for r in rows]
    empty = vectors.sparkSession.createDataFrame([], f"{OUT}, identity_error double")
    if not n:
        return empty
    v = _collect(c.map_batches(fit, _scatter(n, sums), "i int, j int, v double"), d) / n
    values, vectors_ = components(v)
    values, vectors_ = values[:top], vectors_[:, :top]
    if not len(values):
        return empty
    white = _collect(c.map_batches(fit, _white_scatter(n, sums, vectors_, values), "i int, j int, v double"), len(values)) / n
    error = float(np.abs(white - np.eye(len(values))).max())
    out = c.map_batches(longs, _project(n, sums, vectors_, values, values / v.trace()), OUT)
    return out.withColumn("identity_error", F.lit(error))
