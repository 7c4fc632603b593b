"""Whitening of embeddings by principal components to double precision.

Entries become whole numbers ``x = floor(64 c) + 1000000``. Every distinct vector is counted once for
the fit: sums by dimension and the covariance come from Spark, where each task adds the products of
its own centred vectors and only ``d x d`` partial sums are shuffled. The eigenvectors of the covariance,
a matrix of the embedding's width and so of bounded size, are found on the driver by mixed precision:

* ``eigh`` in 32-bit floats gives a first guess;
* Ogita-Aishima steps correct it by matrix products in extended precision: with ``R = I - X'X`` and
  ``S = X'AX`` the eigenvalues are ``S_ii / (1 - R_ii)``, and ``X + XE`` is the better guess, where
  ``E_ij = (S_ij + l_j R_ij) / (l_j - l_i)``, and ``R_ij / 2`` for eigenvalues too close to be told apart;
* the vectors of such a cluster are only an orthonormal basis of the right space: a sub-solve of the
  matrix within that space, shifted and scaled to the cluster's own spread, turns them.

Both are repeated until nothing moves. Equal eigenvalues keep any orthonormal basis.

Defined results: rows whose vector is null or holds null, NaN or infinite entries are dropped; other rows
stay, whatever their ids. Vectors may differ in length: missing entries at the end count as 0. An ``x``
beyond 2^53 is set to that bound. Components without variance, as with one distinct vector, have ``whitened``
0 and don't count in ``identity_error``; a ``deviation`` beyond a long is null. Empty tables, and vectors
without entries, give no rows. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundcheck.llm.common import stored

SCALE, SHIFT, BOUND = 64, 1_000_000, float(1 << 53)
#: Vectors that a task centres at once.
ROWS = 4096


@dataclass(frozen=True)
class Fit:
    """Of the distinct vectors: their number, sums by dimension (Python integers), eigenvalues from
    the largest, and unit eigenvectors as columns."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def whole_vectors(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``id, x`` of every row with a finite vector; ``x`` has the longest vector's length."""
    entry = lambda c: c.cast("double")
    finite = F.forall("v", lambda c: F.coalesce(F.abs(entry(c)) < F.lit(float("inf")), F.lit(False)))
    scaled = lambda c: F.greatest(F.least(F.floor(entry(c) * SCALE), F.lit(BOUND).cast("long")), F.lit(-BOUND).cast("long")) + SHIFT
    kept = rows.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v")).where(F.col("v").isNotNull() & finite)
    kept = stored(kept.select("id", F.transform("v", scaled).alias("x")), "whitening-rows")
    width = kept.agg(F.coalesce(F.max(F.size("x")), F.lit(0))).first()[0]
    short = F.concat("x", F.array_repeat(F.lit(SHIFT).cast("long"), F.lit(width) - F.size("x")))
    return kept.select("id", F.when(F.size("x") < width, short).otherwise(F.col("x")).alias("x"))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """``x - S/n``: whole parts first, so that no digits are lost to large offsets."""
    base = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return (x - base) - rest


def products(batches: Iterator[pa.RecordBatch], n: int, sums: tuple[int, ...], into: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Sum over a task's vectors of the outer products of the centred vectors, or of their
    projections by ``into``: a row for each dimension."""
    total = None
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            c = centred(matrix(batch.slice(at, ROWS).column(0)), n, sums)
            c = c if into is None else c @ into
            total = c.T @ c if total is None else total + c.T @ c
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))], ["i", "sums"])


def covariance(fit: DataFrame, n: int, sums: tuple[int, ...], into: np.ndarray | None = None) -> np.ndarray:
    """Covariance of the vectors, or of their projections, divided by ``n``."""
    parts = fit.select("x").mapInArrow(lambda batches: products(batches, n, sums, into), "i int, sums array<double>")
    cells = parts.select("i", F.posexplode("sums").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    width = len(sums) if into is None else into.shape[1]
    found = np.zeros((width, width))
    for r in cells:
        found[r.i, r.j] = r.v
    return (found + found.T) / (2 * n)


def clusters(values: np.ndarray, close: float) -> list[np.ndarray]:
    """Runs of two or more eigenvalues, each no further than ``close`` from the next."""
    order = np.argsort(-values, kind="stable")
    runs = np.split(order, np.flatnonzero(-np.diff(values[order]) > close) + 1)
    return [r for r in runs if len(r) > 1]


def eigenvectors(a: np.ndarray, rounds: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues from the largest, and unit eigenvectors as columns, of a symmetric matrix."""
    size = float(np.abs(a).max(initial=0.0))
    if size == 0.0:
        return np.zeros(len(a)), np.eye(len(a))
    wide = np.longdouble
    a = a.astype(wide) / wide(size)
    norm = np.sqrt((a * a).sum())
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(wide)
    unit = np.eye(len(a), dtype=wide)
    tiny = 16 * len(a) * np.finfo(wide).eps
    for _ in range(rounds):
        r, s = unit - x.T @ x, x.T @ a @ x
        r, s = (r + r.T) / 2, (s + s.T) / 2  # rounding that isn't symmetric would be blown up by small gaps
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(np.diag(s))
        if np.abs(r).max() <= tiny and np.abs(off).max() <= tiny * norm:
            break
        close = 2 * (np.sqrt((off * off).sum()) + norm * np.sqrt((r * r).sum()))
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > close
        mean = (values[None, :] + values[:, None]) / 2
        # (S_ij + l_j R_ij) / (l_j - l_i), as a turn and half of what orthogonality lacks.
        x = x + x @ (np.where(apart, (off + mean * r) / np.where(apart, gap, 1), 0) + r / 2)
        for run in clusters(values, close):
            sub, one = x[:, run], unit[: len(run), : len(run)]
            inner = sub.T @ a @ sub
            inner = (inner + inner.T) / 2 - one * values[run].mean()
            spread = np.abs(inner).max()
            if spread > tiny * norm:
                turn = np.linalg.eigh((inner / spread).astype(np.float32))[1].astype(wide)
                for _ in range(3):  # else its own rounding would keep the cluster from being told apart
                    turn = turn @ (3 * one - turn.T @ turn) / 2
                x[:, run] = sub @ turn
    values = np.diag(x.T @ a @ x) / np.diag(x.T @ x)
    order = np.argsort(-values, kind="stable")
    return (values[order] * wide(size)).astype(float), (x[:, order] / np.sqrt(np.diag(x.T @ x))[order]).astype(float)


def train(vectors: DataFrame) -> tuple[Fit | None, DataFrame]:
    """The fit over distinct vectors of ``whole_vectors``, and these, stored. None without entries."""
    fit = stored(vectors.select("x").distinct(), "whitening-fit")
    sums = fit.select(F.posexplode("x").alias("i", "x")).groupBy("i").agg(F.sum(F.col("x").cast("decimal(18,0)")).alias("s"), F.count(F.lit(1)).alias("n")).collect()
    if not sums:
        return None, fit
    n, sums = sums[0].n, tuple(int(r.s) for r in sorted(sums, key=lambda r: r.i))
    found = covariance(fit, n, sums)
    values, vectors_ = eigenvectors(found)
    return Fit(n, sums, values, vectors_, float(np.trace(found))), fit


def projection(model: Fit, components: int) -> np.ndarray:
    """Columns that take a centred vector to its whitened components; zero for those without variance."""
    k = min(components, len(model.values))
    values = model.values[:k]
    there = values > max(model.values[0], 0.0) * len(model.values) * np.finfo(float).eps
    return np.where(there, model.vectors[:, :k] / np.sqrt(np.where(there, values, 1.0)), 0.0)


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Sums of ``(n x - S)^2`` of whole numbers, exact; None beyond a long."""
    base, rest = np.array([s // n for s in sums], np.int64), np.array([s % n for s in sums], np.int64)
    most = n * (int(np.abs(x - base).max(initial=0)) + 1)
    if most * most * max(len(sums), 1) < 1 << 63:
        d = n * (x - base) - rest
        return (d * d).sum(axis=1).tolist()
    d = n * (x - base).astype(object) - rest.astype(object)
    return [v if v < 1 << 63 else None for v in map(int, (d * d).sum(axis=1))]


def whiten(vectors: DataFrame, model: Fit, components: int = 16) -> DataFrame:
    """``id, component, deviation, whitened`` of every row and component."""
    into, n, sums = projection(model, components), model.n, model.sums
    k = into.shape[1]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                x = matrix(batch.column(1))
                rows = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(deviations(x, n, sums), pa.int64()).take(pa.array(rows)), pa.array((centred(x, n, sums) @ into).reshape(-1))],
                    ["id", "component", "deviation", "whitened"],
                )

    return vectors.select("id", "x").mapInArrow(project, f"id {dict(vectors.dtypes)['id']}, component int, deviation long, whitened double")


def whitened_embeddings(rows: DataFrame, components: int = 16, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error``."""
    vectors = whole_vectors(rows, id_col, vec_col)
    model, fit = train(vectors)
    kind = dict(vectors.dtypes)["id"]
    if model is None:
        return rows.sparkSession.createDataFrame([], f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    into = projection(model, components)
    there = np.abs(into).max(axis=0, initial=0.0) > 0
    error = covariance(fit, model.n, model.sums, into) - np.diag(there.astype(float))
    share = F.array(*[F.lit(float(v) / model.trace if model.trace > 0 else 0.0) for v in np.where(there, model.values[: len(there)], 0.0)])
    found = whiten(vectors, model, components)
    return found.select("id", "component", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", F.element_at(share, F.col("component")).alias("explained"), F.lit(float(np.abs(error).max(initial=0.0))).alias("identity_error"))
