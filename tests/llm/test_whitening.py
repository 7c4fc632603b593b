"""Whitening against plain numpy, and the eigenvector refinement against known spectra."""

import math

import numpy as np
import pytest

from groundcheck.llm import queries, whitening


def plain(rows):
    """Whole vectors by id, n, S, eigenvalues and vectors."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(v) for _, v in kept), default=0)
    x = [[math.floor(64 * c) + 1_000_000 for c in v] + [1_000_000] * (width - len(v)) for _, v in kept]
    fit = sorted(set(map(tuple, x)))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    m = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in fit])
    values, vectors = np.linalg.eigh(m.T @ m / n)
    return [i for i, _ in kept], x, n, sums, values[::-1], vectors[:, ::-1]


def compare(found, rows, components=16):
    ids, x, n, sums, values, vectors = plain(rows)
    k = min(components, len(sums))
    assert len(found) == len(ids) * k
    # Repeated ids: compare the sorted rows of all.
    dev = {tuple(v): sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x}
    assert sorted(str((r.id, r.deviation)) for r in found if r.component == 1) == sorted(str((i, dev[tuple(v)])) for i, v in zip(ids, x))
    assert {r.n for r in found} == {n} and len({r.identity_error for r in found}) == 1
    assert found[0].identity_error < 1e-9
    share = {r.component: r.explained for r in found}
    for c in range(k):
        assert share[c + 1] == pytest.approx(max(values[c], 0) / values.sum(), rel=1e-9, abs=1e-14)
    return ids, x, n, sums, values, vectors


def test_query_equals_plain_version(spark, small_dir):
    rows = [(r.vec_id, r.embedding) for r in queries.table(spark, small_dir, "embeddings").collect()]
    found = queries.op13_embedding_whitening(spark, small_dir).withColumnRenamed("vec_id", "id").collect()
    ids, x, n, sums, values, vectors = compare(found, rows)
    got = np.zeros((len(ids), 16))
    place = {i: k for k, i in enumerate(ids)}
    for r in found:
        got[place[r.id], r.component - 1] = r.whitened
    want = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in x]) @ vectors[:, :16] / np.sqrt(values[:16])
    signs = np.sign((got * want).sum(axis=0))
    assert np.abs(got - want * signs).max() < 1e-8


@pytest.mark.parametrize("spectrum", [[5, 4, 3, 2, 1], [1e6, 1e6 + 1e-3, 1e6 + 2e-3, 3, 1e-5], [7, 7, 7, 2, 2], [1, 0, 0, 0, 0], [1e12, 1e12 * (1 + 1e-9), 5, 5 + 1e-9, 1]])
def test_refinement_of_known_spectra(spectrum):
    rng = np.random.default_rng(len(spectrum))
    q = np.linalg.qr(rng.standard_normal((5, 5)).astype(np.longdouble).astype(float))[0].astype(np.longdouble)
    for _ in range(3):
        q = q @ (1.5 * np.eye(5, dtype=np.longdouble) - 0.5 * (q.T @ q))
    a = (q * np.array(sorted(spectrum, reverse=True), np.longdouble)) @ q.T
    values, x = whitening.eigenvectors((a + a.T) / 2)
    size = max(spectrum)
    assert np.abs(values - sorted(spectrum, reverse=True)).max() <= 4e-15 * size
    assert np.abs(x.T @ x - np.eye(5)).max() < 4e-16 * 5
    assert np.abs(a.astype(float) @ x - x * values).max() <= 4e-15 * size


def test_close_eigenvalues_keep_their_vectors():
    """Gaps of 1e-9, far below what 32-bit floats tell apart: vectors as true as the gap allows."""
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.standard_normal((40, 40)))[0].astype(np.longdouble)
    for _ in range(3):
        q = q @ (1.5 * np.eye(40, dtype=np.longdouble) - 0.5 * (q.T @ q))
    values = np.array([1 + 1e-9 * k for k in range(10)][::-1] + list(np.linspace(0.5, 0.1, 30)), np.longdouble)
    a = (q * values) @ q.T
    got, x = whitening.eigenvectors((a + a.T) / 2)
    assert np.abs(np.abs((q.T.astype(float) @ x).diagonal()) - 1).max() < 1e-12
    assert np.abs(q.T.astype(float) @ x - np.diag(np.sign(np.diag(q.T.astype(float) @ x)))).max() < 1e-8


def test_rounding_to_whole_numbers_and_dropped_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [0.5, -0.001, 1.0]), (2, None), (3, [0.5, None, 1.0]), (4, [inf, 0.0, 0.0]), (5, [nan, 0.0, 0.0]), (6, [0.25, 2.0, -1.0]), (None, [0.1, 0.2, 0.3]), (6, [0.25, 2.0, -1.0]), (7, [1.0]), (8, [])]
    df = spark.createDataFrame([(i, v, 9, 9.0) for i, v in rows], "vec_id long, embedding array<double>, n int, whitened double")
    found = whitening.whitened_embeddings(df).collect()
    compare(found, rows)
    assert not {2, 3, 4, 5} & {r.id for r in found}


def test_without_variance_and_without_rows(spark):
    schema = "vec_id long, embedding array<float>"
    one = whitening.whitened_embeddings(spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25])], schema)).collect()
    assert len(one) == 4 and all(r.whitened == 0 and r.deviation == 0 and r.n == 1 and r.explained == 0 and r.identity_error == 0 for r in one)
    flat = whitening.whitened_embeddings(spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.75, 0.25]), (3, [0.0, 0.25])], schema)).collect()
    assert {r.component for r in flat} == {1, 2} and all(r.whitened == 0 for r in flat if r.component == 2) and flat[0].identity_error < 1e-12
    assert whitening.whitened_embeddings(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whitened_embeddings(spark.createDataFrame([(1, None), (2, [])], schema)).collect() == []


def test_large_deviations_are_exact():
    x = np.array([[3 * 10**9, 0], [1, 2]], np.int64)
    n, sums = 10**6, (5 * 10**15 + 1, 7)
    want = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x]
    assert whitening.deviations(x, n, sums) == [v if v < 1 << 63 else None for v in want]
    assert whitening.deviations(x[1:], 3, (9, 9)) == [(3 - 9) ** 2 + (6 - 9) ** 2]
