import math

import numpy as np

from offerlens.llm import whitening
from tests.llm.helpers import table


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, 1, 0.5) for i, v in rows], f"vec_id long, embedding array<{kind}>, n int, whitened double")


def brute(rows, top=16):
    """Exact integers for x, n, S and the deviations; a symmetric eigensolver for the rest."""
    kept = [(i, [math.floor(64 * e) + 1_000_000 for e in v]) for i, v in rows
            if v and all(e is not None and math.isfinite(e) for e in v)]
    fit = np.array(sorted(set(tuple(x) for _, x in kept)), dtype=object)
    n, sums = len(fit), fit.sum(0)
    centred = ((n * fit - sums) / n).astype(float)
    v = centred.T @ centred / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:top], vectors[:, ::-1][:, :top]
    out = {}
    for i, x in kept:
        d = n * np.array(x, object) - sums
        white = (d / n).astype(float) @ vectors / np.sqrt(values)
        out[i] = (int((d * d).sum()), white)
    return n, out, values / v.trace()


def random_rows(rows=400, d=24, seed=3):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(rows, d)) @ np.diag(2.0 ** -np.arange(d)[::-1] * 8) @ np.linalg.qr(rng.normal(size=(d, d)))[0]
    return [(i, [float(np.float32(e)) for e in v]) for i, v in enumerate(mixed)]


def test_equals_a_symmetric_eigensolver(spark):
    rows = random_rows()
    rows += [(1000, rows[0][1]), (1001, rows[0][1]), (1002, None), (1003, [float("nan")] * 24), (1004, [None] + [0.0] * 23)]
    n, want, explained = brute(rows)
    got = whitening.whiten(frame(spark, rows).repartition(5)).collect()
    assert len(got) == 402 * 16 and {r.n for r in got} == {n}
    assert {r.vec_id for r in got} == set(range(400)) | {1000, 1001}
    assert all(r.deviation == want[r.vec_id][0] for r in got)
    assert max(r.identity_error for r in got) <= 1e-4
    sign = {}
    for r in got:
        w = want[r.vec_id][1][r.component - 1]
        if abs(w) > 0.1:
            sign.setdefault(r.component, np.sign(w * r.whitened))
        assert abs(r.whitened * sign.get(r.component, 1) - w) < 1e-6 or abs(w) <= 0.1
        assert math.isclose(r.explained, explained[r.component - 1], rel_tol=1e-4)
    assert len(sign) == 16


def test_small_eigenvalues_keep_their_precision():
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.normal(size=(12, 12)))[0]
    # a graded matrix: scaled rows and columns of a well-conditioned one
    scale = np.diag(4.0 ** -np.arange(12))
    v = scale @ (q @ np.diag(np.linspace(1, 2, 12)) @ q.T) @ scale
    values, vectors = whitening.components(v)
    assert (np.diff(values) < 0).all() and values[-1] > 0
    assert np.abs(vectors.T @ vectors - np.eye(12)).max() < 1e-12
    factor = whitening.pivoted_cholesky(v)
    assert np.abs(factor @ factor.T - v).max() < 1e-15
    order = np.argsort([np.flatnonzero(factor[i])[-1] for i in range(12)], kind="stable")
    assert np.allclose(np.triu(factor[order], 1), 0)


def test_rank_repeats_and_empty_tables(spark):
    rng = np.random.default_rng(2)
    flat = [(i, [float(a), float(b), float(a + b), 1.0]) for i, (a, b) in enumerate(rng.integers(-50, 50, (60, 2)))]
    got = whitening.whiten(frame(spark, flat)).collect()
    assert {r.component for r in got} == {1, 2} and len(got) == 120
    same = frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (None, [1.0, 2.0])])
    assert whitening.whiten(same).count() == 0
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, None), (2, []), (3, [float("inf")])])).count() == 0


def test_other_lengths_null_ids_and_wide_numbers(spark):
    rows = [(None, [1.0, 2.0]), (2, [3.0, 1.0]), (2, [3.0, 1.0]), (3, [5.0, 5.5]), (4, [1.0]), (5, [2.0 ** 60, 1.0])]
    got = whitening.whiten(frame(spark, rows, "double")).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0) for r in got) == [(False, 2)] * 4 + [(False, 3)] * 2 + [(True, 0)] * 2
    wide = [(1, [2.0 ** 52, 0.0]), (2, [-(2.0 ** 52), 3.0]), (3, [0.5, 1.0])]
    assert {r.deviation for r in whitening.whiten(frame(spark, wide, "double")).collect() if r.vec_id != 3} == {None}
    n, want, _ = brute(wide, 2)
    small = [r for r in whitening.whiten(frame(spark, wide, "double")).collect() if r.vec_id == 3]
    assert n == 3 and small[0].deviation == want[3][0]


def test_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, "embeddings").collect()]
    n, want, explained = brute(rows)
    got = whitening.whiten(table(spark, "embeddings")).collect()
    assert len(got) == 16 * len(want) and all(r.n == n and r.deviation == want[r.vec_id][0] for r in got)
    assert all(math.isclose(r.explained, explained[r.component - 1], rel_tol=1e-4) for r in got)
