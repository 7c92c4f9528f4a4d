import math

import numpy as np
import pytest

from quiremill.llm import embedding_whitening as op12

SCHEMA = "vec_id long, embedding array<double>, label int, `x.y` string, n long"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 7) for i, v in rows], SCHEMA)


def steps(v):
    return np.array([[math.floor(64 * c) + 1_000_000 for c in r] for r in v])


def test_jacobi_finds_small_eigenvalues():
    rng = np.random.default_rng(1)
    for d in (1, 2, 3, 5, 8, 33):
        g = rng.standard_normal((d, d)) * 10.0 ** -np.arange(d).clip(0, 7)
        a = g.T @ g
        e, v = op12.jacobi(a)
        assert (np.diff(e) <= 0).all() and np.abs(v.T @ v - np.eye(d)).max() < 1e-13
        assert np.abs(a @ v - v * e).max() <= 1e-13 * e[0]
    # a graded matrix, whose small eigenvalues a solver that only bounds the absolute error would lose
    scale = 10.0 ** -np.arange(0, 24, 4)
    b = np.eye(6) + 0.1
    e, _ = op12.jacobi(scale[:, None] * b * scale)
    from fractions import Fraction

    def det(m):
        m, out = [[Fraction(float(x)) for x in r] for r in m], Fraction(1)
        for k in range(len(m)):
            out *= m[k][k]
            for r in range(k + 1, len(m)):
                f = m[r][k] / m[k][k]
                m[r] = [x - f * y for x, y in zip(m[r], m[k])]
        return out

    assert math.prod(map(float, e)) == pytest.approx(float(det(scale[:, None] * b * scale)), rel=1e-12)
    assert op12.jacobi(np.zeros((3, 3)))[0].tolist() == [0, 0, 0]
    assert [sorted(map(tuple, np.concatenate([np.stack(r, 1) for r in op12.rounds(d)]).tolist())) for d in (2, 5)] == [[(0, 1)], [(i, j) for i in range(5) for j in range(i + 1, 5)]]


def test_against_dense_algebra(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((300, 40)) @ rng.standard_normal((40, 40)) * 0.3 + 5
    bad = [(900, None), (901, [1.0] * 39 + [None]), (902, [float("nan")] * 40), (903, [float("inf")] * 40), (904, [])]
    rows = [(i % 290, r.tolist()) for i, r in enumerate(x)] + [(None, x[0].tolist())] + bad
    got = op12.whiten(frame(spark, rows).repartition(5)).collect()
    s = steps([v for _, v in rows[:301]])
    n = len(s)
    assert len(got) == n and {r.n for r in got} == {n}
    cov = np.cov(s.T, bias=True)
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:32], v[:, ::-1][:, :32]
    want = (s - s.mean(0)) @ v / np.sqrt(e)
    order = {}
    for (i, _), w, dev in zip(rows, want, ((n * s - s.sum(0)) ** 2).sum(1)):
        order.setdefault(i, []).append((w, int(dev)))
    for r in got:
        assert any(np.allclose(np.abs(r.whitened), np.abs(w), atol=1e-6) and r.deviation == dev for w, dev in order[r.vec_id])
        assert np.allclose(r.explained, e / np.trace(cov), rtol=1e-9)
    z = np.array([r.whitened for r in got])
    error = np.abs(np.cov(z.T, bias=True) - np.eye(32)).max()
    assert error < 1e-9 and all(abs(r.identity_error - error) < 1e-9 for r in got)


def test_partitions_change_nothing(spark):
    x = np.random.default_rng(3).standard_normal((97, 6))
    runs = [{(r.vec_id, r.deviation, tuple(r.whitened), tuple(r.explained)) for r in op12.whiten(frame(spark, [(i, v.tolist()) for i, v in enumerate(x)]).repartition(k)).collect()} for k in (1, 4)]
    assert runs[0] == runs[1]


def test_edges(spark):
    assert op12.whiten(frame(spark, [])).collect() == []
    one = op12.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r.vec_id, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(i, 2, 0, [None, None], [None, None], None) for i in (1, 2)]
    rank = {r.vec_id: r for r in op12.whiten(frame(spark, [(1, [0.0, 0.0]), (2, [1.0, 1.0]), (3, [2.0, 2.0]), (4, [7.0])])).collect()}
    assert rank[1].whitened[1] is None and abs(abs(rank[1].whitened[0]) - math.sqrt(1.5)) < 1e-12 and rank[1].explained == [1.0, 0.0]
    assert rank[4].n == 1 and rank[4].whitened == [None]
    far = {r.vec_id: r for r in op12.whiten(frame(spark, [(1, [1e308, 0.0]), (2, [-1e308, 1.0]), (3, [0.0, 0.5])])).collect()}
    assert far[1].deviation is None and far[3].deviation == 0 + 0  # its entries are the means
    assert far[1].identity_error < 1e-4
    with pytest.raises(ValueError, match="max_cells"):
        op12.fit(frame(spark, [(1, [1.0] * 5)]), max_cells=24)


def test_query(spark, sf):
    got = op12.op12_embedding_whitening(spark, sf)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = got.collect()
    n = spark.read.parquet(f"{sf}/embeddings.parquet").count()
    assert len(rows) == n * 32 and max(r.component for r in rows) == 32 and min(r.component for r in rows) == 1
    assert max(r.identity_error for r in rows) < 1e-9
