from __future__ import annotations

import math

import numpy as np
import pytest

from rarespark.llm import whitening as w

SCHEMA = "vec_id bigint, embedding array<float>, label int, component int, n bigint, v string"


def vectors(rows):
    return [(i, v, 0, 7, 7, "x") for i, v in rows]


def whole(rows, width):
    good = [(i, v) for i, v in rows if v is not None and len(v) == width and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v in good]
    return [i for i, _ in good], x


def check(report, rows, width, k=8):
    """Against numpy's eigenvectors of the plainly computed covariance."""
    ids, x = whole(rows, width)
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    centred = np.array([[(n * a - s) / n for a, s in zip(v, sums, strict=True)] for v in x])
    values, vecs = np.linalg.eigh(centred.T @ centred / n)
    values, vecs = values[::-1], vecs[:, ::-1]
    rank = int((values > values[0] * 1e-10).sum())
    k = min(k, rank)
    want = centred @ vecs[:, :k] / np.sqrt(values[:k])
    deviation = {}
    for i, v in zip(ids, x, strict=True):
        deviation.setdefault(i, []).append(sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True)))
    found = report.collect()
    assert len(found) == n * k
    for c in range(k):
        mine = [r for r in found if r.component == c + 1]
        assert {r.n for r in mine} == {n}
        assert all(r.explained == pytest.approx(values[c] / values.sum(), rel=1e-9) for r in mine)
        for r in mine:  # beyond 64 bits the report has null
            near = deviation[r.vec_id]
            assert r.deviation in near or (r.deviation is None and min(near) >= 2**63)
        got = sorted(r.whitened for r in mine)
        plus, minus = sorted(want[:, c]), sorted(-want[:, c])
        assert np.allclose(got, plus, atol=1e-8) or np.allclose(got, minus, atol=1e-8)
        by_id = {r.vec_id: r.whitened for r in mine}
        signs = {round(by_id[i] / z) for i, z in zip(ids, want[:, c], strict=True) if abs(z) > 1e-3 and ids.count(i) == 1}
        assert len(signs) == 1
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-9


@pytest.mark.parametrize("d", [1, 2, 7, 64])
def test_eigen_matches_numpy(d):
    rng = np.random.default_rng(d)
    b = rng.normal(size=(d, 3 * d)) * np.logspace(0, 4, d)[:, None]
    a = b @ b.T
    values, vectors_ = w.eigen(a)
    want = np.linalg.svd(b, compute_uv=False) ** 2  # keeps the digits of small values
    assert np.allclose(values, want, rtol=1e-9)
    assert np.allclose(vectors_ @ vectors_.T, np.eye(d), atol=1e-12)
    assert np.allclose(vectors_.T @ np.diag(values) @ vectors_, a, rtol=1e-9, atol=1e-9 * abs(a).max())


def test_small_eigenvalues_keep_their_digits():
    """The factor's columns are graded, so tiny eigenvalues of a scaled matrix stay relative."""
    scale = np.logspace(0, -6, 6)
    base = np.eye(6) + 0.3
    values, _ = w.eigen(base * np.outer(scale, scale))
    exact = np.linalg.svd(np.linalg.cholesky(base) * scale[:, None], compute_uv=False) ** 2
    assert np.allclose(values, exact, rtol=1e-9)


def test_rank_is_found():
    x = np.outer(np.arange(5.0), [1, 2, 3]) + 1
    c = x - x.mean(axis=0)
    values, vectors_ = w.eigen(c.T @ c)
    assert len(values) == 1 and np.allclose(np.abs(vectors_[0]), np.array([1, 2, 3]) / math.sqrt(14))
    assert len(w.eigen(np.zeros((3, 3)))[0]) == 0


def test_given_table(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    check(w.whitening_report(df.repartition(7)), rows, 64)


def test_edges(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=3).astype(np.float32).tolist()) for i in range(40)]
    rows += [(100, None), (101, [1.0, None, 2.0]), (102, [math.nan, 0.0, 0.0]), (103, [math.inf, 0.0, 0.0])]
    rows += [(104, []), (105, [1.0]), (7, [3.0, 3.0, 3.0]), (None, [-2.0, 0.5, 0.25]), (1, rows[1][1])]
    df = spark.createDataFrame(vectors(rows), SCHEMA)
    check(w.whitening_report(df), rows, 3)
    far = spark.createDataFrame(vectors([*rows, (200, [2.0**40, 0.0, 0.0])]), SCHEMA)
    assert w.whitening_report(far).where("vec_id = 200").count() == 0


def test_no_rows(spark):
    for rows in ([], [(1, None)], [(1, [])], [(1, [2.0, 3.0])], [(1, [2.0, 3.0]), (2, [2.0, 3.0])]):
        assert w.whitening_report(spark.createDataFrame(vectors(rows), SCHEMA)).collect() == []


def test_one_dimension_and_large_entries(spark):
    rows = [(i, [float(i * i) * 1e6]) for i in range(30)]
    df = spark.createDataFrame(vectors(rows), SCHEMA)
    check(w.whitening_report(df), rows, 1)
    model = w.fit(df)
    _, x = whole(rows, 1)
    n, s = 30, sum(v[0] for v in x)
    assert {int(r.deviation) for r in w.whiten(df, model).collect()} == {(n * v[0] - s) ** 2 for v in x}


def test_same_for_any_partitioning(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    a, b = w.fit(df.repartition(1)), w.fit(df.repartition(13))
    assert a.trace == b.trace and a.rest == b.rest
    assert np.array_equal(a.components, b.components) and np.array_equal(a.eigenvalues, b.eigenvalues)
