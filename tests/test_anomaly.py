from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from rarespark.operators import anomaly


def leaf_frame(spark, leaves):
    return spark.createDataFrame(
        [(i, [int(v) for v in r]) for i, r in enumerate(leaves)], "row_id bigint, leaves array<int>"
    )


def test_proximity_matches_brute_force(spark):
    rng = np.random.default_rng(0)
    leaves = rng.integers(0, 4, (60, 5))
    leaves[:25, 0] = 1  # a crowded leaf
    df = leaf_frame(spark, leaves)
    got = {(r["id_a"], r["id_b"]): r["prox"] for r in anomaly.proximity(df.repartition(4)).collect()}
    want = {}
    for i in range(60):
        for j in range(i + 1, 60):
            p = (leaves[i] == leaves[j]).mean()
            if p > 0:
                want[i, j] = p
    assert got == pytest.approx(want)
    full = anomaly.proximity_to_landmarks(df, df.where("row_id < 3"), absent=True)
    assert full.count() == 180
    assert full.where("id_a = id_b and prox <> 1").count() == 0
    d = anomaly.dissimilarity(full)
    assert d.agg(F.max("dissimilarity")).first()[0] == 1.0


def test_landmark_limit(spark, monkeypatch):
    monkeypatch.setattr(anomaly, "MAX_LANDMARKS", 5)
    df = leaf_frame(spark, np.zeros((6, 2)))
    with pytest.raises(ValueError, match="landmarks"):
        anomaly.proximity(df)


def test_embedding_recovers_planted_clusters(spark):
    rng = np.random.default_rng(1)
    group = np.arange(300) % 3
    leaves = group[:, None] * 2 + (rng.random((300, 40)) < 0.1)
    df = leaf_frame(spark, leaves)
    out = anomaly.proximity_embed_2d(df, landmarks=60).toPandas().sort_values("row_id")
    xy = out[["x1", "x2"]].to_numpy()
    centres = np.array([xy[group == g].mean(axis=0) for g in range(3)])
    nearest = ((xy[:, None, :] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (nearest == group).mean() > 0.99
    marks = df.where("row_id < 30").select("row_id", "leaves")
    stress = anomaly.embedding_stress(spark.createDataFrame(out), df, marks).first()["stress"]
    assert 0 < stress < 0.35


def test_isolation_forest_ranks_planted_outliers_first(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1000, 2))
    x[:10] = rng.normal(scale=0.5, size=(10, 2)) + 9.0
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "row_id bigint, x1 double, x2 double")
    out = anomaly.isolation_forest(df, ["x1", "x2"])
    flagged = out.where("is_outlier")
    assert flagged.count() == 50
    top = [r["row_id"] for r in out.orderBy(F.desc("anomaly")).limit(10).collect()]
    assert set(top) == set(range(10))
    one = {r["row_id"]: r["anomaly"] for r in out.collect()}
    two = {r["row_id"]: r["anomaly"] for r in anomaly.isolation_forest(df.repartition(5), ["x1", "x2"]).collect()}
    assert one == pytest.approx(two)


def test_hot_value_in_isolation_forest(spark):
    x = [(i, 0.0 if i % 3 else float(i)) for i in range(900)]
    df = spark.createDataFrame(x, "row_id bigint, v double")
    out = anomaly.isolation_forest(df, ["v"])
    scores = out.where("v = 0").select("anomaly").distinct().count()
    assert scores == 1 and out.where("is_outlier and v = 0").count() == 0


@pytest.mark.parametrize("share", [0.002, 0.3, 1.0])
def test_rows_join_each_tree_with_the_same_chance(share):
    rng = np.random.default_rng(1)
    key = rng.integers(-(2**63), 2**63 - 1, 20_000)
    found = {tree: rows for rows, tree in anomaly.trees_drawn(key, share, 100, 7)}
    sizes = np.array([len(found[t]) for t in range(100)])
    assert len(found) == 100 and all(len(set(rows.tolist())) == len(rows) for rows in found.values())
    spread = np.sqrt(20_000 * share * (1 - share))
    assert abs(sizes.mean() - 20_000 * share) <= 0.5 * spread + 1e-9 and np.abs(sizes - 20_000 * share).max() <= 5 * spread + 1e-9
    half = {tree: rows for rows, tree in anomaly.trees_drawn(key[5000:], share, 100, 7)}
    assert all((found[t][found[t] >= 5000] - 5000).tolist() == half[t].tolist() for t in range(100))
    together = np.mean([len(np.intersect1d(found[t], found[t + 1])) for t in range(99)])
    assert together == pytest.approx(20_000 * share**2, rel=0.15, abs=0.5)


def test_stress_falls_and_a_plane_is_recovered():
    rng = np.random.default_rng(8)
    plane = rng.random((60, 2)) * [3.0, 1.0]
    d = np.sqrt(((plane[:, None] - plane[None]) ** 2).sum(axis=2))
    xy = anomaly.scale_landmarks(d, starts=2)
    assert anomaly._distances(xy, xy) == pytest.approx(d, abs=1e-4)
    rows = rng.random((30, 2)) * [3.0, 1.0]
    far = np.sqrt(((rows[:, None] - plane[None]) ** 2).sum(axis=2))
    placed = anomaly.place_rows(far, xy, np.zeros((30, 2)), 2000)
    assert anomaly._distances(placed, xy) == pytest.approx(far, abs=1e-3)
    noisy = np.abs(d + np.triu(rng.normal(0, 0.4, d.shape), 1) + np.triu(rng.normal(0, 0.4, d.shape), 1).T)
    noisy = (noisy + noisy.T) / 2
    np.fill_diagonal(noisy, 0.0)
    first, _ = anomaly._classical(noisy)
    held = [anomaly.majorise(noisy, first, k)[1] for k in (0, 1, 5, 50)]
    assert held == sorted(held, reverse=True) and held[-1] < 0.95 * held[0]


def test_refined_layout_has_less_stress(spark):
    rng = np.random.default_rng(2)
    group = rng.integers(0, 4, 500)
    leaves = np.where(rng.random((500, 30)) < 0.7, group[:, None], rng.integers(4, 9, (500, 30)))
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(leaves)], "row_id bigint, leaves array<int>")
    from rarespark.operators.folds import simple_sample

    marks = simple_sample(df, 40)
    stress = [
        anomaly.embedding_stress(anomaly.proximity_embed_2d(df, 40, steps=k), df, marks).first()["stress"] for k in (0, 200)
    ]
    assert stress[1] < 0.9 * stress[0]


@pytest.mark.parametrize("n", [0, 1, 2])
def test_layout_of_few_rows(spark, n):
    df = spark.createDataFrame([(i, [i, 1]) for i in range(n)], "row_id bigint, leaves array<int>")
    assert anomaly.proximity_embed_2d(df).count() == n


def test_stress_is_summed_where_the_rows_are(spark):
    """Against plain numpy; no row per row and landmark is made."""
    rng = np.random.default_rng(6)
    leaves, xy = rng.integers(0, 3, (60, 8)), rng.random((60, 2))
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(leaves)], "row_id bigint, leaves array<int>")
    layout = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(xy)], "row_id bigint, x1 double, x2 double")
    out = anomaly.embedding_stress(layout, df, df.where("row_id % 7 = 0"))
    far = 1 - (leaves[:, None] == leaves[None, ::7]).mean(axis=2)
    near = np.sqrt(((xy[:, None] - xy[None, ::7]) ** 2).sum(axis=2))
    assert out.first()["stress"] == pytest.approx(np.sqrt(((near - far) ** 2).sum() / (far**2).sum()))
    assert out._jdf.queryExecution().executedPlan().toString().count("Join") == 1
