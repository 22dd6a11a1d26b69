"""Fits that folds share: made once, and equal to fits made one by one."""

from __future__ import annotations

import threading

import numpy as np
from pyspark.sql import functions as F

from rarespark.operators import calibration, linear, prep, training


def _rows(spark, n=600):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(n, 2))
    y = (x[:, 0] + rng.normal(size=n) > 1.2).astype(int)
    data = [(i, int(y[i]), float(x[i, 0]), None if i % 50 == 0 else float(x[i, 1]), i % 3) for i in range(n)]
    return spark.createDataFrame(data, "row_id bigint, y int, a double, b double, fold int")


def test_cross_fits_the_folds_once(spark):
    rows = _rows(spark).withColumn("proba", F.lit(1.0) / (1.0 + F.exp(-3.0 * F.col("a"))))
    calls = []

    def rated():
        calls.append(1)
        own = rows.select("row_id", "y", "fold", "proba").withColumn("is_tune", F.lit(True))
        rest = rows.select("row_id", "y", "proba").crossJoin(spark.range(3).select(F.col("id").cast("int").alias("fold")))
        return own.unionByName(rest.withColumn("is_tune", F.lit(False)))

    tune, held = rows.where("row_id % 5 <> 0"), rows.where("row_id % 5 = 0")
    cross = calibration.cross_of(rated)
    a, b, done = calibration.calibrate_if_needed(tune, held, "Elastic Net", limit=0.0, cross=cross)
    assert done and len(calls) == 1
    whole = {r.row_id: r.calibrated for r in calibration.calibrate_across_folds(rated(), "sigmoid").collect()}
    got = [(r.row_id, r.calibrated) for r in a.unionByName(b).collect()]
    assert len(got) == 600 and all(abs(whole[i] - v) < 1e-12 for i, v in got)


def test_oversampling_is_compared_in_few_jobs(spark):
    """Both fits of a fold take some passes, not hundreds, and end where a long Spark fit does."""
    rows = _rows(spark)
    tracker, group = spark.sparkContext.statusTracker(), "imbalance"
    spark.sparkContext.setJobGroup(group, group)
    found = {r.strategy: r for r in training.imbalance_compare(rows, ["a", "b"]).collect()}
    jobs = len(tracker.getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert set(found) == {"class_weight", "smote"} and jobs < 400
    assert all(0.5 < r.f1_macro_mean < 1 and r.mcc_mean > 0.2 for r in found.values())


def test_plain_view_gives_each_row_the_same_weight(spark):
    rows = _rows(spark).na.fill(0.0)
    view = linear.View.plain(2, 600)
    model = linear.linear_fits(rows, ["a", "b"], [linear.Point(1.0, 0.0)], own={None: view})[0]
    data = np.array([(r.y, r.a, r.b) for r in rows.collect()], float)
    x, y = np.column_stack([data[:, 1:], np.ones(600)]), data[:, 0]
    slope = x.T @ (1 / (1 + np.exp(-x @ model.weights)) - y) / 600 + np.append(model.weights[:2], 0.0) / 600
    assert np.abs(slope).max() < 1e-8
    assert len(training.linear.View.plain(2, 600).columns(["a", "b"])) == 2


def test_models_compared_share_the_medians_of_the_folds(spark, monkeypatch):
    """Medians are found once, not for every fold of every model; the fits are those of a fit alone."""
    rows = _rows(spark)
    alone = {
        "Elastic Net": lambda r: training.fit_elastic_net(r, ["a", "b"], 0.1, 0.5, 100),
        "Random Forest": lambda r: training.fit_random_forest(r, ["a", "b"], trees=5, depth=4),
    }
    known = {
        "Elastic Net": lambda r, m: training.fit_elastic_net(r, ["a", "b"], 0.1, 0.5, 100, medians=m),
        "Random Forest": lambda r, m: training.fit_random_forest(r, ["a", "b"], trees=5, depth=4, medians=m),
    }
    want = {r.model: r for r in training.cv_comparison(rows, alone).drop("seconds").collect()}
    calls, plain = [], prep.exact_quantiles
    monkeypatch.setattr(prep, "exact_quantiles", lambda *a, **k: calls.append(1) or plain(*a, **k))
    got = {r.model: r for r in training.cv_comparison(rows, known, features=["a", "b"]).drop("seconds").collect()}
    assert len(calls) == 1 and set(got) == set(want) == set(known)
    for name, row in want.items():
        assert all(abs(row[c] - got[name][c]) < 1e-9 for c in row.asDict() if c != "model")
    assert got["Random Forest"].mcc_mean > 0.2


def test_folds_are_fitted_side_by_side(spark):
    """Two folds' fits wait for each other: they end only if both run at a time."""
    meet = threading.Barrier(2, timeout=60)

    def fit(fit_rows, medians):
        if fit_rows.where("fold = 0").isEmpty() or fit_rows.where("fold = 1").isEmpty():
            meet.wait()
        return training.fit_elastic_net(fit_rows, ["a", "b"], max_iter=20, medians=medians)

    rows = _rows(spark)
    medians = prep.fold_medians(rows, ["a", "b"])
    scores = training.cross_validated_scores(rows, fit, "m", medians=medians, parallelism=2)
    assert sorted((r.row_id, r.fold) for r in scores.collect()) == [(i, i % 3) for i in range(600)]
