from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rarespark.operators import calibration, curves, explain, metrics, search


def scored(spark, rows):
    return spark.createDataFrame([(i, y, float(p)) for i, (y, p) in enumerate(rows)], "row_id int, y int, proba double")


def counts_at(rows, t):
    tp = sum(1 for y, p in rows if p >= t and y)
    fp = sum(1 for y, p in rows if p >= t and not y)
    fn = sum(1 for y, p in rows if p < t and y)
    return tp, fp, fn, len(rows) - tp - fp - fn


def mcc(tp, fp, fn, tn):
    bottom = math.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    return (tp * tn - fp * fn) / bottom if bottom else 0.0


def test_single_class_has_four_counts(spark):
    row = metrics.classification_metrics(metrics.apply_threshold(scored(spark, [(0, 0.1), (0, 0.2)]), 0.5)).first()
    assert (row["tp"], row["fp"], row["fn"], row["tn"]) == (0, 0, 0, 2)
    assert row["mcc"] == 0.0 and row["precision"] == 0.0 and row["recall"] == 0.0
    assert row["f1_macro"] == 1.0  # only class 0 occurs


def test_sweep_matches_brute_force_on_grid_values(spark):
    rng = np.random.default_rng(0)
    rows = [(int(rng.random() < 0.2), p) for p in [*metrics.SWEEP_GRID, 0.0, 1.0, 0.29, 0.57, 0.58, *rng.random(200)]]
    df = scored(spark, rows)
    got = {r["threshold"]: r for r in metrics.threshold_counts(df).collect()}
    assert sorted(got) == metrics.SWEEP_GRID
    for t, r in got.items():
        assert (r["tp"], r["fp"], r["fn"], r["tn"]) == counts_at(rows, t)
    best = metrics.optimal_threshold(metrics.threshold_sweep(df, "mcc")).first()
    values = [mcc(*counts_at(rows, t)) for t in metrics.SWEEP_GRID]
    assert best["threshold"] == metrics.SWEEP_GRID[int(np.argmax(values))]


def test_thresholds_above_all_scores_are_present(spark):
    got = metrics.threshold_counts(scored(spark, [(1, 0.05), (0, 0.02)])).orderBy("threshold").collect()
    assert len(got) == 99
    assert (got[-1]["tp"], got[-1]["fp"], got[-1]["fn"], got[-1]["tn"]) == (0, 0, 1, 1)


def test_ties_go_to_the_lowest_threshold(spark):
    sweep = spark.createDataFrame([(0.1, 1.0), (0.2, 2.0), (0.3, 2.0)], "threshold double, score double")
    assert metrics.optimal_threshold(sweep).first()["threshold"] == 0.2


def test_unknown_metric(spark):
    with pytest.raises(ValueError, match="unknown metric"):
        metrics.threshold_sweep(scored(spark, [(1, 0.5)]), "accuracy")


def test_best_model_ties_and_nulls(spark):
    rows = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", None)], "model string, mcc double")
    assert metrics.best_model(rows).first()["model"] == "a"


ROWS = [(1, 0.9), (0, 0.9), (1, 0.8), (0, 0.4), (0, 0.4), (1, 0.4), (0, 0.1)]


@pytest.mark.parametrize("parts", [1, 8])
def test_curves_with_ties(spark, parts):
    df = scored(spark, ROWS).repartition(parts)
    ap, last = 0.0, 0.0
    for t in sorted({p for _, p in ROWS}, reverse=True):
        tp, fp, fn, _ = counts_at(ROWS, t)
        ap += (tp / (tp + fn) - last) * tp / (tp + fp)
        last = tp / (tp + fn)
    assert curves.average_precision(df).first()["auprc"] == pytest.approx(ap)
    wins = sum((p > q) + 0.5 * (p == q) for y, p in ROWS for z, q in ROWS if y and not z)
    assert curves.roc_auc(df).first()["auc"] == pytest.approx(wins / 12)
    points = curves.pr_curve(df).collect()
    assert len(points) == 5 and sum(r["threshold"] is None for r in points) == 1
    assert {round(r["baseline"], 9) for r in points} == {round(3 / 7, 9)}
    assert curves.roc_curve(df).where("fpr = 0 and tpr = 0").count() == 1


def test_no_positive_row(spark):
    df = scored(spark, [(0, 0.2), (0, 0.4)])
    assert curves.average_precision(df).first()["auprc"] == 0.0
    assert curves.roc_auc(df).first()["auc"] is None


def test_bin_rules(spark):
    df = scored(spark, [(0, 0.0), (1, 0.1), (1, 0.3), (1, 0.30000000000000004), (0, 0.7), (1, 1.0)])
    upper = {r["bin"]: r["rows"] for r in calibration.reliability_curve(df).collect()}
    assert upper == {1: 2, 3: 2, 7: 1, 10: 1}
    lower = {r["bin"]: r["rows"] for r in calibration.score_histogram(df).collect()}
    assert lower == {0: 1, 1: 1, 2: 1, 3: 1, 6: 1, 9: 1}
    edges = np.linspace(0, 1, 11)
    y = np.array([0, 1, 1, 1, 0, 1])
    p = np.array([0.0, 0.1, 0.3, 0.30000000000000004, 0.7, 1.0])
    want = 0.0
    for lo, hi in zip(edges[:-1], edges[1:]):
        inside = (p > lo) & (p <= hi)
        if inside.any():
            want += inside.sum() / len(p) * abs(y[inside].mean() - p[inside].mean())
    assert calibration.ece(df).first()["ece"] == pytest.approx(want)


def pava(x, y, w):
    blocks = []
    for xi, yi, wi in zip(x, y, w):
        blocks.append([yi, wi, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]])
    return np.concatenate([[v] * n for v, _, n in blocks])


def test_isotonic(spark):
    rng = np.random.default_rng(3)
    p = rng.integers(1, 40, 800) / 50
    y = (rng.random(800) < p).astype(int)
    df = scored(spark, list(zip(y.tolist(), p)))
    model = calibration.isotonic_fit(df)
    x = np.unique(p)
    want = pava(x, [y[p == v].mean() for v in x], [(p == v).sum() for v in x])
    ask = scored(spark, [(0, v) for v in [-1.0, *x, 2.0]])
    got = [r["calibrated"] for r in calibration.isotonic_apply(ask, model).orderBy("row_id").collect()]
    assert got[1:-1] == pytest.approx(list(want))
    assert (got[0], got[-1]) == pytest.approx((want[0], want[-1]))


def test_platt_gradient_vanishes(spark):
    rng = np.random.default_rng(4)
    p = rng.random(600).round(2)
    y = (rng.random(600) < 0.2 + 0.5 * p).astype(int)
    model = calibration.platt_fit(scored(spark, list(zip(y.tolist(), p))))
    a, b = model.slope, model.intercept
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    gap = 1 / (1 + np.exp(-(a * p + b))) - target
    assert abs(gap.mean()) < 1e-12 and abs((gap * p).mean()) < 1e-12


def test_calibrate_only_when_needed(spark):
    good = scored(spark, [(1, 1.0), (0, 0.0)] * 20)
    tune, _, done = calibration.calibrate_if_needed(good, good, "Random Forest")
    assert not done and tune.where("calibrated <> proba").count() == 0
    bad = scored(spark, [(1, 0.2), (0, 0.1)] * 20)
    for model in ("Random Forest", "Elastic Net"):
        _, out, done = calibration.calibrate_if_needed(bad, bad, model)
        assert done
        assert calibration.ece(out, score="calibrated").first()["ece"] < calibration.ece(bad).first()["ece"]


def test_early_stopping_ignores_rounds_after_the_stop(spark):
    losses = [5, 4, 3, 3.5, 3.5, 3.5, 1, 0]
    df = spark.createDataFrame([("s", i, float(v)) for i, v in enumerate(losses)], "study string, round int, loss double")
    row = search.early_stopping(df, 3).first()
    assert (row["best_round"], row["best_loss"], row["stop_round"]) == (2, 3.0, 5)
    row = search.early_stopping(df, 10).first()
    assert (row["best_round"], row["stop_round"]) == (7, 7)


def test_waterfall_adds_up(spark):
    phi = spark.createDataFrame([(1, f"f{i}", float(v)) for i, v in enumerate([3, -5, 1, 0.5, -0.25])], "row_id int, feature string, phi double")
    out = explain.shap_waterfall(phi, spark.createDataFrame([(1,)], "row_id int"), base=2.0, top=2).orderBy("step").collect()
    assert [r["feature"] for r in out] == ["f1", "f0", "other"]
    assert out[-1]["margin"] == pytest.approx(2 - 0.75)


def test_report_format(spark):
    rows = metrics.classification_metrics(metrics.apply_threshold(scored(spark, [(1, 0.1)] * 3 + [(0, 0.9)]), 0.5))
    lines = {r["item"]: r["text"] for r in metrics.metrics_report(rows.withColumn("model", F.lit("m"))).collect()}
    assert lines["cost"] == "1,510" and lines["counts"] == "TP=0 | FP=1 | FN=3 | TN=0"
