"""Isotonic and logistic maps against plain numpy."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rarespark.operators import calibration, isotonic


def plain_blocks(x, s, w):
    """Fit at each knot, by whole-number pooling from left to right."""
    blocks = []
    for k in range(len(x)):
        blocks.append([int(s[k]), int(w[k]), 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            b, a = blocks.pop(), blocks.pop()
            blocks.append([a[0] + b[0], a[1] + b[1], a[2] + b[2]])
    return np.repeat([a / b for a, b, _ in blocks], [n for *_, n in blocks])


def frame(spark, x, y, **more):
    return spark.createDataFrame(pd.DataFrame({"row_id": np.arange(len(x)), "proba": x, "y": y, **more}))


def shapes(rng, n):
    x = rng.random(n)
    yield "noisy", x, rng.random(n) < x
    yield "falling", x, rng.random(n) < 1 - x
    yield "saw", x, rng.random(n) < (3 * x) % 1
    yield "ties", np.round(x, 1), rng.random(n) < 0.5
    yield "split", x, x > 0.4


@pytest.mark.parametrize("shape", range(5))
@pytest.mark.parametrize("open_blocks", [1, isotonic.OPEN_BLOCKS])
def test_matches_plain_pooling(spark, monkeypatch, shape, open_blocks):
    monkeypatch.setattr(isotonic, "OPEN_BLOCKS", open_blocks)
    _, x, y = list(shapes(np.random.default_rng(shape), 3000))[shape]
    df = frame(spark, x, y.astype(int))
    model = calibration.isotonic_fit(df)
    knots = pd.DataFrame({"x": x, "y": y}).groupby("x")["y"].agg(["sum", "count"])
    want = plain_blocks(knots.index, knots["sum"].to_numpy(), knots["count"].to_numpy())
    ask = np.concatenate([knots.index, (knots.index[:-1] + knots.index[1:]) / 2, [-1.0, 2.0]])
    asked = spark.createDataFrame([(i, float(v)) for i, v in enumerate(ask)] + [(-1, None)], "row_id long, proba double")
    small = asked_values(calibration.isotonic_apply(asked, model))
    assert small.pop(-1) is None
    assert np.allclose([small[i] for i in range(len(ask))], np.interp(ask, knots.index, want), atol=1e-12)
    large = asked_values(isotonic._apply_large(asked, model, "proba", "calibrated"))
    assert large.pop(-1) is None
    assert large == pytest.approx(small, abs=1e-12)


def asked_values(df):
    return {r.row_id: r.calibrated for r in df.select("row_id", "calibrated").collect()}


def test_a_million_knots(spark):
    n = 1_000_000
    df = spark.range(n).select(
        F.col("id").alias("row_id"),
        (F.pmod(F.xxhash64("id"), F.lit(1 << 50)) / float(1 << 50)).alias("proba"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 50)) / float(1 << 50)).alias("u"),
    ).withColumn("y", (F.col("u") < F.col("proba") * F.col("proba")).cast("int"))
    pdf = df.select("proba", "y").toPandas().groupby("proba")["y"].agg(["sum", "count"])
    assert len(pdf) > 0.99 * n
    want = plain_blocks(pdf.index, pdf["sum"].to_numpy(), pdf["count"].to_numpy())
    got = calibration.isotonic_apply(df, calibration.isotonic_fit(df)).select("proba", "calibrated").toPandas()
    assert np.allclose(got.sort_values("proba")["calibrated"], want, atol=1e-12)


def test_groups_are_fitted_together(spark):
    rng = np.random.default_rng(9)
    x, fold = rng.random(900).round(2), rng.integers(0, 3, 900)
    y = (rng.random(900) < np.where(fold == 1, 1 - x, x)).astype(int)
    df = frame(spark, x, y, fold=fold)
    model = isotonic.isotonic_fit(df, by=["fold"])
    both = [isotonic.isotonic_apply(df, model), isotonic._apply_large(df, model, "proba", "calibrated")]
    maps = calibration.platt_maps(df, by=["fold"])
    logistic = asked_values(calibration.platt_apply_maps(df, maps, ["fold"]))
    for k in range(3):
        own = df.where(F.col("fold") == k)
        alone = asked_values(isotonic.isotonic_apply(own, isotonic.isotonic_fit(own)))
        for table in both:
            assert asked_values(table.where(F.col("fold") == k)) == pytest.approx(alone, abs=1e-12)
        single = calibration.platt_fit(own)
        assert (single.slope, single.intercept) == pytest.approx((maps[(k,)].slope, maps[(k,)].intercept), rel=1e-9)
        mine = asked_values(calibration.platt_apply(own, single))
        assert {i: logistic[i] for i in mine} == pytest.approx(mine, abs=1e-12)


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_platt_does_not_depend_on_the_partitioning(spark, parts):
    rng = np.random.default_rng(2)
    x = rng.random(4000)
    y = (rng.random(4000) < 0.05 + 0.4 * x).astype(int)
    model = calibration.platt_fit(frame(spark, x, y).repartition(parts))
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    gap = 1 / (1 + np.exp(-(model.slope * x + model.intercept))) - target
    assert max(abs(gap.mean()), abs((gap * x).mean())) < 1e-12


def test_hard_cases(spark):
    flat = calibration.platt_fit(frame(spark, np.full(10, 0.3), np.arange(10) % 2))
    assert 1 / (1 + np.exp(-(0.3 * flat.slope + flat.intercept))) == pytest.approx(0.5)
    apart = calibration.platt_fit(frame(spark, np.arange(20) / 2.0, (np.arange(20) >= 10).astype(int)))
    assert np.isfinite([apart.slope, apart.intercept]).all() and apart.slope > 0
    wide = calibration.platt_fit(frame(spark, np.array([-27.0, -5, 0, 5, 27] * 8), np.array([0, 0, 1, 0, 1] * 8)))
    assert np.isfinite([wide.slope, wide.intercept]).all()
    none = frame(spark, np.array([0.5]), np.array([1])).where("false")
    assert calibration.platt_fit(none) == calibration.PlattMap(0.0, 0.0)
    rows = frame(spark, np.array([0.5]), np.array([1]))
    assert calibration.isotonic_apply(rows, calibration.isotonic_fit(none)).first()["calibrated"] is None


@pytest.mark.parametrize("method", ["sigmoid", "isotonic"])
def test_calibration_across_folds(spark, method):
    rng = np.random.default_rng(6)
    n = 600
    x, fold = rng.random(n), np.arange(n) % 3
    y = (rng.random(n) < x**2).astype(int)
    train, test = frame(spark, x, y, fold=fold), frame(spark, x[:50], y[:50], fold=fold[:50])

    def fit_and_score(fit_rows, rows):
        return rows.withColumn("proba", F.col("proba") * 0.9 + 0.05)

    got = asked_values(calibration.cv_calibration(train, test, fit_and_score, method, 3))
    total = np.zeros(50)
    for k in range(3):
        own = train.where(F.col("fold") == k).withColumn("proba", F.col("proba") * 0.9 + 0.05)
        apply = calibration.calibrator(own, method, on_margin=method == "sigmoid")
        total += [v for _, v in sorted(asked_values(apply(test.withColumn("proba", F.col("proba") * 0.9 + 0.05))).items())]
    assert [v for _, v in sorted(got.items())] == pytest.approx(list(total / 3), abs=1e-12)
