from __future__ import annotations

import itertools

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from rarespark.functions import losses
from rarespark.operators import boosting, correlation, explain, folds, prep, profile, search, training
from rarespark.plans.fixtures import FEATURES
from rarespark.sources import tables


@pytest.fixture(scope="module")
def filled(sensor_pdf):
    df, pdf = sensor_pdf
    medians = prep.fit_medians(df, FEATURES)
    return prep.median_impute(df, medians, FEATURES), pdf.fillna(medians)


def test_prepare_matches_numpy_and_survives_saving(spark, sensor_pdf, tmp_path):
    df, pdf = sensor_pdf
    df = df.withColumn("empty", F.lit(None).cast("double")).withColumn("flat", F.lit(2.0))
    model = Pipeline(stages=[prep.Prepare(inputCols=[*FEATURES, "empty", "flat"])]).fit(df)
    tables.save_model(model, str(tmp_path / "m"))
    for m in (model, tables.load_model(str(tmp_path / "m"))):
        out = m.transform(df).select("row_id", vector_to_array("features").alias("f")).toPandas().sort_values("row_id")
        got = np.stack(out["f"])
        x = pdf.sort_values("row_id")[FEATURES]
        x = x.fillna(x.median())
        want = (x - x.mean()) / x.std(ddof=0)
        assert got.shape[1] == 7  # the empty feature is dropped
        assert np.allclose(got[:, :6], want) and np.allclose(got[:, 6], 0.0)


def test_vif_matches_regressions(spark, filled):
    df, pdf = filled
    got = {r["feature"]: r["vif"] for r in correlation.vif(df, FEATURES).collect()}
    for c in FEATURES:
        others = pdf[[f for f in FEATURES if f != c]].assign(one=1.0).to_numpy()
        fit = others @ np.linalg.lstsq(others, pdf[c], rcond=None)[0]
        r2 = 1 - ((pdf[c] - fit) ** 2).sum() / ((pdf[c] - pdf[c].mean()) ** 2).sum()
        assert got[c] == pytest.approx(1 / (1 - r2), rel=1e-6)


def test_pruning_stops_below_the_limit(spark, filled):
    df, _ = filled
    df = df.withColumn("twin", F.col("f_qty") * 2)
    steps = correlation.prune_by_vif(df, [*FEATURES, "twin"], 5.0).collect()
    gone = {r["feature"] for r in steps}
    assert gone & {"twin", "f_qty"} and steps[0]["vif"] == float("inf")
    left = [c for c in [*FEATURES, "twin"] if c not in gone]
    assert correlation.vif(df, left).agg(F.max("vif")).first()[0] < 5


def test_projection_keeps_the_most_variance(spark, filled):
    df, pdf = filled
    ready = prep.Prepare(inputCols=FEATURES).fit(df).transform(df)
    out = profile.project_2d(ready).toPandas()
    z = (pdf[FEATURES] - pdf[FEATURES].mean()) / pdf[FEATURES].std(ddof=0)
    top = np.linalg.svd(z.to_numpy(), compute_uv=False)[:2] ** 2 / len(z)
    assert out[["x1", "x2"]].var(ddof=0).to_numpy() == pytest.approx(top, rel=1e-6)


def logistic_objective(x, y, w, c, l1, beta, b):
    m = x @ beta + b
    loss = np.logaddexp(0, m) - y * m
    return c * (w * loss).sum() + (1 - l1) / 2 * (beta**2).sum() + l1 * np.abs(beta).sum()


def test_elastic_net_reaches_the_optimum(spark, sensor_pdf):
    df, pdf = sensor_pdf
    c, l1 = 0.05, 0.5
    fit = training.fit_elastic_net(df, FEATURES, c, l1).stages[-1]
    x = pdf[FEATURES].fillna(pdf[FEATURES].median())
    x = ((x - x.mean()) / x.std(ddof=0)).to_numpy()
    y = pdf["y"].to_numpy()
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    beta, b = np.zeros(6), 0.0
    step = 1.0 / (c * 0.25 * np.linalg.norm(np.column_stack([x, np.ones(len(x))]) * np.sqrt(w)[:, None], 2) ** 2 + 1)
    for _ in range(4000):
        r = c * w * (1 / (1 + np.exp(-(x @ beta + b))) - y)
        g = x.T @ r + (1 - l1) * beta
        beta = beta - step * g
        beta = np.sign(beta) * np.maximum(np.abs(beta) - step * l1, 0)
        b -= step * r.sum()
    want = logistic_objective(x, y, w, c, l1, beta, b)
    got = logistic_objective(x, y, w, c, l1, fit.coefficients.toArray(), fit.intercept)
    assert got == pytest.approx(want, rel=1e-4)
    assert fit.coefficients.toArray() == pytest.approx(beta, abs=2e-2)


def test_grid_and_cross_validator(spark, sensor_pdf):
    df, _ = sensor_pdf
    rows = folds.stratified_folds(df, 2).persist()
    grid = training.grid_search(rows, FEATURES, (0.1, 1.0), (0.0,)).collect()
    assert len(grid) == 2 and grid[0]["mcc_mean"] >= grid[1]["mcc_mean"]
    lr = LogisticRegression(labelCol="y", maxIter=5)
    cv = CrossValidator(
        estimator=Pipeline(stages=[prep.Prepare(inputCols=FEATURES), lr]),
        estimatorParamMaps=ParamGridBuilder().addGrid(lr.regParam, [0.0, 0.1]).build(),
        evaluator=training.ScoreEvaluator("auprc"),
        foldCol="fold",
        numFolds=2,
    )
    assert len(cv.fit(rows).avgMetrics) == 2
    assert not training.ScoreEvaluator("cost").isLargerBetter()


def test_forest_and_persistence(spark, sensor_pdf, tmp_path):
    df, _ = sensor_pdf
    model = training.fit_random_forest(df, FEATURES, trees=5, depth=4)
    leaves = training.leaf_table(training.forest_leaves(model, df))
    assert leaves.count() == 5 * df.count()
    tables.save_model(model, str(tmp_path / "rf"))
    a = training.score_models({"m": model}, df).orderBy("row_id").collect()
    b = training.score_models({"m": tables.load_model(str(tmp_path / "rf"))}, df).orderBy("row_id").collect()
    assert a == b


# --- boosting ------------------------------------------------------------------------


def numpy_stump(x, g, h, lam, alpha, mcw):
    def t(v):
        return np.sign(v) * max(abs(v) - alpha, 0.0)

    best = (0.0, None, None)
    for f in range(x.shape[1]):
        for cut in np.unique(x[:, f])[1:]:
            left = x[:, f] < cut
            gl, hl, gr, hr = g[left].sum(), h[left].sum(), g[~left].sum(), h[~left].sum()
            if min(hl, hr) < mcw:
                continue
            gain = 0.5 * (t(gl) ** 2 / (hl + lam) + t(gr) ** 2 / (hr + lam) - t(gl + gr) ** 2 / (hl + hr + lam))
            if gain > best[0] + 1e-9:
                best = (gain, f, cut)
    return best


@pytest.fixture(scope="module")
def small(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 12, (400, 3)).astype(float)
    y = ((x[:, 0] > 6) & (rng.random(400) < 0.8) | (x[:, 1] < 2)).astype(int)
    rows = [(i, int(y[i]), *map(float, x[i])) for i in range(400)]
    return spark.createDataFrame(rows, "row_id bigint, y int, a double, b double, c double"), x, y


COLS = ["a", "b", "c"]


@pytest.mark.parametrize("alpha", [0.0, 3.0])
def test_stump_matches_numpy(spark, small, alpha):
    df, x, y = small
    params = boosting.BoostParams(rounds=1, depth=1, reg_alpha=alpha, eta=0.5)
    tree = boosting.boosted_trees_fit(df, COLS, params, losses.logistic(3.0)).trees[0]
    w = np.where(y == 1, 3.0, 1.0)
    g, h = w * (0.5 - y), w * 0.25
    gain, f, cut = numpy_stump(x, g, h, 1.0, alpha, 1.0)
    assert (tree.feature[1], tree.cut[1]) == (f, cut)
    assert tree.gain[1] == pytest.approx(gain)
    left = x[:, f] < cut
    for node, side in ((2, left), (3, ~left)):
        top = np.sign(g[side].sum()) * max(abs(g[side].sum()) - alpha, 0)
        assert tree.value[node] == pytest.approx(-0.5 * top / (h[side].sum() + 1.0))
        assert tree.cover[node] == pytest.approx(h[side].sum())


def test_boosting_does_not_depend_on_partitions(spark, small):
    df, x, y = small
    params = boosting.BoostParams(rounds=3, depth=3, subsample=0.8, colsample=0.7)
    a = boosting.boosted_trees_fit(df.repartition(1), COLS, params)
    b = boosting.boosted_trees_fit(df.repartition(8), COLS, params)
    assert boosting.tree_margins(a.trees, x) == pytest.approx(boosting.tree_margins(b.trees, x))


def test_bin_bounds_of_many_rows_do_not_depend_on_partitions(spark):
    df = spark.range(70_000).selectExpr(
        "exp(rand(3) * 12) as wide", "cast(id % 7 as double) as few", "if(id % 3 = 0, 5.0D, randn(4)) as hot", "1.0D as one"
    )
    pdf = df.toPandas()
    df = spark.createDataFrame(pdf)
    names = ["wide", "few", "hot", "one"]
    a = boosting.bin_edges(df.repartition(1), names, 64)
    assert a == boosting.bin_edges(df.repartition(11), names, 64)
    assert a[1] == [1.0, 2.0, 3.0, 4.0, 5.0, 6.0] and a[3] == []
    counts = np.histogram(pdf["wide"], [-np.inf, *a[0], np.inf])[0]
    assert len(a[0]) > 55 and counts.max() < 2.5 * len(pdf) / 64
    assert set(a[0]) <= set(pdf["wide"])


def test_loss_falls_and_table_round_trips(spark, small, tmp_path):
    df, x, y = small
    last = np.log(2)
    params = boosting.BoostParams(rounds=12, depth=2)
    model = boosting.boosted_trees_fit(df, COLS, params, valid=df)
    for loss in model.round_losses:
        assert loss < last
        last = loss
    m = boosting.tree_margins(model.trees, x)
    assert last == pytest.approx((np.logaddexp(0, m) - y * m).mean())
    model.table(spark).write.parquet(str(tmp_path / "trees"))
    again = boosting.BoostedModel.from_table(spark.read.parquet(str(tmp_path / "trees")), COLS)
    rows = again.transform(df).orderBy("row_id").collect()
    assert [r["margin"] for r in rows] == pytest.approx(list(m))


def test_early_stop_keeps_the_best_round(spark, small):
    df, x, y = small
    wrong = df.withColumn("y", 1 - F.col("y"))  # every tree makes it worse
    model = boosting.boosted_trees_fit(df, COLS, boosting.BoostParams(rounds=9, depth=2), valid=wrong, patience=2)
    assert len(model.trees) == 1 and len(model.round_losses) == 3


def test_focal_gradients_by_hand(spark):
    df = spark.createDataFrame([(0.0, 1), (2.0, 0), (-40.0, 1)], "m double, y int")
    g, h = losses.focal()(F.col("m"), F.col("y"))
    got = df.select(g.alias("g"), h.alias("h")).collect()
    assert got[0]["g"] == pytest.approx(0.25 * 0.25 * -0.5) and got[0]["h"] == pytest.approx(0.25 * 0.25 * 0.25)
    p = 1 / (1 + np.exp(-2.0))
    assert got[1]["g"] == pytest.approx(0.75 * p**2 * p)
    assert got[2]["h"] == 1e-6


def plain_boosting(x, y, fit_rows, params, objective):
    """Level by level on plain arrays, every value a bin."""
    margin = np.full(len(x), params.base_margin)
    for _ in range(params.rounds):
        g, h = objective.arrays(margin, y.astype(float))
        nodes = [np.arange(len(x))]
        for _ in range(params.depth):
            grown = []
            for rows in nodes:
                mine = rows[fit_rows[rows]]
                gain, f, cut = numpy_stump(x[mine], g[mine], h[mine], params.reg_lambda, params.reg_alpha, params.min_child_weight)
                if gain <= boosting.MIN_GAIN:
                    grown.append(rows)
                else:
                    grown += [rows[x[rows, f] < cut], rows[x[rows, f] >= cut]]
            nodes = grown
        for rows in nodes:
            mine = rows[fit_rows[rows]]
            top = np.sign(g[mine].sum()) * max(abs(g[mine].sum()) - params.reg_alpha, 0)
            margin[rows] -= params.eta * top / (h[mine].sum() + params.reg_lambda)
    return margin


@pytest.mark.parametrize("budget", [boosting.HISTOGRAM_BYTES, 2000])
@pytest.mark.parametrize("partial", [boosting.PARTIAL_BYTES, 0])
def test_fits_that_share_passes_match_plain_boosting(spark, small, monkeypatch, budget, partial):
    """Fits of other depths, rounds and folds in one batch; with sums kept for siblings and in
    several passes, added up on the driver and by Spark."""
    monkeypatch.setattr(boosting, "HISTOGRAM_BYTES", budget)
    monkeypatch.setattr(boosting, "PARTIAL_BYTES", partial)
    df, x, y = small
    rows = df.withColumn("fold", (F.col("row_id") % 3).cast("int"))
    fold = np.arange(len(x)) % 3
    fits = [
        boosting.Fit(boosting.BoostParams(rounds=2, depth=3, eta=0.7), losses.logistic(2.0), 0),
        boosting.Fit(boosting.BoostParams(rounds=3, depth=2, reg_alpha=0.5, min_child_weight=4.0), losses.logistic(), 1),
        boosting.Fit(boosting.BoostParams(rounds=1, depth=1, base_margin=0.3, min_child_weight=0.01), losses.focal(), 2),
        boosting.Fit(boosting.BoostParams(rounds=2, depth=2), losses.logistic(), None),
    ]
    models = boosting.boosted_fits(rows.repartition(4), COLS, fits, fold_col="fold")
    for fit, model in zip(fits, models, strict=True):
        seen = np.ones(len(x), bool) if fit.fold is None else fold != fit.fold
        want = plain_boosting(x, y, seen, fit.params, fit.objective)
        got = boosting.tree_margins(model.trees, x) + fit.params.base_margin
        assert got == pytest.approx(want, abs=1e-9)
    counts = {r["fit"]: r for r in boosting.out_of_fold_counts(rows, COLS, fits[:3]).collect()}
    for k, fit in enumerate(fits[:3]):
        held = fold == fit.fold
        hit = plain_boosting(x, y, ~held, fit.params, fit.objective)[held] >= 0
        assert (counts[k]["tp"], counts[k]["fp"]) == ((hit & (y[held] == 1)).sum(), (hit & (y[held] == 0)).sum())
        assert counts[k]["fn"] + counts[k]["tn"] == (~hit).sum()


def test_gaps_get_the_medians_of_the_fold(spark, small):
    df, x, y = small
    gap = df.withColumn("a", F.when(F.col("row_id") % 4 != 0, F.col("a"))).withColumn("fold", (F.col("row_id") % 2).cast("int"))
    medians = search.fold_medians(gap, COLS)
    for k in (0, 1):
        other = np.array([v for i, v in enumerate(x[:, 0]) if i % 4 and i % 2 != k])
        assert medians[k]["a"] == np.median(other)
    fit = boosting.Fit(boosting.BoostParams(rounds=2, depth=2), losses.logistic(), 1)
    model = boosting.boosted_fits(gap, COLS, [fit], fold_col="fold", fills=medians)[0]
    filled = x.copy()
    filled[::4, 0] = medians[1]["a"]
    want = plain_boosting(filled, y, np.arange(len(x)) % 2 == 0, fit.params, fit.objective)
    assert boosting.tree_margins(model.trees, filled) == pytest.approx(want, abs=1e-9)


def test_trials_resume(spark, sensor_pdf, tmp_path):
    df, _ = sensor_pdf
    rows = folds.stratified_folds(df, 2)
    space = {**search.SPACE, "max_depth": (1, 1), "n_estimators": (1, 1)}
    path = str(tmp_path / "log")
    first = search.hyperparam_trials(rows, FEATURES, path, 1, ["weighted"], space=space, bins=8).collect()
    both = search.hyperparam_trials(rows, FEATURES, path, 2, ["weighted"], space=space, bins=8).collect()
    assert len(first) == 1 and len(both) == 2
    assert [r for r in both if r["trial"] == 0] == first


# --- attributions --------------------------------------------------------------------


def known_margin(tree, x, known):
    """Expected value of a tree when only the features in ``known`` are known."""

    def walk(node):
        f = int(tree.feature[node])
        if f < 0:
            return tree.value[node]
        if f in known:
            return walk(2 * node + int(x[f] >= tree.cut[node]))
        a, b = tree.cover[2 * node], tree.cover[2 * node + 1]
        return (a * walk(2 * node) + b * walk(2 * node + 1)) / (a + b)

    return walk(1)


def test_attributions_are_shapley_values(spark, small):
    df, x, y = small
    model = boosting.boosted_trees_fit(df, COLS, boosting.BoostParams(rounds=3, depth=4))
    phi = explain.tree_shap(model, df).toPandas().pivot(index="row_id", columns="feature", values="phi")[COLS].to_numpy()
    margins = boosting.tree_margins(model.trees, x)
    assert phi.sum(axis=1) + explain.expected_margin(model) == pytest.approx(margins)
    from math import factorial

    for i in range(0, 400, 40):
        for j in range(3):
            want = 0.0
            others = [f for f in range(3) if f != j]
            for k in range(3):
                for s in itertools.combinations(others, k):
                    weight = factorial(k) * factorial(2 - k) / factorial(3)
                    for t in model.trees:
                        want += weight * (known_margin(t, x[i], {*s, j}) - known_margin(t, x[i], set(s)))
            assert phi[i, j] == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("depth", [1, 2, 5, 8])
def test_attributions_of_many_leaves_add_up(depth, monkeypatch):
    """Leaves in several tables, rows in several blocks, paths that ask a feature twice."""
    rng = np.random.default_rng(depth)
    trees = []
    for _ in range(6):
        tree = boosting.Tree(depth)
        inner, leaves = np.arange(1, 2**depth), np.arange(2**depth, 2 ** (depth + 1))
        tree.feature[inner], tree.cut[inner] = rng.integers(0, 4, len(inner)), rng.random(len(inner))
        tree.value[leaves], tree.cover[leaves] = rng.normal(size=len(leaves)), rng.integers(1, 9, len(leaves))
        for i in inner[::-1]:
            tree.cover[i] = tree.cover[2 * i] + tree.cover[2 * i + 1]
        trees.append(tree)
    model = boosting.BoostedModel(list("abcd"), trees)
    x = rng.random((40, 4))
    whole = explain.shapley_values(explain.leaf_paths(model), x)
    assert whole.sum(axis=1) + explain.expected_margin(model) == pytest.approx(boosting.tree_margins(trees, x))
    monkeypatch.setattr(explain, "LEAVES", 7)
    monkeypatch.setattr(explain, "BLOCK_CELLS", 50)
    assert explain.shapley_values(explain.leaf_paths(model), x) == pytest.approx(whole)
    for i in (0, 17):
        for j in range(4):
            want, others = 0.0, [f for f in range(4) if f != j]
            for k in range(4):
                for s in itertools.combinations(others, k):
                    weight = [1 / 4, 1 / 12, 1 / 12, 1 / 4][k]
                    want += weight * sum(known_margin(t, x[i], {*s, j}) - known_margin(t, x[i], set(s)) for t in trees)
            assert whole[i, j] == pytest.approx(want, abs=1e-9)


def test_passes_read_blocks_of_rows(spark, small):
    """A state row holds many rows, and its histograms are plain sums however few rows a node has."""
    df, x, y = small
    edges = boosting.bin_edges(df, COLS, 12)
    state = boosting._start(df.repartition(2), COLS, edges, [0.0], "row_id", "y", None)
    assert state.count() < 40
    rng = np.random.default_rng(1)
    feature, cut = np.full(64, -1), np.zeros(64, int)
    feature[1:20], cut[1:20] = rng.integers(0, 3, 19), rng.integers(0, 8, 19)
    build = tuple(range(32, 42))
    task = boosting._Task(0, boosting.Fit(), np.zeros(3, np.int16), [], 0, 5, feature, cut, np.array([0, 2]), build)
    node = np.ones(len(x), int)
    for _ in range(5):
        f = feature[node]
        node = np.where(f >= 0, 2 * node + (x[np.arange(len(x)), np.maximum(f, 0)] > cut[node]), node)
    found = boosting._histograms(state, [task], 12)
    for i in build:
        for j, f in enumerate((0, 2)):
            mine = node == i
            wanted = np.bincount(x[mine, f].astype(int), 0.5 - y[mine], 12)
            assert np.allclose(found[0, i][0, j] if (0, i) in found else 0.0, wanted)
