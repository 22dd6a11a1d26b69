"""Linear and forest fits, grid search, scoring and scorers for cross-validation."""

from __future__ import annotations

import itertools
import time
from collections.abc import Callable, Sequence
from functools import partial, reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame, functions as F

from rarespark.operators import curves, linear, metrics, neighbors
from rarespark.operators.folds import fold_train_val
from rarespark.operators.prep import Prepare, class_counts, fold_medians, weighted_rows
from rarespark.session import cut_lineage, drop_stage

# Search grids of the linear model.
C_GRID = (0.001, 0.01, 0.1, 1.0, 10.0)
L1_GRID = (0.0, 0.3, 0.5, 0.7, 1.0)
TREES = 500
MAX_DEPTH = 30  # the deepest tree Spark's forest builds
MIN_LEAF = 5
#: Folds fitted at a time. Spark keeps the rows of each in memory, and on disk what doesn't fit: some
#: 200 bytes a row for 20 trees.
PARALLELISM = 2


def positive_score(df: DataFrame, out: str = "proba") -> DataFrame:
    return df.withColumn(out, vector_to_array("probability")[1])


def elastic_net(rows: int, c: float = 1.0, l1_ratio: float = 0.5, max_iter: int = 5000, tol: float = 1e-6) -> LogisticRegression:
    """Balanced logistic regression. ``c`` divides the penalty of the summed loss, so the
    penalty of Spark's mean loss is 1 / (c rows); balanced weights sum to ``rows``."""
    return LogisticRegression(
        featuresCol="features",
        labelCol="y",
        weightCol="weight",
        elasticNetParam=l1_ratio,
        regParam=1.0 / (c * rows),
        standardization=False,
        maxIter=max_iter,
        tol=tol,
    )


def _prepared(prepare: Prepare, train: DataFrame, medians: dict[str, float] | None):
    return prepare.fit(train) if medians is None else prepare.fit_known(train, medians)


def fit_elastic_net(
    train: DataFrame,
    features: Sequence[str],
    c: float = 1.0,
    l1_ratio: float = 0.5,
    max_iter: int = 5000,
    medians: dict[str, float] | None = None,
) -> PipelineModel:
    """``medians`` are those of ``train``, if known."""
    prep = _prepared(Prepare(inputCols=list(features)), train, medians)
    counts = class_counts(train)
    rows = weighted_rows(prep.transform(train), counts)
    return PipelineModel([prep, elastic_net(sum(counts.values()), c, l1_ratio, max_iter).fit(rows)])


def fit_random_forest(
    train: DataFrame,
    features: Sequence[str],
    trees: int = TREES,
    depth: int = MAX_DEPTH,
    min_leaf: int = MIN_LEAF,
    seed: int = 42,
    medians: dict[str, float] | None = None,
) -> PipelineModel:
    """Balanced forest on imputed, unscaled features; transform also yields ``leaves``.
    ``medians`` are those of ``train``, if known."""
    prep = _prepared(Prepare(inputCols=list(features), scaling=False), train, medians)
    rows = weighted_rows(prep.transform(train), class_counts(train))
    forest = RandomForestClassifier(
        featuresCol="features",
        labelCol="y",
        weightCol="weight",
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=min_leaf,
        leafCol="leaves",
        seed=seed,
    )
    return PipelineModel([prep, forest.fit(rows)])


def forest_leaves(model: PipelineModel, df: DataFrame, id_col: str = "row_id") -> DataFrame:
    """``(id, leaves)``: leaf id per tree."""
    return model.transform(df).select(id_col, vector_to_array("leaves").cast("array<int>").alias("leaves"))


def leaf_table(leaves: DataFrame, id_col: str = "row_id") -> DataFrame:
    return leaves.select(id_col, F.posexplode("leaves").alias("tree", "leaf"))


def score_models(models: dict[str, Model], df: DataFrame, keep: Sequence[str] = ("row_id", "y")) -> DataFrame:
    """Long table ``(keep..., model, proba)``. Each model brings its own preparation."""
    parts = [
        positive_score(model.transform(df)).select(*keep, F.lit(name).alias("model"), "proba")
        for name, model in models.items()
    ]
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table


def grid_search(
    train: DataFrame,
    features: Sequence[str],
    cs: Sequence[float] = C_GRID,
    l1_ratios: Sequence[float] = L1_GRID,
    fold_col: str = "fold",
) -> DataFrame:
    """Cross-validated scores per ``(c, l1_ratio)``, best MCC first. All points and folds are
    fitted together."""
    fold_ids = sorted(r[0] for r in train.select(fold_col).distinct().collect())
    points = [linear.Point(c, l1, i) for c, l1 in itertools.product(cs, l1_ratios) for i in fold_ids]
    models = linear.linear_fits(train, features, points, fold_col)
    rated = metrics.with_rates(linear.out_of_fold_quality(train, models, fold_col))
    keys = ["c", "l1_ratio"]
    return metrics.fold_summary(rated, keys).orderBy(F.desc("mcc_mean"), *keys)


def refit_best(train: DataFrame, features: Sequence[str], grid: DataFrame, max_iter: int = 5000) -> PipelineModel:
    """Model of all train rows at the best point of ``grid_search``'s result."""
    best = grid.orderBy(F.desc("mcc_mean"), "c", "l1_ratio").first()
    return fit_elastic_net(train, features, best["c"], best["l1_ratio"], max_iter)


def cv_comparison(
    train: DataFrame,
    fits: dict[str, Callable[..., Model]],
    fold_col: str = "fold",
    features: Sequence[str] | None = None,
    parallelism: dict[str, int] | None = None,
) -> DataFrame:
    """Fold means and deviations per model, and the seconds its fits and scores took. With
    ``features`` their medians are found once for all folds and models, before the seconds run,
    and a fit gets those of its rows as second argument. ``parallelism`` tells of a model how many
    folds are fitted at a time, ``PARALLELISM`` if not."""
    medians = None if features is None else fold_medians(train, features, fold_col)
    parts = []
    for name, fit in fits.items():
        start = time.perf_counter()
        at_once = (parallelism or {}).get(name, PARALLELISM)
        scores = cross_validated_scores(train, fit, name, fold_col, medians=medians, parallelism=at_once)
        judged = metrics.apply_threshold(scores, 0.5)
        seconds = time.perf_counter() - start
        summary = metrics.cv_summary(judged, curves.average_precision(judged, ["model", "fold"]))
        parts.append(summary.withColumn("seconds", F.lit(seconds)))
    return reduce(DataFrame.unionByName, parts)


def cross_validated_scores(
    train: DataFrame,
    fit: Callable[..., Model],
    model: str,
    fold_col: str = "fold",
    keep: Sequence[str] = ("row_id", "y"),
    medians: dict[int, dict[str, float]] | None = None,
    parallelism: int = PARALLELISM,
) -> DataFrame:
    """Out-of-fold scores ``(keep..., fold, model, proba)``; ``fit`` maps rows to a model, or rows
    and their medians if each fold's ``medians`` are given. ``parallelism`` folds are fitted at a
    time, so that the short jobs of one fill the cores that another's leave idle."""

    def held_out(i) -> DataFrame:
        fit_rows, val_rows = fold_train_val(train, i, fold_col)
        fitted = fit(fit_rows) if medians is None else fit(fit_rows, medians[i])
        rated = positive_score(fitted.transform(val_rows))
        return rated.select(*keep, F.col(fold_col).alias("fold"), F.lit(model).alias("model"), "proba")

    fold_ids = sorted(r[0] for r in train.select(fold_col).distinct().collect())
    tasks = [inheritable_thread_target(train.sparkSession)(partial(held_out, i)) for i in fold_ids]
    with ThreadPool(parallelism) as pool:
        parts = pool.map(lambda task: task(), tasks, chunksize=1)
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return cut_lineage(table, "cv")


def imbalance_compare(
    train: DataFrame, features: Sequence[str], fold_col: str = "fold", k: int = 5, max_iter: int = 200
) -> DataFrame:
    """Class weights against oversampling: fold mean and deviation of F1-macro and MCC.

    The weighted models of all folds are stepped together; each fold's oversampled rows, scaled as
    its weighted model scales them, weigh the same. ``max_iter`` bounds the passes of a fit.
    """
    features = list(features)
    fold_ids = sorted(r[0] for r in train.select(fold_col).distinct().collect())
    weighted = linear.linear_fits(train, features, [linear.Point(1.0, 0.0, i) for i in fold_ids], fold_col, steps=max_iter)
    scores = linear.out_of_fold_scores(train, weighted, fold_col).select("y", "fold", "proba")
    parts = [scores.withColumn("model", F.lit("class_weight"))]
    for i, model in zip(fold_ids, weighted, strict=True):
        fit_rows, val_rows = fold_train_val(train, i, fold_col)
        cells = model.view.columns(features)
        made = neighbors.smote(fit_rows.select("row_id", "y", F.array(*cells).alias("x")), k)
        made = cut_lineage(made.select("y", *[F.col("x")[j].alias(c) for j, c in enumerate(features)]), "smote")
        # the penalty is 1 / (C * rows), and oversampling makes rows
        plain = {None: linear.View.plain(len(features), made.count())}
        oversampled = linear.linear_fits(made, features, [linear.Point(1.0, 0.0)], steps=max_iter, own=plain)[0]
        drop_stage(made)
        proba = F.lit(1.0) / (F.lit(1.0) + F.exp(-oversampled.margin(*cells)))
        parts.append(val_rows.select("y", F.col(fold_col).alias("fold"), proba.alias("proba"), F.lit("smote").alias("model")))
    table = reduce(DataFrame.unionByName, parts)
    judged = metrics.classification_metrics(metrics.apply_threshold(table, 0.5), ["model", "fold"])
    return judged.groupBy(F.col("model").alias("strategy")).agg(
        F.avg("f1_macro").alias("f1_macro_mean"),
        F.stddev_pop("f1_macro").alias("f1_macro_std"),
        F.avg("mcc").alias("mcc_mean"),
        F.stddev_pop("mcc").alias("mcc_std"),
    )


class ScoreEvaluator(Evaluator):
    """Scorer for ``CrossValidator``: mcc, f1_macro, auprc or cost of a probability."""

    metricName = Param(Params._dummy(), "metricName", "metric", TypeConverters.toString)

    def __init__(self, metric: str = "mcc", threshold: float = 0.5, target: str = "y"):
        super().__init__()
        self.threshold, self.target = threshold, target
        self._set(metricName=metric)

    def isLargerBetter(self) -> bool:
        return self.getOrDefault(self.metricName) != "cost"

    def _evaluate(self, dataset: DataFrame) -> float:
        metric = self.getOrDefault(self.metricName)
        scored = positive_score(dataset).withColumn("y", F.col(self.target))
        if metric == "auprc":
            return float(curves.average_precision(scored).first()["auprc"])
        rows = metrics.classification_metrics(metrics.apply_threshold(scored, self.threshold))
        return float(rows.first()[metric])
