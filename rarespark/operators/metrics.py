"""Classification metrics, threshold sweeps and model comparison.

Every function takes ``by`` grouping columns, so one query serves any number of
models, splits or folds.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from rarespark.functions import rates
from rarespark.functions.small import broadcast_if_small

# The two threshold grids.
SWEEP_GRID = [float(t) for t in np.arange(0.01, 1.0, 0.01)]
COARSE_GRID = [float(t) for t in np.arange(0.1, 0.91, 0.05)]
METRICS = ("mcc", "f1", "cost")


def apply_threshold(scored: DataFrame, threshold: float | Column, score: str = "proba") -> DataFrame:
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return scored.withColumn("pred", (F.col(score) >= limit).cast("int"))


def confusion(df: DataFrame, by: Sequence[str] = (), y: str = "y", pred: str = "pred") -> DataFrame:
    def cell(label: int, guess: int, name: str) -> Column:
        return F.count(F.when((F.col(y) == label) & (F.col(pred) == guess), 1)).alias(name)

    return df.groupBy(*by).agg(
        cell(1, 1, "tp"), cell(0, 1, "fp"), cell(1, 0, "fn"), cell(0, 0, "tn")
    )


def with_rates(
    counts: DataFrame, cost_fp: int = rates.COST_FP, cost_fn: int = rates.COST_FN
) -> DataFrame:
    return counts.withColumns(
        {
            "precision": rates.precision("tp", "fp"),
            "recall": rates.recall("tp", "fn"),
            "f1_binary": rates.f1("tp", "fp", "fn"),
            "f1_macro": rates.f1_macro("tp", "fp", "fn", "tn"),
            "mcc": rates.mcc("tp", "fp", "fn", "tn"),
            "cost": rates.cost("fp", "fn", cost_fp, cost_fn),
        }
    )


def classification_metrics(df: DataFrame, by: Sequence[str] = (), **costs: int) -> DataFrame:
    """Confusion counts and the rates built on them, one row per group."""
    return with_rates(confusion(df, by), **costs)


def total_cost(df: DataFrame, by: Sequence[str] = (), **costs: int) -> DataFrame:
    return with_rates(confusion(df, by), **costs).select(*by, "fp", "fn", "cost")


def naive_baseline_cost(df: DataFrame, by: Sequence[str] = (), cost_fn: int = rates.COST_FN) -> DataFrame:
    """Cost of always predicting the negative class."""
    positives = F.count(F.when(F.col("y") == 1, 1))
    return df.groupBy(*by).agg(positives.alias("fn"), (positives * cost_fn).alias("cost"))


def threshold_counts(
    scored: DataFrame,
    grid: Sequence[float] = SWEEP_GRID,
    by: Sequence[str] = (),
    score: str = "proba",
) -> DataFrame:
    """Confusion counts at every threshold from one pass over the scores.

    Rows are counted by the number of thresholds they reach, at most one count per grid
    value and group. A count then adds to all thresholds at or below it; threshold 0
    stands for the totals.
    """
    by, grid = list(by), sorted(float(t) for t in grid)
    splits = [-np.inf, *grid, np.inf] if len(grid) > 1 else [-np.inf, grid[0], np.inf]
    cut = Bucketizer(splits=[float(s) for s in splits], inputCol=score, outputCol="_b").transform(
        scored.where(F.col(score).isNotNull())
    )
    counts = cut.groupBy(*by, F.col("_b").cast("int").alias("_b")).agg(
        F.count(F.when(F.col("y") == 1, 1)).alias("pos"), F.count("*").alias("n")
    )
    reached = F.col("_b") >= F.col("_i")
    sums = (
        counts.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(len(grid)))))
        .groupBy(*by, "_i")
        .agg(
            F.sum(F.when(reached, F.col("pos")).otherwise(0)).alias("tp"),
            F.sum(F.when(reached, F.col("n")).otherwise(0)).alias("m"),
        )
    )
    whole = Window.partitionBy(*(by or [F.lit(0)]))
    values = F.array(*[F.lit(t) for t in grid])
    return (
        sums.withColumn("_p", F.max(F.when(F.col("_i") == 0, F.col("tp"))).over(whole))
        .withColumn("_n", F.max(F.when(F.col("_i") == 0, F.col("m"))).over(whole))
        .where("_i > 0")
        .select(
            *by,
            F.element_at(values, F.col("_i")).alias("threshold"),
            "tp",
            (F.col("m") - F.col("tp")).alias("fp"),
            (F.col("_p") - F.col("tp")).alias("fn"),
            (F.col("_n") - F.col("_p") - F.col("m") + F.col("tp")).alias("tn"),
        )
    )


def threshold_sweep(
    scored: DataFrame,
    metric: str = "mcc",
    grid: Sequence[float] = SWEEP_GRID,
    by: Sequence[str] = (),
    score: str = "proba",
) -> DataFrame:
    """``(by..., threshold, score)``; the cost is negated so larger is better."""
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}, expected one of {METRICS}")
    values = {
        "mcc": rates.mcc("tp", "fp", "fn", "tn"),
        "f1": rates.f1_macro("tp", "fp", "fn", "tn"),
        "cost": -rates.cost("fp", "fn").cast("double"),
    }
    counts = threshold_counts(scored, grid, by, score)
    return counts.select(*by, "threshold", values[metric].alias("score"))


def optimal_threshold(sweep: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Best score per group; ties go to the lowest threshold."""
    best = F.max(F.struct("score", (-F.col("threshold")).alias("_neg"))).alias("_best")
    return (
        sweep.groupBy(*by)
        .agg(best)
        .select(*by, (-F.col("_best._neg")).alias("threshold"), F.col("_best.score").alias("score"))
    )


def mcc_cost_grid(
    scored: DataFrame, grid: Sequence[float] = COARSE_GRID, by: Sequence[str] = ()
) -> DataFrame:
    """MCC and cost on the coarse grid, with the best row of each marked."""
    counts = with_rates(threshold_counts(scored, grid, by))
    whole = Window.partitionBy(*(by or [F.lit(0)]))
    best_mcc = F.max(F.struct("mcc", (-F.col("threshold")).alias("t"))).over(whole)
    best_cost = F.min(F.struct("cost", "threshold")).over(whole)
    return counts.select(
        *by,
        "threshold",
        "mcc",
        "cost",
        (-best_mcc["t"] == F.col("threshold")).alias("best_mcc"),
        (best_cost["threshold"] == F.col("threshold")).alias("best_cost"),
    )


def tune_then_evaluate(
    tune: DataFrame, evaluate: DataFrame, metric: str = "mcc", by: Sequence[str] = ("model",)
) -> DataFrame:
    """Choose the threshold of each model on one table, measure it on another."""
    chosen = optimal_threshold(threshold_sweep(tune, metric, by=by), by).select(*by, "threshold")
    # one row per model; the evaluated rows of a model must not meet in one task
    judged = apply_threshold(evaluate.join(broadcast_if_small(chosen), list(by)), F.col("threshold"))
    return classification_metrics(judged, [*by, "threshold"])


def train_test_comparison(
    scored: DataFrame, metric: str = "mcc", splits: Sequence[str] = ("train", "test")
) -> DataFrame:
    """One row per model; each split's metrics side by side, threshold from ``splits[0]``."""
    tuned = scored.where(F.col("split") == splits[0])
    chosen = optimal_threshold(threshold_sweep(tuned, metric, by=["model"]), ["model"])
    chosen = broadcast_if_small(chosen.drop("score"))
    judged = apply_threshold(scored.join(chosen, "model"), F.col("threshold"))
    rows = classification_metrics(judged, ["model", "split"])
    return rows.groupBy("model").pivot("split", list(splits)).agg(
        F.first("f1_macro").alias("f1_macro"), F.first("mcc").alias("mcc"), F.first("cost").alias("cost")
    )


def best_model(rows: DataFrame, by: Sequence[str] = (), metric: str = "mcc") -> DataFrame:
    """Row with the highest metric; ties go to the first name."""
    order = Window.partitionBy(*(by or [F.lit(0)])).orderBy(F.desc_nulls_last(metric), "model")
    if not by:
        return rows.where(F.col(metric).isNotNull()).orderBy(F.desc(metric), "model").limit(1)
    return rows.withColumn("_r", F.row_number().over(order)).where("_r = 1").drop("_r")


def cv_comparison_table(parts: Sequence[DataFrame], metric: str = "mcc_mean") -> tuple[DataFrame, DataFrame]:
    """All per-model rows, and the rows a chart of ``metric`` can show."""
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part, allowMissingColumns=True)
    return table, table.dropna(subset=[metric])


def cv_summary(scored: DataFrame, average_precision: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Mean and population deviation over folds of F1-macro, AUPRC and MCC."""
    by = list(by)
    return fold_summary(classification_metrics(scored, [*by, "fold"]).join(average_precision, [*by, "fold"]), by)


def fold_summary(folds: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """``cv_summary`` of rates that each fold has already."""
    cells = []
    for name in ("f1_macro", "auprc", "mcc"):
        cells += [F.avg(name).alias(f"{name}_mean"), F.stddev_pop(name).alias(f"{name}_std")]
    return folds.groupBy(*by).agg(*cells)


def metrics_report(rows: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Formatted report lines ``(by..., item, text)``."""
    def fixed(name):
        return F.regexp_replace(F.format_number(F.col(name), 4), ",", "")

    lines = rows.select(
        *by,
        *[fixed(c).alias(c) for c in ("f1_macro", "mcc", "precision", "recall", "auprc") if c in rows.columns],
        F.format_number("cost", 0).alias("cost"),
        F.format_string("TP=%d | FP=%d | FN=%d | TN=%d", "tp", "fp", "fn", "tn").alias("counts"),
    )
    names = [c for c in lines.columns if c not in by]
    return lines.unpivot(list(by), names, "item", "text")
