"""Calibration error, reliability tables and calibration maps.

Three bin rules are in use: the error uses (lo, hi] and leaves a score of 0 in no bin,
the reliability table puts 0 in the first bin, the histogram uses [lo, hi) with the last
bin closed.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from rarespark.operators import metrics
from rarespark.operators.isotonic import isotonic_apply, isotonic_fit
from rarespark.session import cut_lineage

# Fixed value: calibrate above this error.
MAX_ECE = 0.05
NEWTON_STEPS = 60


def _upper_bin(p: Column, n: int) -> Column:
    """1-based bin of (lo, hi]; 0 for a score of 0. Edges are multiples of 1/n, and the
    division is corrected where rounding puts a score across an edge."""
    step = F.lit(1.0 / n)
    b = F.ceil(p * n)
    b = F.when(p > b * step, b + 1).when(p <= (b - 1) * step, b - 1).otherwise(b)
    return F.least(b, F.lit(n)).cast("int")


def ece(scored: DataFrame, bins: int = 10, by: Sequence[str] = (), score: str = "proba") -> DataFrame:
    """Weighted gap between positive share and mean score. Every row counts in the
    weight, also those that fall in no bin."""
    by = list(by)
    sums = (
        scored.groupBy(*by, _upper_bin(F.col(score), bins).alias("_b"))
        .agg(F.count("*").alias("_n"), F.sum("y").alias("_y"), F.sum(score).alias("_p"))
    )
    gap = F.when((F.col("_b") > 0), F.abs(F.col("_y") - F.col("_p"))).otherwise(0.0)
    return sums.groupBy(*by).agg((F.sum(gap) / F.sum("_n")).alias("ece"))


def reliability_curve(
    scored: DataFrame, bins: int = 10, by: Sequence[str] = (), score: str = "proba"
) -> DataFrame:
    bin_ = F.greatest(_upper_bin(F.col(score), bins), F.lit(1))
    return scored.groupBy(*by, bin_.alias("bin")).agg(
        F.count("*").alias("rows"), F.avg(score).alias("mean_score"), F.avg("y").alias("positive_share")
    )


def score_histogram(
    scored: DataFrame, bins: int = 10, by: Sequence[str] = (), score: str = "proba"
) -> DataFrame:
    p, step = F.col(score), F.lit(1.0 / bins)
    b = F.floor(p * bins)
    b = F.when(p < b * step, b - 1).when(p >= (b + 1) * step, b + 1).otherwise(b)
    inside = scored.where((p >= 0) & (p <= 1))
    return inside.groupBy(*by, F.least(b, F.lit(bins - 1)).cast("int").alias("bin")).agg(
        F.count("*").alias("rows")
    )


@dataclass(frozen=True)
class PlattMap:
    """Logistic map of a score."""

    slope: float
    intercept: float


def _newton_sums(pooled: DataFrame, maps: dict[tuple, PlattMap], by: Sequence[str]) -> dict[tuple, tuple]:
    """Per group loss, gradient and curvature in one aggregate; the groups' maps are a table
    of a row each."""
    spark = pooled.sparkSession
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in pooled.schema.fields if f.name in by]
    table = spark.createDataFrame([(*k, m.slope, m.intercept) for k, m in maps.items()], ", ".join([*kinds, "_a double", "_b double"]))
    same = [pooled[c].eqNullSafe(table[c]) for c in by]
    rows = pooled.join(F.broadcast(table), same, "inner") if by else pooled.crossJoin(F.broadcast(table))
    margin = F.col("_a") * F.col("_x") + F.col("_b")
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
    gap, bend = (p - F.col("_t")) * F.col("_n"), p * (1 - p) * F.col("_n")
    loss = F.greatest(margin, F.lit(0.0)) - margin * F.col("_t") + F.log1p(F.exp(-F.abs(margin)))
    x = F.col("_x")
    sums = rows.groupBy(*[pooled[c] for c in by]).agg(
        *[F.sum(v).alias(f"_s{i}") for i, v in enumerate((loss * F.col("_n"), gap * x, gap, bend * x * x, bend * x, bend))]
    )
    return {tuple(r[c] for c in by): tuple(r[f"_s{i}"] for i in range(6)) for r in sums.collect()}


def platt_maps(
    scored: DataFrame, score: str = "proba", by: Sequence[str] = (), steps: int = NEWTON_STEPS, tol: float = 1e-12
) -> dict[tuple, PlattMap]:
    """Logistic maps of the score with Platt's smoothed targets, one per group ``by``.

    Rows are pooled by score and class once. Each of Newton's steps is one aggregate for all
    groups; the driver solves for two numbers a group, until the gradient is ``tol`` of the
    rows. A step that does not lower the loss is halved. Scores that are all alike get the
    slope 0. Groups are few: folds and models.
    """
    by = list(by)
    rows = scored.where(F.col(score).isNotNull() & F.col("y").isNotNull())
    pooled = rows.groupBy(*by, F.col(score).cast("double").alias("_x"), "y").agg(F.count("*").alias("_n"))
    pooled = cut_lineage(pooled, "platt")
    sizes = {
        tuple(r[c] for c in by): (r["_p"], r["_q"])
        for r in pooled.groupBy(*by).agg(F.sum(F.col("y") * F.col("_n")).alias("_p"), F.sum((1 - F.col("y")) * F.col("_n")).alias("_q")).collect()
        if r["_p"] is not None
    }
    if sizes:  # the targets need the group's class counts: a table of a row per group
        kinds = [f"{f.name} {f.dataType.simpleString()}" for f in pooled.schema.fields if f.name in by]
        table = [(*k, (p + 1.0) / (p + 2.0), 1.0 / (q + 2.0)) for k, (p, q) in sizes.items()]
        targets = F.broadcast(scored.sparkSession.createDataFrame(table, ", ".join([*kinds, "_hi double", "_lo double"])))
        joined = pooled.join(targets, [pooled[c].eqNullSafe(targets[c]) for c in by], "inner") if by else pooled.crossJoin(targets)
        pooled = joined.select(*[pooled[c] for c in by], "_x", "_n", F.when(F.col("y") == 1, F.col("_hi")).otherwise(F.col("_lo")).alias("_t"))
    maps = {k: PlattMap(0.0, math.log((p + 1.0) / (q + 1.0))) for k, (p, q) in sizes.items()}
    done: dict[tuple, PlattMap] = {}
    moves: dict[tuple, tuple] = {}
    for _ in range(steps):
        if not maps:
            break
        for key, (loss, ga, gb, haa, hab, hbb) in _newton_sums(pooled, maps, by).items():
            here, last = maps[key], moves.get(key)
            n = sum(sizes[key])
            if last is not None and not loss <= last[1] + 1e-13 * abs(last[1]):
                start, before, (da, db), share = last
                share /= 2
                moves[key] = (start, before, (da, db), share)
                maps[key] = PlattMap(start.slope + share * da, start.intercept + share * db)
                continue
            move = np.linalg.lstsq(np.array([[haa, hab], [hab, hbb]]), -np.array([ga, gb]), rcond=1e-14)[0]
            moved = PlattMap(here.slope + float(move[0]), here.intercept + float(move[1]))
            if max(abs(ga), abs(gb)) <= tol * n or moved == here:
                maps.pop(key)
                done[key] = moved  # the last step is down to rounding
                continue
            moves[key] = (here, loss, tuple(move), 1.0)
            maps[key] = moved
    return done | maps


def platt_fit(scored: DataFrame, score: str = "proba") -> PlattMap:
    """Platt's map of all rows; no rows give a map to one half."""
    return platt_maps(scored, score).get((), PlattMap(0.0, 0.0))


def platt_apply(scored: DataFrame, model: PlattMap, score: str = "proba", out: str = "calibrated") -> DataFrame:
    margin = F.lit(model.slope) * F.col(score) + F.lit(model.intercept)
    return scored.withColumn(out, F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)))


def platt_apply_maps(
    scored: DataFrame, maps: dict[tuple, PlattMap], by: Sequence[str], score: str = "proba", out: str = "calibrated"
) -> DataFrame:
    """Each row through its group's map."""
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in scored.schema.fields if f.name in by]
    rows = [(*k, m.slope, m.intercept) for k, m in maps.items()]
    table = F.broadcast(scored.sparkSession.createDataFrame(rows, ", ".join([*kinds, "_a double", "_b double"])))
    joined = scored.join(table, [scored[c].eqNullSafe(table[c]) for c in by], "left")
    value = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("_a") * scored[score] + F.col("_b"))))
    return joined.select(*[scored[c] for c in scored.columns], value.alias(out))


Apply = Callable[[DataFrame], DataFrame]


def log_odds(score: Column) -> Column:
    """Margin of a probability; a linear model's own score before the logistic map."""
    p = F.greatest(F.least(score, F.lit(1 - 1e-12)), F.lit(1e-12))
    return F.log(p / (1 - p))


def calibrator(tune: DataFrame, method: str, score: str = "proba", on_margin: bool = False) -> Apply:
    """Map fitted on ``tune``. With ``on_margin`` the sigmoid takes the log-odds, as the
    score of a linear model is one."""
    if method == "isotonic":
        model = isotonic_fit(tune, score)
        return lambda df: isotonic_apply(df, model, score)
    if method == "sigmoid" and on_margin:
        model = platt_fit(tune.withColumn("_margin", log_odds(F.col(score))), "_margin")
        return lambda df: platt_apply(df.withColumn("_margin", log_odds(F.col(score))), model, "_margin").drop("_margin")
    if method == "sigmoid":
        model = platt_fit(tune, score)
        return lambda df: platt_apply(df, model, score)
    raise ValueError(f"unknown method {method!r}")


LINEAR = ("Elastic Net",)
FORESTS = ("Random Forest",)


def method_for(model: str, linear: Sequence[str] = LINEAR) -> str:
    """Platt for linear models, isotonic for forests and boosted trees."""
    return "sigmoid" if model in linear else "isotonic"


def calibrate_across_folds(
    rated: DataFrame,
    method: str,
    fold_col: str = "fold",
    id_col: str = "row_id",
    score: str = "proba",
    tune_col: str = "is_tune",
    on_margin: bool | None = None,
) -> DataFrame:
    """Average over folds of each row's calibrated score: ``(id, y, calibrated)``.

    ``rated`` has a row per fold and row scored by the model that was fitted off the fold:
    the fold's own rows, marked by ``tune_col``, and the rows to evaluate. The maps of all
    folds are fitted together. The sigmoid takes log-odds unless ``on_margin`` is false.
    """
    if method not in ("sigmoid", "isotonic"):
        raise ValueError(f"unknown method {method!r}")
    margin = method == "sigmoid" if on_margin is None else on_margin
    rows = rated.withColumn("_score", log_odds(F.col(score)) if margin else F.col(score))
    tune, rest = rows.where(F.col(tune_col)), rows.where(~F.col(tune_col))
    if method == "isotonic":
        done = isotonic_apply(rest, isotonic_fit(tune, "_score", [fold_col]), "_score")
    else:
        done = platt_apply_maps(rest, platt_maps(tune, "_score", [fold_col]), [fold_col], "_score")
    return done.groupBy(id_col, "y").agg(F.avg("calibrated").alias("calibrated"))


def rated_by_fold(
    train: DataFrame,
    evaluate: DataFrame,
    fit_and_score: Callable[[DataFrame, DataFrame], DataFrame],
    k: int = 5,
    fold_col: str = "fold",
    id_col: str = "row_id",
    score: str = "proba",
) -> DataFrame:
    """Rows for ``calibrate_across_folds`` of a model that is fitted fold by fold."""
    parts = []
    for i in range(k):
        fit_rows = train.where(F.col(fold_col) != i)
        both = train.where(F.col(fold_col) == i).drop(fold_col).withColumn("is_tune", F.lit(True)).unionByName(
            evaluate.drop(fold_col).withColumn("is_tune", F.lit(False))
        )
        rated = fit_and_score(fit_rows, both).select(id_col, "y", "is_tune", score)
        parts.append(rated.withColumn(fold_col, F.lit(i)))
    return cut_lineage(reduce(DataFrame.unionByName, parts), "rated")


def cv_calibration(
    train: DataFrame,
    evaluate: DataFrame,
    fit_and_score: Callable[[DataFrame, DataFrame], DataFrame],
    method: str,
    k: int = 5,
    fold_col: str = "fold",
    id_col: str = "row_id",
    score: str = "proba",
    on_margin: bool | None = None,
) -> DataFrame:
    """``calibrate_across_folds`` for a model that is fitted fold by fold.

    ``fit_and_score(fit_rows, rows)`` returns ``rows`` with a score; one call per fold
    scores the fold and the rows to evaluate together.
    """
    table = rated_by_fold(train, evaluate, fit_and_score, k, fold_col, id_col, score)
    return calibrate_across_folds(table, method, fold_col, id_col, score, "is_tune", on_margin)


def cross_of(rated: Callable[[], DataFrame], id_col: str = "row_id") -> Callable[[str, DataFrame], DataFrame]:
    """``cross`` for ``calibrate_if_needed``, from the rows for ``calibrate_across_folds`` of all
    rows: the folds' models are fitted and score once, whatever rows are asked for."""
    held: list[DataFrame] = []

    def cross(method: str, df: DataFrame) -> DataFrame:
        if not held:
            held.append(rated())
        rest = held[0].where("not is_tune").join(df.select(id_col), id_col, "left_semi")
        return calibrate_across_folds(held[0].where("is_tune").unionByName(rest), method, id_col=id_col)

    return cross


def calibrate_if_needed(
    tune: DataFrame,
    evaluate: DataFrame,
    model: str,
    limit: float = MAX_ECE,
    score: str = "proba",
    cross: Callable[[str, DataFrame], DataFrame] | None = None,
    id_col: str = "row_id",
) -> tuple[DataFrame, DataFrame, bool]:
    """Calibrated tune and evaluation rows if the error on ``evaluate`` is above
    ``limit``, else the scores as they are.

    Linear models and forests are calibrated across folds: ``cross(method, rows)`` gives
    ``(id, calibrated)`` of rows, as ``cv_calibration`` does. Boosted trees, and any model
    without ``cross``, take a map of their scores on ``tune``.
    """
    before = ece(evaluate, score=score).first()["ece"]
    if before <= limit:
        same = F.col(score).alias("calibrated")
        return tune.select("*", same), evaluate.select("*", same), False
    method = method_for(model)
    if cross is not None and model in (*LINEAR, *FORESTS):
        rated = [df.join(cross(method, df).select(id_col, "calibrated"), id_col) for df in (tune, evaluate)]
        return rated[0], rated[1], True
    apply = calibrator(tune, method, score, on_margin=model in LINEAR)
    return apply(tune), apply(evaluate), True


def recalibrated_threshold(tune: DataFrame, evaluate: DataFrame, before: str = "proba", after: str = "calibrated") -> DataFrame:
    """Re-tune the MCC threshold on calibrated scores: evaluation metrics, and the
    calibration error before and after. One row."""
    sweep = metrics.threshold_sweep(tune, "mcc", score=after)
    threshold = metrics.optimal_threshold(sweep).select("threshold")
    judged = evaluate.withColumn("threshold", threshold.scalar())
    row = metrics.classification_metrics(
        metrics.apply_threshold(judged, F.col("threshold"), after), ["threshold"]
    )
    return row.withColumn("ece_before", ece(evaluate, score=before).scalar()).withColumn(
        "ece_after", ece(evaluate, score=after).scalar()
    )


def final_comparison(
    test_rows: DataFrame, ece_before: DataFrame, best: DataFrame, cost_thresholds: DataFrame
) -> DataFrame:
    """Test metrics with calibration error before, after (best model only), and both
    thresholds. ``best`` has ``(model, ece_after)``."""
    return (
        test_rows.join(ece_before.withColumnRenamed("ece", "ece_before"), "model", "left")
        .join(best, "model", "left")
        .join(cost_thresholds, "model", "left")
    )
