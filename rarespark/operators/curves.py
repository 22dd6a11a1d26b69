"""Ranking curves. Rows are grouped by score first, so ties collapse before any shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rarespark.functions.ranks import bucket_count, cut_points, running_totals


def _cumulative(scored: DataFrame, by: Sequence[str], score: str) -> DataFrame:
    """One row per distinct score, best first: own and running counts, and totals."""
    by = list(by)
    rows = scored.where(F.col(score).isNotNull()).select(*by, "y", F.col(score).alias("score"))
    cuts = cut_points(rows, "score", bucket_count(rows))
    groups = rows.groupBy(*by, "score").agg(F.sum("y").alias("pos"), F.count("*").alias("n"))
    summed = running_totals(groups, "score", {"tp": "pos", "m": "n"}, by, descending=True, cuts=cuts)
    return summed.withColumnsRenamed({"tp_all": "p_all", "m_all": "n_all"})


def _d(name: str):
    return F.col(name).cast("double")


def average_precision(scored: DataFrame, by: Sequence[str] = (), score: str = "proba") -> DataFrame:
    """Step-wise area under the precision-recall curve; 0 where no positive exists."""
    steps = _cumulative(scored, by, score).withColumn(
        "_step", F.when(F.col("p_all") > 0, _d("pos") / _d("p_all") * _d("tp") / _d("m")).otherwise(0.0)
    )
    return steps.groupBy(*by).agg(F.sum("_step").alias("auprc"))


def pr_curve(scored: DataFrame, by: Sequence[str] = (), score: str = "proba") -> DataFrame:
    """Precision and recall at each distinct score, and the end point (1, 0).

    The lowest score of a group, which covers all its rows, also emits the end point.
    """
    point = F.struct(
        F.col("score").alias("threshold"),
        (_d("tp") / _d("m")).alias("precision"),
        F.when(F.col("p_all") > 0, _d("tp") / _d("p_all")).otherwise(1.0).alias("recall"),
    )
    end = F.struct(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    last = F.col("m") == F.col("n_all")
    points = F.explode(F.when(last, F.array(point, end)).otherwise(F.array(point)))
    baseline = (_d("p_all") / _d("n_all")).alias("baseline")
    return _cumulative(scored, by, score).select(*by, points.alias("_c"), baseline).select(*by, "_c.*", "baseline")


def roc_curve(scored: DataFrame, by: Sequence[str] = (), score: str = "proba") -> DataFrame:
    """False and true positive rates at each distinct score, starting from (0, 0).

    The highest score of a group also emits the starting point.
    """
    negatives, positives = _d("n_all") - _d("p_all"), _d("p_all")
    point = F.struct(
        F.col("score").alias("threshold"),
        ((_d("m") - _d("tp")) / F.nullif(negatives, F.lit(0.0))).alias("fpr"),
        (_d("tp") / F.nullif(positives, F.lit(0.0))).alias("tpr"),
    )
    start = F.struct(F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    first = F.col("m") == F.col("n")
    points = F.explode(F.when(first, F.array(point, start)).otherwise(F.array(point)))
    return _cumulative(scored, by, score).select(*by, points.alias("_c")).select(*by, "_c.*")


def roc_auc(scored: DataFrame, by: Sequence[str] = (), score: str = "proba") -> DataFrame:
    """Trapezoid area; equals the rank statistic with averaged ties."""
    base = _cumulative(scored, by, score)
    slab = (_d("n") - _d("pos")) * (_d("tp") - _d("pos") / 2.0)
    area = base.groupBy(*by).agg(
        F.sum(slab).alias("_area"), F.max("p_all").alias("_p"), F.max("n_all").alias("_n")
    )
    box = F.nullif(_d("_p") * (_d("_n") - _d("_p")), F.lit(0.0))
    return area.select(*by, (F.col("_area") / box).alias("auc"))
