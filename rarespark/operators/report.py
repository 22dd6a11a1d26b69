"""Report rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def model_barplot_data(rows: DataFrame, metrics: Sequence[str] = ("f1_macro", "auprc", "mcc")) -> DataFrame:
    """Long chart table ``(model, metric, value)``."""
    cells = [F.col(m).cast("double").alias(m) for m in metrics]
    return rows.select("model", *cells).unpivot(["model"], list(metrics), "metric", "value")


def run_summary(train: DataFrame, test: DataFrame, features: Sequence[str], target: str = "y") -> DataFrame:
    """One row: shapes, class counts, class weight and missing shares, from one pass."""
    width = len(features) + 1
    both = train.select(F.lit(1).alias("_train"), target, *features).unionByName(
        test.select(F.lit(0).alias("_train"), target, *features)
    )
    t = F.col("_train") == 1

    def n_train(condition):
        return F.count(F.when(t & condition, 1))

    row = both.agg(
        F.count(F.when(t, 1)).alias("train_rows"),
        F.count(F.when(~t, 1)).alias("test_rows"),
        n_train(F.col(target) == 1).alias("n_pos"),
        n_train(F.col(target) == 0).alias("n_neg"),
        *[n_train(F.col(c).isNull()).alias(f"_m_{c}") for c in features],
    )
    shares = [F.col(f"_m_{c}") / F.col("train_rows") for c in features]
    mean = sum(shares[1:], shares[0]) / len(features)
    many = sum(((s > 0.5).cast("int") for s in shares[1:]), (shares[0] > 0.5).cast("int"))
    return row.select(
        "train_rows",
        "test_rows",
        F.lit(width).alias("columns"),
        "n_pos",
        "n_neg",
        F.round(F.col("n_pos") / F.col("train_rows") * 100, 2).alias("pos_pct"),
        F.round(F.col("n_neg") / F.greatest(F.col("n_pos"), F.lit(1)), 1).alias("scale_pos_weight"),
        F.round(mean * 100, 2).alias("mean_missing_pct"),
        many.alias("features_with_missing_gt50pct"),
    )


def full_summary(summary: DataFrame, vif: DataFrame, models: DataFrame, limit: float = 5.0) -> DataFrame:
    """``run_summary``'s row with the number of inflated features and the models' metrics,
    ``models`` being ``(model, f1_macro, auprc, mcc)``: an array in the order of names."""
    high = vif.agg(F.count(F.when(F.col("vif") > limit, 1)).alias("features_high_vif"))
    rows = models.agg(F.sort_array(F.collect_list(F.struct("model", "f1_macro", "auprc", "mcc"))).alias("model_metrics"))
    return summary.withColumn("features_high_vif", high.scalar()).withColumn("model_metrics", rows.scalar())
