"""Exact stratified folds and samples in seeded hash order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rarespark.functions.ranks import shuffled_row_number

SEED = 42
PROXIMITY_ROWS = 5000
SHAP_ROWS = 5000
FOLD_ROWS = 2000


def stratified_folds(
    df: DataFrame, k: int = 5, id_col: str = "row_id", target: str = "y", seed: int = SEED
) -> DataFrame:
    """Add ``fold``; class sizes differ by at most one row between folds."""
    numbered = shuffled_row_number(df, id_col, seed, [target], "_rn")
    return numbered.withColumn("fold", ((F.col("_rn") - 1) % k).cast("int")).drop("_rn")


def fold_train_val(df: DataFrame, fold: int, fold_col: str = "fold") -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(fold_col) != fold), df.where(F.col(fold_col) == fold)


def stratified_sample(
    df: DataFrame, n: int = PROXIMITY_ROWS, id_col: str = "row_id", target: str = "y", seed: int = SEED
) -> DataFrame:
    """Exactly ``n`` rows, positives at their own rate and at least one."""
    counts = df.groupBy(target).agg(F.count("*").alias("c"))
    sizes = counts.agg(
        F.sum(F.when(F.col(target) == 1, F.col("c")).otherwise(0)).alias("p"), F.sum("c").alias("n")
    )
    wanted = F.greatest(F.floor(F.lit(n) * F.col("p") / F.col("n")), F.lit(1))
    positives = sizes.select(F.least(F.col("p"), wanted).cast("bigint")).scalar()
    quota = counts.select(
        target,
        F.when(F.col(target) == 1, F.lit(positives)).otherwise(F.lit(n) - F.lit(positives)).alias("quota"),
    )
    return shuffled_row_number(df, id_col, seed, [target], "_rn", quota).drop("_rn")


def simple_sample(
    df: DataFrame, n: int = SHAP_ROWS, id_col: str = "row_id", seed: int = SEED, by: Sequence[str] = ()
) -> DataFrame:
    """``min(n, rows)`` rows without replacement, per group if ``by`` is given."""
    by = list(by)
    if by:
        quota = df.select(*by).distinct().withColumn("quota", F.lit(n))
    else:
        quota = df.sparkSession.range(1).select(F.lit(n).alias("quota"))
    return shuffled_row_number(df, id_col, seed, by, "_rn", quota).drop("_rn")
