"""Profiles of features and classes. Per-feature statistics come from one wide
aggregate where the function allows; the result has one row per feature."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import PCA
from pyspark.sql import DataFrame, Window, functions as F

from rarespark.functions.ranks import exact_quantiles

IQR_FACTOR = 1.5
HIGH_MISSING = 50.0


def class_distribution(df: DataFrame, target: str = "y") -> DataFrame:
    counts = df.groupBy(target).agg(F.count("*").alias("rows"))
    whole = Window.partitionBy(F.lit(0))
    return counts.withColumn("pct", F.col("rows") / F.sum("rows").over(whole) * 100).orderBy(target)


def missing_shares(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Per cent missing of every feature: ``(feature, missing_pct)``."""
    row = df.agg(*[(F.count(F.when(F.col(c).isNull(), 1)) / F.count("*") * 100).alias(c) for c in features])
    return row.unpivot([], list(features), "feature", "missing_pct")


def missing_profile(df: DataFrame, features: Sequence[str], top: int = 30) -> DataFrame:
    shares = missing_shares(df, features).where("missing_pct > 0")
    return shares.orderBy(F.desc("missing_pct"), "feature").limit(top)


def missing_summary(df: DataFrame, features: Sequence[str], high: float = HIGH_MISSING) -> DataFrame:
    return missing_shares(df, features).agg(
        F.avg("missing_pct").alias("mean_missing_pct"),
        F.count(F.when(F.col("missing_pct") > high, 1)).alias("features_high"),
    )


def describe_features(df: DataFrame, features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mean, sample deviation, minimum, exact median and maximum per feature."""
    by, features = list(by), list(features)
    stats = [
        F.struct(
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"),
            F.min(c).alias("min"),
            F.max(c).alias("max"),
        ).alias(c)
        for c in features
    ]
    wide = df.groupBy(*by).agg(*stats)
    long = wide.unpivot(by, features, "feature", "s").select(*by, "feature", "s.*")
    medians = exact_quantiles(df, features, [0.5], by).select(
        *by, "feature", F.col("quantile").alias("median")
    )
    return long.join(medians, [*by, "feature"], "left")


def class_mean_delta(df: DataFrame, features: Sequence[str], target: str = "y") -> DataFrame:
    y = F.col(target)
    cells = [
        F.struct(
            F.avg(F.when(y == 0, F.col(c))).alias("mean_neg"), F.avg(F.when(y == 1, F.col(c))).alias("mean_pos")
        ).alias(c)
        for c in features
    ]
    long = df.agg(*cells).unpivot([], list(features), "feature", "s").select("feature", "s.*")
    return long.withColumn("delta", F.col("mean_pos") - F.col("mean_neg"))


def iqr_outliers(df: DataFrame, features: Sequence[str], factor: float = IQR_FACTOR) -> DataFrame:
    """Share of each feature's values outside the quartiles by ``factor`` ranges."""
    quartiles: dict[str, dict[float, float]] = {}
    for r in exact_quantiles(df, features, [0.25, 0.75]).collect():
        quartiles.setdefault(r["feature"], {})[r["prob"]] = r["quantile"]
    cells = []
    for c, q in quartiles.items():
        reach = factor * (q[0.75] - q[0.25])
        low, high = q[0.25] - reach, q[0.75] + reach
        cells.append(
            F.struct(
                F.lit(low).alias("low"),
                F.lit(high).alias("high"),
                F.count(F.when((F.col(c) < low) | (F.col(c) > high), 1)).alias("outliers"),
                F.count(c).alias("present"),
            ).alias(c)
        )
    long = df.agg(*cells).unpivot([], list(quartiles), "feature", "s").select("feature", "s.*")
    return long.withColumn("outlier_pct", F.col("outliers") / F.col("present") * 100)


def class_quantiles(df: DataFrame, features: Sequence[str], target: str = "y") -> DataFrame:
    """Box of a violin: minimum, quartiles and maximum per feature and class."""
    probs = {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}
    rows = exact_quantiles(df, features, list(probs.values()), [target])
    return rows.groupBy("feature", target).agg(
        *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n) for n, p in probs.items()]
    )


def class_density(df: DataFrame, features: Sequence[str], target: str = "y", bins: int = 20) -> DataFrame:
    """Equal-width densities per feature and class, cut at each feature's range."""
    features = list(features)
    row = df.agg(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in features]).first()
    cells = []
    for c in features:
        lo, hi = row[c]["lo"], row[c]["hi"]
        if lo is None:
            continue
        width = (hi - lo) / bins or 1.0
        bin_ = F.least(F.floor((F.col(c) - lo) / width), F.lit(bins - 1)).cast("int")
        bin_ = F.when(F.col(c).isNotNull(), bin_)
        cells.append(F.struct(F.lit(c).alias("feature"), bin_.alias("bin"), F.lit(width).alias("width")))
    counts = (
        df.select(target, F.explode(F.array(*cells)).alias("s"))
        .select(target, "s.*")
        .where("bin is not null")
        .groupBy("feature", target, "bin", "width")
        .agg(F.count("*").alias("rows"))
    )
    whole = Window.partitionBy("feature", target)
    return counts.withColumn(
        "density", F.col("rows") / (F.sum("rows").over(whole) * F.col("width"))
    ).drop("width")


def project_2d(prepared: DataFrame, id_col: str = "row_id", target: str = "y", features: str = "features") -> DataFrame:
    """Two principal components per row. ``prepared`` has a scaled feature vector. Each
    component points to where its largest loading (the first on a tie) is positive."""
    from pyspark.ml.functions import vector_to_array

    model = PCA(k=2, inputCol=features, outputCol="_pc").fit(prepared)
    loadings = model.pc.toArray()
    xy = vector_to_array("_pc")
    axes = []
    for k in range(2):
        largest = loadings[abs(loadings[:, k]).round(9).argmax(), k]
        axes.append((xy[k] if largest >= 0 else -xy[k]).alias(f"x{k + 1}"))
    return model.transform(prepared).select(id_col, target, *axes)
