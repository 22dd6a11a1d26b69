"""Imputation, scaling, weights and the train-only preparation chain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from rarespark.functions.ranks import exact_quantiles

# Positive-class weights tried beside the data's own ratio.
WEIGHT_CANDIDATES = (10, 30, 77)


def fit_medians(train: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """Exact medians; a feature with no value at all is absent from the result."""
    rows = exact_quantiles(train, features, [0.5]).collect()
    found = {r["feature"]: r["quantile"] for r in rows}
    return {c: found[c] for c in features if c in found}


def fold_medians(train: DataFrame, features: Sequence[str], fold_col: str = "fold") -> dict[int, dict[str, float]]:
    """Per fold, exact medians of the rows of all others, in one plan."""
    folds = sorted(r[0] for r in train.select(fold_col).distinct().collect())
    others = F.filter(F.array(*[F.lit(i) for i in folds]), lambda i: i != F.col(fold_col))
    found: dict[int, dict[str, float]] = {i: {} for i in folds}
    for r in exact_quantiles(train, features, [0.5], [fold_col], others).collect():
        found[r["pool"]][r["feature"]] = r["quantile"]
    return found


def median_impute(df: DataFrame, medians: dict[str, float], features: Sequence[str]) -> DataFrame:
    """Fill gaps; drop features that had no median."""
    empty = [c for c in features if c not in medians]
    return df.drop(*empty).withColumns({c: F.coalesce(F.col(c), F.lit(m)) for c, m in medians.items()})


def fit_scale(df: DataFrame, features: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation; a constant feature is divided by 1."""
    row = df.agg(
        *[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in features]
    ).first()
    return {c: (row[c]["m"], row[c]["s"] or 1.0) for c in features}


def standard_scale(df: DataFrame, scale: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - m) / s for c, (m, s) in scale.items()})


class _PrepareParams(Params):
    inputCols = Param(Params._dummy(), "inputCols", "feature columns", TypeConverters.toListString)
    outputCol = Param(Params._dummy(), "outputCol", "vector column", TypeConverters.toString)
    scaling = Param(Params._dummy(), "scaling", "divide by the deviation", TypeConverters.toBoolean)

    def __init__(self):
        super().__init__()
        self._setDefault(outputCol="features", scaling=True)


class Prepare(Estimator, _PrepareParams, DefaultParamsReadable, DefaultParamsWritable):
    """Median imputation, then scaling, then a feature vector; fitted on train rows only."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol="features", scaling=True):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> PrepareModel:
        return self.fit_known(dataset, fit_medians(dataset, self.getOrDefault("inputCols")))

    def fit_known(self, dataset: DataFrame, medians: dict[str, float]) -> PrepareModel:
        """As ``fit``, with the medians of ``dataset`` known already."""
        features = self.getOrDefault("inputCols")
        kept = [c for c in features if c in medians]
        if self.getOrDefault("scaling"):
            scale = fit_scale(median_impute(dataset, medians, features), kept)
        else:
            scale = {c: (0.0, 1.0) for c in kept}
        model = PrepareModel()
        model._set(
            inputCols=features,
            outputCol=self.getOrDefault("outputCol"),
            scaling=self.getOrDefault("scaling"),
            kept=kept,
            medians=[medians[c] for c in kept],
            means=[scale[c][0] for c in kept],
            deviations=[scale[c][1] for c in kept],
        )
        return model


class PrepareModel(Model, _PrepareParams, DefaultParamsReadable, DefaultParamsWritable):
    kept = Param(Params._dummy(), "kept", "features with a value", TypeConverters.toListString)
    medians = Param(Params._dummy(), "medians", "fill values", TypeConverters.toListFloat)
    means = Param(Params._dummy(), "means", "centres", TypeConverters.toListFloat)
    deviations = Param(Params._dummy(), "deviations", "divisors", TypeConverters.toListFloat)

    def values(self, dataset: DataFrame) -> DataFrame:
        """Imputed and scaled feature columns in place of the raw ones."""
        names = self.getOrDefault("kept")
        fills = dict(zip(names, self.getOrDefault("medians")))
        filled = median_impute(dataset, fills, self.getOrDefault("inputCols"))
        pairs = zip(self.getOrDefault("means"), self.getOrDefault("deviations"))
        return standard_scale(filled, dict(zip(names, pairs))) if self.getOrDefault("scaling") else filled

    def _transform(self, dataset: DataFrame) -> DataFrame:
        names = self.getOrDefault("kept")
        inner = [f"_in_{c}" for c in names]
        cells = {}
        for c, fill, mean, dev in zip(
            names, self.getOrDefault("medians"), self.getOrDefault("means"), self.getOrDefault("deviations")
        ):
            cells[f"_in_{c}"] = (F.coalesce(F.col(c), F.lit(fill)) - F.lit(mean)) / F.lit(dev)
        assembler = VectorAssembler(inputCols=inner, outputCol=self.getOrDefault("outputCol"))
        return assembler.transform(dataset.withColumns(cells)).drop(*inner)


def class_counts(df: DataFrame, target: str = "y") -> dict[int, int]:
    return {r[target]: r["count"] for r in df.groupBy(target).count().collect()}


def weighted_rows(prepared: DataFrame, counts: dict[int, int], target: str = "y") -> DataFrame:
    """``(y, weight, features)`` for a fit, with balanced weights from known counts."""
    n = sum(counts.values())
    weight = F.lit(None).cast("double")
    for label, c in counts.items():
        weight = F.when(F.col(target) == label, F.lit(n / (2.0 * c))).otherwise(weight)
    return prepared.select(target, weight.alias("weight"), "features")


def pos_weight(df: DataFrame, target: str = "y") -> DataFrame:
    """Negatives per positive, and the weights a search tries."""
    row = df.agg(F.sum(F.col(target)).alias("pos"), F.count("*").alias("n"))
    ratio = (F.col("n") - F.col("pos")) / F.nullif(F.col("pos"), F.lit(0))
    low, mid, high = WEIGHT_CANDIDATES
    return row.select(
        ratio.alias("ratio"),
        F.array(F.lit(low), F.lit(mid), F.round(ratio).cast("int"), F.lit(high)).alias("candidates"),
    )


def balanced_class_weight(df: DataFrame, target: str = "y", out: str = "weight") -> DataFrame:
    """Weight n / (2 n_class) per row; the class counts are two rows."""
    counts = df.groupBy(target).agg(F.count("*").alias("_c"))
    total = counts.agg(F.sum("_c")).scalar()
    weights = counts.select(target, (F.lit(total) / (F.col("_c") * 2.0)).alias(out))
    return df.join(F.broadcast(weights), target)
