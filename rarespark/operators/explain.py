"""Tree attributions and the reports built on a long table ``(row_id, feature, phi)``."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from rarespark.functions.small import broadcast_if_small
from rarespark.operators.boosting import BoostedModel, Tree

TOP_BARS = 15
TOP_POINTS = 20
TOP_EXAMPLE = 12
#: Leaves in one table, and cells (rows x leaves) evaluated at once.
LEAVES = 4096
BLOCK_CELLS = 1 << 18


def leaf_rules(tree: Tree) -> list[tuple[float, dict[int, list[float]]]]:
    """Per leaf: its value, and per feature on its path ``[low, high, share]``.

    A row meets the feature's conditions if ``low <= x < high``; ``share`` is the part of
    the training cover that follows the path where that feature is asked.
    """
    rules = []
    work: list[tuple[int, dict[int, list[float]]]] = [(1, {})]
    while work:
        node, path = work.pop()
        f = int(tree.feature[node])
        if f < 0:
            rules.append((float(tree.value[node]), path))
            continue
        low, high, share = path.get(f, [-np.inf, np.inf, 1.0])
        whole = tree.cover[2 * node] + tree.cover[2 * node + 1]
        cut = tree.cut[node]
        for child, ends in ((2 * node, [low, min(high, cut)]), (2 * node + 1, [max(low, cut), high])):
            part = tree.cover[child] / whole if whole > 0 else 0.5
            work.append((child, {**path, f: [*ends, share * part]}))
    return rules


def expected_margin(model: BoostedModel) -> float:
    """Cover-weighted mean margin: the attribution base."""
    total = model.base_margin
    for tree in model.trees:
        for value, path in leaf_rules(tree):
            total += value * float(np.prod([p[2] for p in path.values()]))
    return total


@dataclass(frozen=True)
class Paths:
    """Leaves whose paths ask the same number of features, as arrays ``(features, leaves)``."""

    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    value: np.ndarray

    def attributions(self, x: np.ndarray) -> np.ndarray:
        """Shapley values of a batch of rows, summed over the leaves.

        On one leaf the game is a product over the path's features: 1 or 0 for a known
        feature, its cover share for an unknown one. The weights of the subsets are Beta
        integrals, so a feature's value is the integral over t of the product of
        ``t met + (1 - t) share`` of the others, a polynomial that Gauss's rule integrates
        exactly.
        """
        m = len(self.feature)
        met = []
        for f, low, high in zip(self.feature, self.low, self.high, strict=True):
            v = x[:, f]
            met.append(((v >= low) & (v < high)).astype(float))
        total = [0.0] * m
        at, weight = np.polynomial.legendre.leggauss((m + 1) // 2)
        for t, w in zip((at + 1) / 2, weight / 2, strict=True):
            part = [t * k + (1 - t) * share for k, share in zip(met, self.share, strict=True)]
            behind = [np.array(w)]
            for u in range(m - 1, 0, -1):
                behind.append(behind[-1] * part[u])
            ahead = np.array(1.0)
            for u in range(m):
                total[u] = total[u] + ahead * behind[m - 1 - u]
                ahead = ahead * part[u]
        phi = np.zeros(x.shape)
        for f, k, share, rest in zip(self.feature, met, self.share, total, strict=True):
            order = np.argsort(f, kind="stable")
            first = np.flatnonzero(np.diff(f[order], prepend=-1))
            gain = (self.value * (k - share) * rest)[:, order]
            phi[:, f[order][first]] += np.add.reduceat(gain, first, axis=1)
        return phi


def leaf_paths(model: BoostedModel) -> list[Paths]:
    """All leaves of a model by the number of features on their paths, ``LEAVES`` at most in one
    table."""
    held: dict[int, list] = {}
    for tree in model.trees:
        for value, path in leaf_rules(tree):
            if path and value != 0.0:
                held.setdefault(len(path), []).append((value, path))
    out = []
    for _, rules in sorted(held.items()):
        for k in range(0, len(rules), LEAVES):
            part = rules[k : k + LEAVES]
            ends = np.array([list(path.values()) for _, path in part]).transpose(2, 1, 0)
            feature = np.array([list(path) for _, path in part]).T
            out.append(Paths(feature, *ends, np.array([value for value, _ in part])))
    return out


def shapley_values(paths: Sequence[Paths], x: np.ndarray) -> np.ndarray:
    """Exact path-dependent Shapley values of a batch, many leaves and rows at a time."""
    phi = np.zeros(x.shape)
    for p in paths:
        step = max(1, BLOCK_CELLS // len(p.value))
        for lo in range(0, len(x), step):
            phi[lo : lo + step] += p.attributions(x[lo : lo + step])
    return phi


def tree_shap(model: BoostedModel, df: DataFrame, keep: Sequence[str] = ("row_id", "y")) -> DataFrame:
    """``(keep..., feature, value, phi)``; the rows' features must be imputed. The leaves, whose
    number follows the trees, are broadcast."""
    held = df.sparkSession.sparkContext.broadcast(leaf_paths(model))
    names = model.features

    @F.pandas_udf("array<double>")
    def attribution(*series):
        import pandas as pd

        return pd.Series(list(shapley_values(held.value, np.column_stack(series).astype(float))))

    values = F.array(*[F.col(c).cast("double") for c in names])
    wide = df.select(*keep, values.alias("_v"), attribution(*[F.col(c) for c in names]).alias("_phi"))
    labels = F.array(*[F.lit(c) for c in names])
    return wide.select(*keep, F.explode(F.arrays_zip(labels.alias("feature"), F.col("_v"), F.col("_phi"))).alias("c")).select(
        *keep, F.col("c.feature"), F.col("c._v").alias("value"), F.col("c._phi").alias("phi")
    )


def shap_importance(phi: DataFrame, top: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Mean absolute attribution per feature, largest first."""
    table = phi.groupBy(*by, "feature").agg(F.avg(F.abs("phi")).alias("mean_abs"))
    if not by:
        return table.orderBy(F.desc("mean_abs"), "feature").limit(top)
    order = Window.partitionBy(*by).orderBy(F.desc("mean_abs"), "feature")
    return table.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= top).drop("_r")


def shap_summary_points(phi: DataFrame, top: int = TOP_POINTS, id_col: str = "row_id") -> DataFrame:
    """Attribution and value of every row for the most important features."""
    best = shap_importance(phi, top).select("feature")
    return phi.join(F.broadcast(best), "feature", "left_semi").select(id_col, "feature", "phi", "value")


def shap_dependence(phi: DataFrame, top: int = 5, id_col: str = "row_id") -> DataFrame:
    return shap_summary_points(phi, top, id_col).select(id_col, "feature", "value", "phi")


def confusion_examples(scored: DataFrame, id_col: str = "row_id", score: str = "proba", threshold: float = 0.5) -> DataFrame:
    """First row of each kind of outcome but true negatives."""
    guess = F.col(score) >= threshold
    kind = (
        F.when((F.col("y") == 1) & guess, "TP")
        .when((F.col("y") == 0) & guess, "FP")
        .when((F.col("y") == 1) & ~guess, "FN")
    )
    return scored.withColumn("kind", kind).where("kind is not null").groupBy("kind").agg(F.min(id_col).alias(id_col))


def shap_waterfall(
    phi: DataFrame, examples: DataFrame, base: float = 0.0, top: int = TOP_EXAMPLE, id_col: str = "row_id"
) -> DataFrame:
    """Contributions of each example row, largest first, the rest in one line, and the
    running margin from ``base``."""
    rows = phi.join(broadcast_if_small(examples.select(id_col).distinct()), id_col)
    order = Window.partitionBy(id_col).orderBy(F.desc(F.abs("phi")), "feature")
    ranked = rows.withColumn("_r", F.row_number().over(order))
    step = F.least(F.col("_r"), F.lit(top + 1)).alias("step")
    lines = ranked.groupBy(id_col, step).agg(
        F.when(F.min("_r") <= top, F.min("feature")).otherwise("other").alias("feature"),
        F.sum("phi").alias("phi"),
    )
    upto = Window.partitionBy(id_col).orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("margin", F.sum("phi").over(upto) + base)


def shap_stability(phi: DataFrame, fold: str = "fold") -> DataFrame:
    """Spread over folds of the mean absolute attribution of one fitted model.

    It measures how the population varies between folds, not how refits vary. A feature
    is stable if its spread is below the median importance.
    """
    folds = phi.groupBy("feature", fold).agg(F.avg(F.abs("phi")).alias("m"))
    spread = folds.groupBy("feature").agg(F.stddev_pop("m").alias("std_across_folds"))
    overall = phi.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs"))
    # one value per feature
    middle = overall.agg(F.percentile("mean_abs", F.lit(0.5)).alias("m"))
    return (
        overall.join(spread, "feature")
        .withColumn("stable", F.col("std_across_folds") < middle.scalar())
    )
