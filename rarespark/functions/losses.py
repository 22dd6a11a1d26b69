"""Boosting objectives: margins and labels to gradients and curvatures, as columns and as arrays."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, functions as F

# Fixed values of the focal objective.
GAMMA = 2.0
ALPHA = 0.25
CLIP = 1e-7
MIN_HESS = 1e-6


@dataclass(frozen=True)
class Objective:
    """Gradient and curvature of a loss. ``columns`` serves tables, ``arrays`` the tasks that
    sum histograms; both map ``(margin, y)`` to ``(grad, hess)``."""

    columns: Callable[[Column, Column], tuple[Column, Column]]
    arrays: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]

    def __call__(self, margin: Column, y: Column) -> tuple[Column, Column]:
        return self.columns(margin, y)


def sigmoid(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def sigmoid_of(margin: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -700.0, 700.0)))


def focal(gamma: float = GAMMA, alpha: float = ALPHA) -> Objective:
    """Focal weighting of the logistic gradient. The weight is held constant when
    differentiating, so this is not the full derivative of the focal loss."""

    def columns(margin: Column, y: Column) -> tuple[Column, Column]:
        p = F.greatest(F.least(sigmoid(margin), F.lit(1.0 - CLIP)), F.lit(CLIP))
        hard = F.when(y == 1, F.lit(1.0) - p).otherwise(p)
        weight = F.when(y == 1, F.lit(alpha)).otherwise(F.lit(1.0 - alpha)) * F.pow(hard, F.lit(gamma))
        hess = F.greatest(weight * p * (F.lit(1.0) - p), F.lit(MIN_HESS))
        return weight * (p - y), hess

    def arrays(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = np.clip(sigmoid_of(margin), CLIP, 1.0 - CLIP)
        weight = np.where(y == 1, alpha, 1.0 - alpha) * np.where(y == 1, 1.0 - p, p) ** gamma
        return weight * (p - y), np.maximum(weight * p * (1.0 - p), MIN_HESS)

    return Objective(columns, arrays)


def logistic(scale_pos_weight: float = 1.0) -> Objective:
    def columns(margin: Column, y: Column) -> tuple[Column, Column]:
        p = sigmoid(margin)
        weight = F.when(y == 1, F.lit(float(scale_pos_weight))).otherwise(F.lit(1.0))
        return weight * (p - y), weight * p * (F.lit(1.0) - p)

    def arrays(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = sigmoid_of(margin)
        weight = np.where(y == 1, float(scale_pos_weight), 1.0)
        return weight * (p - y), weight * p * (1.0 - p)

    return Objective(columns, arrays)
