"""Rates derived from confusion counts; 0/0 counts as 0."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Cost of a needless check and of a missed failure.
COST_FP = 10
COST_FN = 500


def _d(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top / F.nullif(bottom, F.lit(0.0)))


def precision(tp, fp) -> Column:
    return ratio(_d(tp), _d(tp) + _d(fp))


def recall(tp, fn) -> Column:
    return ratio(_d(tp), _d(tp) + _d(fn))


def f1(tp, fp, fn) -> Column:
    return ratio(2 * _d(tp), 2 * _d(tp) + _d(fp) + _d(fn))


def f1_macro(tp, fp, fn, tn) -> Column:
    """Mean F1 over the classes that occur among labels or predictions."""
    has_pos = (_d(tp) + _d(fp) + _d(fn) > 0).cast("double")
    has_neg = (_d(tn) + _d(fp) + _d(fn) > 0).cast("double")
    return ratio(f1(tp, fp, fn) + f1(tn, fn, fp), has_pos + has_neg)


def mcc(tp, fp, fn, tn) -> Column:
    top = _d(tp) * _d(tn) - _d(fp) * _d(fn)
    bottom = (
        F.sqrt(_d(tp) + _d(fp))
        * F.sqrt(_d(tp) + _d(fn))
        * F.sqrt(_d(tn) + _d(fp))
        * F.sqrt(_d(tn) + _d(fn))
    )
    return ratio(top, bottom)


def cost(fp, fn, cost_fp: int = COST_FP, cost_fn: int = COST_FN) -> Column:
    return (F.col(fp) * cost_fp + F.col(fn) * cost_fn).cast("bigint")
