"""Forecast metrics: per-row errors and the pooled aggregates over them.

Pooled means one ratio over all rows of a group, never an average of per-series ratios.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidepanel.config import DEFAULTS
from tidepanel.functions.scalars import ratio


def abs_error(y: Column, y_hat: Column) -> Column:
    return F.abs(y - y_hat)


def signed_error(y: Column, y_hat: Column) -> Column:
    return y_hat - y


def winkler(y: Column, lo: Column, hi: Column, coverage: float = DEFAULTS.coverage) -> Column:
    """Interval width plus a penalty for each side that misses; NULL when a bound is NULL."""
    penalty = 2.0 / (1.0 - coverage)
    below = F.when(y < lo, lo - y).otherwise(0.0)
    above = F.when(y > hi, y - hi).otherwise(0.0)
    return (hi - lo) + penalty * below + penalty * above


def wmape(y: Column, y_hat: Column) -> Column:
    return ratio(F.sum(abs_error(y, y_hat)), F.sum(F.abs(y)))


def bias(y: Column, y_hat: Column) -> Column:
    return ratio(F.sum(signed_error(y, y_hat)), F.sum(y))


def interval_score(y: Column, lo: Column, hi: Column, coverage: float = DEFAULTS.coverage) -> Column:
    """Mean Winkler score; NULL as soon as one row has no interval."""
    complete = (F.count(lo) == F.count(F.lit(1))) & (F.count(hi) == F.count(F.lit(1)))
    return F.when(complete, F.avg(winkler(y, lo, hi, coverage)))


def coverage_rate(y: Column, lo: Column, hi: Column) -> Column:
    """Share of rows inside the closed interval; a row without an interval counts as a miss."""
    return F.avg(F.when((y >= lo) & (y <= hi), 1.0).otherwise(0.0))


def calibration_label(coverage: Column, target: float = DEFAULTS.coverage, tolerance: float = 0.05) -> Column:
    return (
        F.when(F.abs(coverage - target) < tolerance, "green")
        .when(coverage > target, "orange")
        .when(coverage.isNotNull(), "red")
    )
