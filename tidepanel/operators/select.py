"""Choosing series and slices of a panel or forecast table."""

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.config import DAY, DEFAULTS, KEY, TARGET
from tidepanel.operators.panel import first_cutoff, last_day, train_rows


def keep_series(panel: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of the series listed in ``ids``. Spark broadcasts the list while it is small and AQE splits a busy
    series when it is not."""
    return panel.join(ids.select(KEY), KEY, "left_semi")


def series_totals(panel: DataFrame) -> DataFrame:
    return panel.groupBy(KEY).agg(F.sum(TARGET).alias("total"))


def top_series(panel: DataFrame, n: int = DEFAULTS.micro_series) -> DataFrame:
    """The n series with the largest totals; ties go to the smaller id."""
    return series_totals(panel).orderBy(F.desc("total"), KEY).limit(n)


def top_n_panel(panel: DataFrame, n: int = DEFAULTS.micro_series) -> DataFrame:
    return keep_series(panel, top_series(panel, n))


def training_stats(panel: DataFrame, cutoff: date) -> DataFrame:
    """Per series, over its training rows: first day, share of zero days, total. One pass for all filters."""
    return train_rows(panel, cutoff).groupBy(KEY).agg(
        F.min(DAY).alias("first_day"),
        F.avg(F.when(F.col(TARGET) == 0, 1.0).otherwise(0.0)).alias("zero_share"),
        F.sum(TARGET).alias("total"),
    )


def long_enough(cutoff: date, days: int = DEFAULTS.min_history) -> Column:
    return F.col("first_day") <= F.lit(cutoff - timedelta(days=days))


def rarely_zero(share: float = DEFAULTS.max_zero) -> Column:
    return F.col("zero_share") <= share


def sells() -> Column:
    return F.col("total") > 0


def policy_series(panel: DataFrame, n: int = DEFAULTS.top_series, min_history: int = DEFAULTS.min_history,
                  max_zero: float = DEFAULTS.max_zero, windows: int = DEFAULTS.windows, step: int = DEFAULTS.step,
                  last: date | None = None) -> DataFrame:
    """Series with enough history, few zero days and sales, then the n largest by training total."""
    cutoff = first_cutoff(last or last_day(panel), windows, step)
    kept = training_stats(panel, cutoff).filter(long_enough(cutoff, min_history) & rarely_zero(max_zero) & sells())
    return kept.orderBy(F.desc("total"), KEY).limit(n)


def subset_policy(panel: DataFrame, **settings) -> DataFrame:
    """The full history of the series that ``policy_series`` chooses."""
    return keep_series(panel, policy_series(panel, **settings))


def filter_stage(forecasts: DataFrame, stage: str) -> DataFrame:
    return forecasts.filter(F.col("stage") == stage)


def with_interval(forecasts: DataFrame) -> DataFrame:
    return forecasts.filter(F.col("lo_80").isNotNull() & F.col("hi_80").isNotNull())


def models_with_full_intervals(forecasts: DataFrame) -> DataFrame:
    full = F.bool_and(F.col("lo_80").isNotNull() & F.col("hi_80").isNotNull())
    return forecasts.groupBy("model").agg(full.alias("_full")).filter("_full").select("model")


def latest_slice(forecasts: DataFrame, ids: DataFrame, models: list[str] | None = None, cutoff: date | None = None
                 ) -> DataFrame:
    """Forecasts of the listed series and models at the newest (or given) cutoff."""
    at = F.lit(cutoff) if cutoff else forecasts.agg(F.max("cutoff").alias("c")).scalar()
    out = forecasts.filter(F.col("cutoff") == at)
    if models is not None:
        out = out.filter(F.col("model").isin(*models))
    return keep_series(out, ids).orderBy("model", KEY, DAY)


def lookback_slice(panel: DataFrame, ids: DataFrame, cutoff: date, days: int) -> DataFrame:
    """Actuals of the listed series from ``days`` before the cutoff on."""
    return keep_series(panel.filter(F.col(DAY) >= F.lit(cutoff - timedelta(days=days))), ids).orderBy(KEY, DAY)
