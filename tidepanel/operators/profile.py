"""Tables that describe a panel's health."""

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.config import DAY, DEFAULTS, KEY, TARGET
from tidepanel.functions.ranks import exact_quantiles
from tidepanel.functions.scalars import clip_upper, day_of_week, ratio
from tidepanel.operators.panel import first_cutoff, last_day
from tidepanel.session import settle

LABELS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")


def panel_profile(panel: DataFrame) -> DataFrame:
    """Series, rows and date range. Series are counted from a per-series aggregate, which spreads the distinct."""
    per_series = panel.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("n"), F.min(DAY).alias("lo"), F.max(DAY).alias("hi")
    )
    return per_series.agg(
        F.count(KEY).alias("n_series"),
        F.sum("n").alias("n_rows"),
        F.min("lo").alias("min_ds"),
        F.max("hi").alias("max_ds"),
    )


def panel_readiness(panel: DataFrame, target_series: int, windows: int = DEFAULTS.windows, step: int = DEFAULTS.step,
                    horizon: int = DEFAULTS.horizon, min_history: int = DEFAULTS.min_history) -> DataFrame:
    """Pass/fail rows: enough series, enough days, no nulls."""
    empty = F.col(KEY).isNull() | F.col(DAY).isNull() | F.col(TARGET).isNull()
    per_series = panel.groupBy(KEY).agg(
        F.min(DAY).alias("lo"), F.max(DAY).alias("hi"), F.count_if(empty).alias("nulls")
    )
    whole = per_series.agg(
        F.count(KEY).alias("series"),
        F.datediff(F.max("hi"), F.min("lo")).cast("long").alias("span"),
        F.sum("nulls").alias("nulls"),
    )
    need_series, need_days = 0.95 * target_series, min_history + windows * step + horizon
    checks = F.array(
        F.struct(F.lit("series").alias("check"), F.col("series").alias("value"),
                 (F.col("series") >= need_series).alias("passed")),
        F.struct(F.lit("span_days").alias("check"), F.col("span").alias("value"),
                 (F.col("span") >= need_days).alias("passed")),
        F.struct(F.lit("nulls").alias("check"), F.col("nulls").alias("value"), (F.col("nulls") == 0).alias("passed")),
    )
    return whole.select(F.inline(checks))


def zero_fraction(panel: DataFrame) -> DataFrame:
    """Share of zero days per series."""
    return panel.groupBy(KEY).agg(F.avg(F.when(F.col(TARGET) == 0, 1.0).otherwise(0.0)).alias("zero_fraction"))


def zero_fraction_summary(fractions: DataFrame, threshold: float = 0.30) -> DataFrame:
    """Over all series: how many exceed the threshold, the largest and the median share."""
    median = exact_quantiles(fractions, "zero_fraction", [0.5]).select("quantile").scalar()
    return fractions.agg(
        F.count(F.lit(1)).alias("n_series"),
        F.count_if(F.col("zero_fraction") > threshold).alias("n_above"),
        F.max("zero_fraction").alias("max_fraction"),
    ).withColumn("median_fraction", median)


def history_depth(panel: DataFrame, last: date | None = None, min_history: int = DEFAULTS.min_history,
                  windows: int = DEFAULTS.windows, step: int = DEFAULTS.step) -> DataFrame:
    """Per series: first day, the start the back-test needs, and whether it is met."""
    needed = first_cutoff(last or last_day(panel), windows, step) - timedelta(days=min_history)
    out = panel.groupBy(KEY).agg(F.min(DAY).alias("start_date")).withColumn("needed_start", F.lit(needed))
    return out.withColumn("sufficient", F.col("start_date") <= F.col("needed_start"))


def describe(df: DataFrame, column: str, probs: tuple[float, ...] = (0.25, 0.5, 0.75, 0.9)) -> DataFrame:
    """count, mean, std, min, quantiles and max of one column, rounded to 3 digits."""
    quantiles = exact_quantiles(df, column, list(probs))
    whole = df.agg(F.count(column).alias("count"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"),
                   F.min(column).alias("min"), F.max(column).alias("max"))
    names = {f"p{round(p * 100)}": p for p in probs}
    one = quantiles.agg(F.struct(*[
        F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n) for n, p in names.items()
    ])).scalar()
    out = whole.withColumns({n: one.getField(n) for n in names})
    rounded = [F.round(c, 3).alias(c) for c in ("mean", "std", "min", *names, "max")]
    return out.select("count", *rounded)


def gappiest(summary: DataFrame, n: int = 10) -> DataFrame:
    return summary.orderBy(F.desc("missing_pct"), KEY).limit(n)


def dow_profile(panel: DataFrame) -> DataFrame:
    """Mean y per weekday, Monday 0."""
    return panel.groupBy(day_of_week(F.col(DAY)).alias("dow")).agg(F.avg(TARGET).alias("mean_y"))


def dow_peak_trough(profile: DataFrame) -> DataFrame:
    """Best and worst weekday of a profile, their ratio, and the mean of the weekday means."""
    names = F.array(*[F.lit(d) for d in LABELS])
    out = profile.agg(
        F.max_by("dow", F.struct("mean_y", -F.col("dow"))).alias("peak"),
        F.min_by("dow", F.struct("mean_y", "dow")).alias("trough"),
        F.max("mean_y").alias("peak_mean"),
        F.min("mean_y").alias("trough_mean"),
        F.avg("mean_y").alias("panel_mean"),
    )
    return out.select(
        F.get(names, F.col("peak")).alias("peak_day"), "peak_mean",
        F.get(names, F.col("trough")).alias("trough_day"), "trough_mean",
        ratio(F.col("peak_mean"), F.col("trough_mean")).alias("peak_trough_ratio"), "panel_mean",
    )


def _bin(value: Column, lo: Column, hi: Column, bins: int) -> Column:
    """0-based equal-width bin; the last one includes its upper edge. A single value falls in the middle bin of
    a range of width 1 around it."""
    low, high = F.when(lo == hi, lo - 0.5).otherwise(lo), F.when(lo == hi, hi + 0.5).otherwise(hi)
    return F.least(F.floor((value - low) / (high - low) * bins), F.lit(bins - 1))


def _edges(lo: Column, hi: Column, bins: int) -> tuple[Column, Column]:
    low = F.when(lo == hi, lo - 0.5).otherwise(lo)
    width = F.when(lo == hi, F.lit(1.0)).otherwise(hi - lo) / bins
    return low + F.col("bin") * width, low + (F.col("bin") + 1) * width


def histogram(df: DataFrame, column: str, bins: int = 40) -> DataFrame:
    """Equal-width counts over the column's range, empty bins included."""
    ends = df.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi"))).scalar()
    lo, hi = ends.getField("lo"), ends.getField("hi")
    value = F.col(column)
    found = df.filter(value.isNotNull()).groupBy(_bin(value, lo, hi, bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").alias("bin"))
    out = every.join(F.broadcast(found), "bin", "left")  # at most `bins` rows
    left, right = _edges(lo, hi, bins)
    return out.select("bin", left.alias("left_edge"), right.alias("right_edge"), F.coalesce("n", F.lit(0)).alias("n"))


def interval_widths(forecasts: DataFrame) -> DataFrame:
    both = F.col("lo_80").isNotNull() & F.col("hi_80").isNotNull()
    return forecasts.filter(both).withColumn("width", F.col("hi_80") - F.col("lo_80"))


def interval_width_hist(forecasts: DataFrame, bins: int = 60, cap: float = 0.99) -> DataFrame:
    """Per model: density of interval widths, each clipped at the model's ``cap`` quantile.

    The clipped range ends at that quantile, so the range and the cap come from the same small table.
    """
    widths = interval_widths(forecasts).select("model", "width")
    top = exact_quantiles(widths, "width", [cap], ["model"])
    low = widths.groupBy("model").agg(F.min("width").alias("lo"), F.count(F.lit(1)).alias("total"))
    ends = low.join(top.select("model", F.col("quantile").alias("hi")), "model")
    clipped = widths.join(settle(ends, "ends"), "model")  # stored, so that its size is known
    clipped = clipped.withColumn("width", clip_upper(F.col("width"), F.col("hi")))
    at = _bin(F.col("width"), F.col("lo"), F.col("hi"), bins).alias("bin")
    counts = clipped.groupBy("model", "lo", "hi", "total", at).agg(F.count(F.lit(1)).alias("n"))
    left, right = _edges(F.col("lo"), F.col("hi"), bins)
    density = F.col("n") / F.col("total") / (right - left)
    return counts.select("model", "bin", left.alias("left_edge"), "n", density.alias("density"))


def interval_width_median(forecasts: DataFrame) -> DataFrame:
    medians = exact_quantiles(interval_widths(forecasts), "width", [0.5], ["model"])
    return medians.select("model", F.col("quantile").alias("median_width")).orderBy("median_width", "model")
