"""Running forecasts in production: snapshots, corrections, late data, fallback and accuracy over time."""

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.config import DAY, DEFAULTS, KEY, TARGET
from tidepanel.functions import metrics as M
from tidepanel.functions.ranks import running_total
from tidepanel.functions.scalars import ratio
from tidepanel.operators.evaluate import wide_scores
from tidepanel.operators.features import Spec, add_features, lagged, reach
from tidepanel.operators.panel import last_day
from tidepanel.operators.select import series_totals
from tidepanel.session import settle
from tidepanel.sources.writers import overwrite_partitions


def feature_snapshot(panel: DataFrame, specs: list[Spec], day: date | None = None) -> DataFrame:
    """Features of one day for all series, labelled with it.

    Only the days the features look back over are read.
    """
    day = day or last_day(panel)
    oldest = day - timedelta(days=reach(specs))
    recent = panel.filter(F.col(DAY).between(F.lit(oldest), F.lit(day)))
    return add_features(recent, specs).filter(F.col(DAY) == F.lit(day)).withColumn("snapshot_date", F.col(DAY))


def feature_backfill(panel: DataFrame, corrections: DataFrame, specs: list[Spec]) -> DataFrame:
    """Recomputed feature rows (unique_id, ds, features) for the days that corrected values reach.

    ``corrections`` is (unique_id, ds, y) with new values. Corrections are marked in the panel and a window
    finds the rows within reach of a mark, so no range join is needed. Only corrected series are processed.
    """
    near, far = min(s.lag for s in lagged(specs)), reach(specs)
    touched = panel.join(corrections.select(KEY).distinct(), KEY, "left_semi")
    fixed = corrections.select(KEY, DAY, F.col(TARGET).alias("_new"), F.lit(True).alias("_hit"))
    merged = touched.join(fixed, [KEY, DAY], "left")
    merged = merged.withColumn(TARGET, F.coalesce("_new", TARGET)).drop("_new")
    behind = Window.partitionBy(KEY).orderBy(DAY).rowsBetween(-far, -near)
    merged = merged.withColumn("_reached", F.coalesce(F.max("_hit").over(behind), F.lit(False))).drop("_hit")
    return add_features(merged, specs).filter("_reached").drop("_reached")


def write_snapshot(panel: DataFrame, specs: list[Spec], path: str, day: date | None = None) -> None:
    """Write one day's features as the partition snapshot_date of the table at ``path``, replacing only that one."""
    overwrite_partitions(feature_snapshot(panel, specs, day), path, ("snapshot_date",))


def write_features(panel: DataFrame, specs: list[Spec], path: str) -> None:
    """All feature rows (unique_id, ds, features), partitioned by year, a series' year together."""
    rows = add_features(panel, specs).drop(TARGET).withColumn("year", F.year(DAY))
    rows.repartition("year", KEY).write.mode("overwrite").partitionBy("year").parquet(path)


def backfill_features(panel: DataFrame, corrections: DataFrame, specs: list[Spec], path: str) -> list[int]:
    """Bring the table of :func:`write_features` up to date with corrected values; returns the years it rewrote.

    Only years with a row that the corrections reach are read and written; the other partitions' files stay. The
    recomputed rows are stored before the table is touched, so a failed job leaves it as it was.
    """
    spark = panel.sparkSession
    fresh = feature_backfill(panel, corrections, specs).drop(TARGET).withColumn("year", F.year(DAY))
    fresh = settle(fresh, "recomputed")
    years = sorted(r[0] for r in fresh.select("year").distinct().collect())  # as many as the calendar has
    if years:
        table = spark.read.parquet(path)
        kept = table.filter(F.col("year").isin(years)).join(fresh.select(KEY, DAY), [KEY, DAY], "left_anti")
        merged = settle(kept.unionByName(fresh.select(*table.columns)), "merged")
        overwrite_partitions(merged.repartition("year", KEY), path, ("year",))
    return years


def late_data_report(rows: DataFrame, key: str, event_day: str, arrival_day: str, allowed_days: int = 0) -> DataFrame:
    """Per series: rows, rows that arrived more than ``allowed_days`` after their day, their share and the
    largest delay."""
    delay = F.datediff(arrival_day, event_day)
    out = rows.groupBy(F.col(key).alias(KEY)).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(delay > allowed_days).alias("n_late"),
        F.max(delay).cast("long").alias("max_delay_days"),
    )
    return out.withColumn("late_share", F.col("n_late") / F.col("n_rows"))


def stale_lags(rows: DataFrame, key: str, event_day: str, arrival_day: str, lag: int) -> DataFrame:
    """Feature days whose lag value was still incomplete on the day itself: (unique_id, ds, lag_ds, n_missing)."""
    late = rows.filter(F.datediff(arrival_day, event_day) > lag)
    return late.groupBy(F.col(key).alias(KEY), F.col(event_day).cast("date").alias("lag_ds")).agg(
        F.count(F.lit(1)).alias("n_missing")
    ).select(KEY, F.date_add("lag_ds", lag).alias(DAY), "lag_ds", "n_missing")


def segment_scores(forecasts: DataFrame, segments: DataFrame, columns: list[str]) -> DataFrame:
    """Pooled metrics per model and segment; ``segments`` is (unique_id, columns…)."""
    return wide_scores(forecasts.join(segments, KEY), ["model", *columns])


def abc_tiers(panel: DataFrame, a: float = 0.80, b: float = 0.95) -> DataFrame:
    """Series by descending total: tier A up to the share ``a`` of all sales, B up to ``b``, C the rest."""
    totals = series_totals(panel)
    whole = totals.agg(F.sum("total").alias("w")).scalar()
    ranked = running_total(totals.withColumn("_whole", whole), "total", [F.desc("total"), F.col(KEY)], "_sum")
    share = ratio(F.col("_sum"), F.col("_whole"))
    # shares are compared at 9 digits, so that the order of summation cannot move a series across a border
    tier = F.when(F.round(share, 9) <= a, "A").when(F.round(share, 9) <= b, "B").otherwise("C")
    return ranked.select(KEY, "total", share.alias("cum_share"), tier.alias("tier"))


def stratified_sample(series: DataFrame, stratum: str, n: int, seed: int = DEFAULTS.seed) -> DataFrame:
    """n series of each stratum, chosen by a hash of the id. Spark keeps only n rows per task before the shuffle,
    so a stratum's size does not matter."""
    ticket = F.md5(F.concat_ws("|", KEY, F.lit(seed)))
    place = Window.partitionBy(stratum).orderBy(ticket, KEY)
    return series.withColumn("_place", F.row_number().over(place)).filter(F.col("_place") <= n).drop("_place")


def stamp_run(forecasts: DataFrame, run_date: date) -> DataFrame:
    return forecasts.withColumn("run_date", F.lit(run_date))


def freshness_monitor(runs: DataFrame, deadline: datetime, max_age_hours: float = 24) -> DataFrame:
    """Per dataset: newest run, its age at the deadline in hours, and whether it is late.

    ``runs`` is (dataset, run_ts).
    """
    newest = runs.groupBy("dataset").agg(F.max(F.col("run_ts").cast("timestamp")).alias("last_run"))
    due = F.lit(deadline.isoformat(sep=" ")).cast("timestamp")  # as text, it is read in the session's zone
    age = (F.unix_timestamp(due) - F.unix_timestamp("last_run")) / 3600.0
    return newest.withColumn("age_hours", age).withColumn("late", age > max_age_hours)


def fallback_forecast(expected: DataFrame, current: DataFrame, last_good: DataFrame) -> DataFrame:
    """A forecast for every expected (unique_id, ds): the current one, else the last good one, with a flag."""
    now = current.select(KEY, DAY, F.col("y_hat").alias("_now"))
    old = last_good.select(KEY, DAY, F.col("y_hat").alias("_old"))
    out = expected.select(KEY, DAY).join(now, [KEY, DAY], "left").join(old, [KEY, DAY], "left")
    return out.select(
        KEY, DAY, F.coalesce("_now", "_old").alias("y_hat"),
        (F.col("_now").isNull() & F.col("_old").isNotNull()).alias("used_fallback"),
    )


def input_drift(panel: DataFrame, days: int = 28, limit: float = 3.0, last: date | None = None) -> DataFrame:
    """Per series: mean of the last ``days`` against mean and deviation before them."""
    start = F.lit((last or last_day(panel)) - timedelta(days=days))
    recent = F.when(F.col(DAY) > start, F.col(TARGET))
    before = F.when(F.col(DAY) <= start, F.col(TARGET))
    out = panel.groupBy(KEY).agg(
        F.avg(recent).alias("recent_mean"), F.avg(before).alias("prior_mean"), F.stddev_samp(before).alias("prior_std")
    )
    out = out.withColumn("z_score", ratio(F.col("recent_mean") - F.col("prior_mean"), F.col("prior_std")))
    return out.withColumn("drifted", F.coalesce(F.abs("z_score") > limit, F.lit(False)))


def prediction_sanity(forecasts: DataFrame, panel: DataFrame, factor: float = 2.0, days: int = 28) -> DataFrame:
    """Per series and model: forecasts above ``factor`` times the largest actual known before the test windows,
    and zero forecasts for a series that sold in the last ``days`` before them."""
    first = forecasts.agg(F.min("cutoff").alias("c")).scalar()
    known = panel.filter(F.col(DAY) <= first)
    recent = F.when(F.col(DAY) > F.date_sub(first, days), F.col(TARGET))
    history = known.groupBy(KEY).agg(F.max(TARGET).alias("max_y"), F.avg(recent).alias("recent_mean"))
    per_model = forecasts.groupBy(KEY, "model").agg(
        F.max("y_hat").alias("max_y_hat"), F.count_if(F.col("y_hat") == 0).alias("n_zero")
    )
    out = per_model.join(history, KEY, "left")
    return out.withColumns({
        "too_large": F.coalesce(F.col("max_y_hat") > factor * F.col("max_y"), F.lit(False)),
        "zero_but_selling": F.coalesce((F.col("n_zero") > 0) & (F.col("recent_mean") > 0), F.lit(False)),
    })


def _weekly(forecasts: DataFrame, values: dict[str, Column]) -> DataFrame:
    week = F.date_trunc("week", DAY).cast("date").alias("week")
    return forecasts.groupBy("model", week).agg(*[c.alias(n) for n, c in values.items()])


def rolling_accuracy(forecasts: DataFrame, worse_by: float = 0.05) -> DataFrame:
    """Weekly wMAPE per model, its change to the week before, and a flag to retrain. A model has one row a week."""
    weekly = _weekly(forecasts, {"wMAPE": M.wmape(F.col(TARGET), F.col("y_hat"))})
    order = Window.partitionBy("model").orderBy("week")
    out = weekly.withColumn("change", F.col("wMAPE") - F.lag("wMAPE").over(order))
    return out.withColumn("retrain", F.coalesce(F.col("change") > worse_by, F.lit(False)))


def coverage_drift(forecasts: DataFrame) -> DataFrame:
    """Weekly coverage and mean width per model, with the change of coverage."""
    y, lo, hi = F.col(TARGET), F.col("lo_80"), F.col("hi_80")
    weekly = _weekly(forecasts, {"coverage": M.coverage_rate(y, lo, hi), "mean_width": F.avg(hi - lo)})
    order = Window.partitionBy("model").orderBy("week")
    return weekly.withColumn("change", F.col("coverage") - F.lag("coverage").over(order))
