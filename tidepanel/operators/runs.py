"""Stored forecast runs: checks of each run, the last valid one as of a day, and the events of a fallback."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepanel.config import DAY, KEY, TARGET
from tidepanel.sources.batches import BatchTable

RUN = f"{KEY} string, {DAY} date, model string, y_hat double, cutoff date, stage string, run_date date"
EVENT = "as_of date, wanted_run date, served_run date, n_bad long, n_missing long"


def run_table(spark: SparkSession, path: str) -> BatchTable:
    return BatchTable(spark, path, RUN, ("run_date",), "scoring")


def event_table(spark: SparkSession, path: str) -> BatchTable:
    return BatchTable(spark, path, EVENT)


def store_run(table: BatchTable, forecasts: DataFrame, run_date: date) -> bool:
    """A run is a batch named by its day, so repeating the job of a day adds nothing."""
    return table.append(forecasts.withColumn("run_date", F.lit(run_date)), run_date.isoformat())


def largest_known(panel: DataFrame) -> DataFrame:
    """(unique_id, max_y): what the forecasts of a series are held against, and which series are expected."""
    return panel.groupBy(KEY).agg(F.max(TARGET).alias("max_y"))


def run_checks(runs: DataFrame, known: DataFrame, factor: float = 3.0) -> DataFrame:
    """Per run: rows, rows with an impossible forecast, expected series that have no row, and whether it is valid.

    Impossible: unknown, not finite, below zero, or above ``factor`` times the largest known value of the series. A
    run is valid if it has rows, none of them impossible, and no series is missing. Rows of series that are not
    expected do not count against it.
    """
    y = F.col("y_hat")
    rows = runs.join(known.withColumn("_known", F.lit(True)), KEY, "left")
    bad = y.isNull() | F.isnan(y) | (y < 0) | (y == float("inf")) | (F.col("_known") & (y > factor * F.col("max_y")))
    # partial sums per series first, so that the series of a run are counted without gathering them
    series = rows.groupBy("run_date", KEY).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("bad"), F.first("_known").alias("_known")
    )
    per_run = series.groupBy("run_date").agg(
        F.sum("n").alias("n_rows"), F.sum("bad").alias("n_bad"), F.count("_known").alias("_n")
    )
    every = known.agg(F.count(F.lit(1)).alias("_all")).scalar()
    out = per_run.withColumn("n_missing", every - F.col("_n"))
    valid = (F.col("n_bad") == 0) & (F.col("n_missing") == 0)
    return out.select("run_date", "n_rows", "n_bad", "n_missing", valid.alias("valid"))


def as_of(days: DataFrame, checks: DataFrame) -> DataFrame:
    """For each day of ``days`` (as_of): the newest run up to it, and the newest valid one.

    One pass over both in order of days; there is a row per run and per day asked for.
    """
    marks = checks.select(
        F.col("run_date").alias("day"), F.col("run_date").alias("wanted"),
        F.when(F.col("valid"), F.col("run_date")).alias("served"), F.lit(None).cast("date").alias("as_of"),
    )
    empty = F.lit(None).cast("date")
    asks = days.select(F.col("as_of").alias("day"), empty.alias("wanted"), empty.alias("served"), "as_of")
    before = Window.orderBy("day").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    found = marks.unionByName(asks).select(
        "as_of", F.max("wanted").over(before).alias("wanted_run"), F.max("served").over(before).alias("served_run")
    )
    return found.filter(F.col("as_of").isNotNull())


def fallback_forecast(expected: DataFrame, runs: DataFrame, checks: DataFrame) -> DataFrame:
    """A forecast for each expected (as_of, unique_id, ds) from the last run that was valid as of that day.

    Columns: as_of, unique_id, ds, y_hat, run_date, used_fallback (the newest run was not the one that was served).
    Rows that the served run does not have, and days without any valid run, have no forecast.
    """
    found = as_of(expected.select("as_of").distinct(), checks)
    asked = expected.join(found, "as_of")
    rows = runs.select(F.col("run_date").alias("served_run"), KEY, DAY, "y_hat")
    out = asked.join(rows, ["served_run", KEY, DAY], "left")
    fell = ~F.col("wanted_run").eqNullSafe(F.col("served_run"))
    return out.select("as_of", KEY, DAY, "y_hat", F.col("served_run").alias("run_date"), fell.alias("used_fallback"))


def fallback_events(days: DataFrame, checks: DataFrame) -> DataFrame:
    """A row for each day on which the newest run was not served, with what was wrong with it."""
    found = as_of(days, checks).filter(~F.col("wanted_run").eqNullSafe(F.col("served_run")))
    wrong = checks.select(F.col("run_date").alias("wanted_run"), "n_bad", "n_missing")
    return found.join(wrong, "wanted_run", "left").select("as_of", "wanted_run", "served_run", "n_bad", "n_missing")


def serve(runs: BatchTable, events: BatchTable, expected: DataFrame, known: DataFrame, day: date, factor: float = 3.0
          ) -> DataFrame:
    """The forecasts of ``day``, after the event of a fallback, if there is one, is in the table of events.

    The event is a batch named by the day, so a repeated call records it once.
    """
    stored = runs.read()
    checks = run_checks(stored, known, factor)
    asked = expected.select(KEY, DAY, F.lit(day).alias("as_of"))
    happened = fallback_events(asked.select("as_of").distinct(), checks)
    if not happened.isEmpty():
        events.append(happened, day.isoformat())
    return fallback_forecast(asked, stored, checks)
