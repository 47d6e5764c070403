"""Building and repairing the daily panel (unique_id, ds, y)."""

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidepanel.config import DAY, DEFAULTS, KEY, TARGET
from tidepanel.functions.scalars import series_key
from tidepanel.sources.readers import DAY_PREFIX


def in_order() -> WindowSpec:
    """A series in day order."""
    return Window.partitionBy(KEY).orderBy(DAY)


def melt_wide(sales: DataFrame, ids: tuple[str, ...] = ("item_id", "store_id")) -> DataFrame:
    """Day columns to rows: (ids…, d, y).

    The day columns become one array that is exploded; unpivot() would plan a projection per day, and a sales
    file has thousands of them.
    """
    days = [c for c in sales.columns if c.startswith(DAY_PREFIX)]
    cells = F.expr("array(" + ", ".join(f"`{d}`" for d in days) + ")")  # one expression for all days
    rows = sales.select(*ids, F.posexplode(cells).alias("_i", TARGET))
    # labels number the days from 1 without holes when the file is complete; otherwise look them up
    first = int(days[0].removeprefix(DAY_PREFIX))
    if days == [f"{DAY_PREFIX}{first + i}" for i in range(len(days))]:
        label = F.concat(F.lit(DAY_PREFIX), (F.col("_i") + first).cast("string"))
    else:
        label = F.get(F.split(F.lit(",".join(days)), ","), F.col("_i"))
    return rows.select(*ids, label.alias("d"), TARGET)


def key_sales(melted: DataFrame) -> DataFrame:
    """(unique_id, d, y) with y as double."""
    return melted.select(
        series_key(F.col("item_id"), F.col("store_id")).alias(KEY), "d", F.col(TARGET).cast("double").alias(TARGET)
    )


def join_calendar(melted: DataFrame, calendar: DataFrame) -> DataFrame:
    """Replace the day label by its date; an unknown label gives a NULL date, which the contract rejects.

    Spark broadcasts the calendar when its size is known to be small.
    """
    dated = melted.join(calendar.select("d", DAY), "d", "left")
    return dated.select(KEY, DAY, TARGET)


def panel_daily(rows: DataFrame, key: Column, day: Column, value: Column) -> DataFrame:
    """Transactions to one row per series and day. Sums partially before the shuffle, so busy keys are harmless."""
    return rows.groupBy(key.alias(KEY), day.cast("date").alias(DAY)).agg(F.sum(value).cast("double").alias(TARGET))


def fill_gaps(panel: DataFrame, start: str = "series", end: str = "global", span: tuple[date, date] | None = None
              ) -> DataFrame:
    """A row for every day of each series; y is NULL on the added ones.

    ``start`` and ``end`` say whether a series runs from/to its own first/last day ("series") or the first/last
    day of the whole panel ("global"). ``span`` gives these two days and saves the scan for them.

    Each row expands to itself and the missing days up to the next row, so there is one shuffle by series and
    no join against a day grid.
    """
    if {start, end} - {"series", "global"}:
        raise ValueError("start and end are 'series' or 'global'")
    if span is None and "global" in (start, end):
        span = day_span(panel)
    first, last = F.col(DAY), F.col(DAY)
    if start == "global":
        opening = F.least(F.col(DAY), F.lit(span[0]))
        first = F.when(F.lag(DAY).over(in_order()).isNull(), opening).otherwise(first)
    if end == "global":
        last = F.greatest(F.col(DAY), F.lit(span[1]))
    last = F.coalesce(F.date_sub(F.lead(DAY).over(in_order()), 1), last)
    bounded = panel.select(KEY, F.col(DAY).alias("_at"), TARGET, first.alias("_first"), last.alias("_last"))
    days = bounded.select(KEY, "_at", TARGET, F.explode(F.sequence("_first", "_last")).alias(DAY))
    return days.select(KEY, DAY, F.when(F.col(DAY) == F.col("_at"), F.col(TARGET)).alias(TARGET))


def zero_fill(panel: DataFrame) -> DataFrame:
    return panel.withColumn(TARGET, F.coalesce(TARGET, F.lit(0.0)))


def forward_fill(panel: DataFrame) -> DataFrame:
    """Carry the last known value forward; days before the first one stay NULL."""
    return panel.withColumn(TARGET, F.last(TARGET, ignorenulls=True).over(
        in_order().rowsBetween(Window.unboundedPreceding, Window.currentRow)))


def gap_summary(panel: DataFrame) -> DataFrame:
    """Per series: first and last day, rows, expected rows, missing rows and their share."""
    seen = panel.groupBy(KEY).agg(
        F.min(DAY).alias("start_date"), F.max(DAY).alias("end_date"), F.count(DAY).alias("observed_rows")
    )
    expected = (F.datediff("end_date", "start_date") + 1).cast("long")
    out = seen.withColumn("expected_rows", expected)
    out = out.withColumn("missing_rows", F.col("expected_rows") - F.col("observed_rows"))
    return out.withColumn("missing_pct", F.col("missing_rows") / F.col("expected_rows"))


class GapError(ValueError):
    def __init__(self, missing: int):
        super().__init__(f"{missing} days are missing inside series; run fill_gaps first")
        self.missing = missing


def assert_no_gaps(panel: DataFrame) -> DataFrame:
    """Return ``panel``; raise when a day is missing inside a series."""
    missing = gap_summary(panel).agg(F.coalesce(F.sum("missing_rows"), F.lit(0))).first()[0]
    if missing:
        raise GapError(missing)
    return panel


def longest_gap(panel: DataFrame) -> DataFrame:
    """Per series: the longest run of missing days."""
    run = F.datediff(DAY, F.lag(DAY).over(in_order())) - 1
    return panel.select(KEY, run.alias("_run")).groupBy(KEY).agg(
        F.coalesce(F.max("_run"), F.lit(0)).cast("long").alias("longest_gap")
    )


def drop_gappy_series(panel: DataFrame, max_share: float = 0.30, max_run: int | None = None) -> DataFrame:
    """Keep series whose missing share is at most ``max_share`` and, if given, whose longest gap is below
    ``max_run`` days. Three aggregates over the series window share its one shuffle."""
    whole = Window.partitionBy(KEY)
    run = F.datediff(DAY, F.lag(DAY).over(in_order())) - 1
    expected = F.datediff(F.max(DAY).over(whole), F.min(DAY).over(whole)) + 1
    share = 1 - F.count(DAY).over(whole) / expected
    out = panel.withColumn("_run", run).withColumn("_share", share)
    keep = F.col("_share") <= max_share
    if max_run is not None:
        out = out.withColumn("_longest", F.max("_run").over(whole))
        keep = keep & (F.coalesce("_longest", F.lit(0)) < max_run)
    return out.filter(keep).select(*panel.columns)


def sort_panel(panel: DataFrame) -> DataFrame:
    return panel.orderBy(KEY, DAY)


def train_rows(panel: DataFrame, cutoff: date) -> DataFrame:
    """Rows strictly before ``cutoff``: what series selection looks at."""
    return panel.filter(F.col(DAY) < F.lit(cutoff))


def context_rows(panel: DataFrame, cutoff: date) -> DataFrame:
    """Rows up to and including ``cutoff``: what a model may see."""
    return panel.filter(F.col(DAY) <= F.lit(cutoff))


def day_span(panel: DataFrame) -> tuple[date, date]:
    """First and last day of the panel.

    Two values go to the driver, so that later plans filter by literals, which reach the file scan.
    """
    lo, hi = panel.agg(F.min(DAY), F.max(DAY)).first()
    if hi is None:
        raise ValueError("the panel has no rows")
    return lo, hi


def last_day(panel: DataFrame) -> date:
    return day_span(panel)[1]


def first_cutoff(last: date, windows: int = DEFAULTS.windows, step: int = DEFAULTS.step) -> date:
    return last - timedelta(days=windows * step)
