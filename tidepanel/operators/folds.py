"""Rolling-origin back-test frames.

The cutoffs follow from the panel's last day, so they are literals, and tagging rows with their folds needs no
join.
"""

from dataclasses import dataclass, replace
from datetime import date, timedelta
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.config import DAY, DEFAULTS, KEY, TARGET
from tidepanel.operators.panel import last_day


@dataclass(frozen=True)
class Folds:
    """``last`` is the newest day; the last test window ends on it when step == horizon."""

    last: date
    windows: int = DEFAULTS.windows
    step: int = DEFAULTS.step
    horizon: int = DEFAULTS.horizon
    ahead: bool = False  # forecast days without an actual too

    @staticmethod
    def beyond(last: date, horizon: int = DEFAULTS.horizon) -> "Folds":
        """One window of days after ``last``, none of which is known yet."""
        return Folds(last + timedelta(days=horizon), 1, horizon, horizon, ahead=True)

    @staticmethod
    def of(panel: DataFrame, **settings) -> "Folds":
        return Folds(last_day(panel), **settings)

    @property
    def cutoffs(self) -> list[date]:
        """Oldest first."""
        return [self.last - timedelta(days=(self.windows - i) * self.step) for i in range(self.windows)]

    @property
    def first(self) -> date:
        return self.cutoffs[0]

    def array(self) -> Column:
        return F.array(*[F.lit(c) for c in self.cutoffs])

    def tag(self, rows: DataFrame, uses: Callable[[Column], Column], into: str = "cutoff") -> DataFrame:
        """Each row once per cutoff whose condition ``uses(cutoff)`` it meets."""
        met = F.array(*[F.when(uses(F.lit(c)), F.lit(c)) for c in self.cutoffs])
        return rows.select("*", F.explode(met).alias(into)).filter(F.col(into).isNotNull())

    def earlier(self, n: int) -> "Folds":
        """The same folds preceded by n more, used to calibrate intervals."""
        return replace(self, windows=self.windows + n)


def cv_cutoffs(panel: DataFrame, windows: int = DEFAULTS.windows, step: int = DEFAULTS.step) -> DataFrame:
    """(fold, cutoff) rows, oldest first."""
    cutoffs = [F.date_sub("last", (windows - i) * step) for i in range(windows)]
    return panel.agg(F.max(DAY).alias("last")).select(F.posexplode(F.array(*cutoffs)).alias("fold", "cutoff"))


def cv_folds(panel: DataFrame, folds: Folds) -> DataFrame:
    """Every row once per fold it belongs to, as ``train`` (ds <= cutoff) or ``test`` (the horizon after it)."""
    out = folds.tag(panel, lambda c: F.col(DAY) <= F.date_add(c, folds.horizon))
    return out.withColumn("part", F.when(F.col(DAY) <= F.col("cutoff"), "train").otherwise("test"))


def assign_test_window(panel: DataFrame, folds: Folds) -> DataFrame:
    """Rows inside a test window, with its cutoff and the step h within it."""
    later = panel.filter(F.col(DAY) > F.lit(folds.first))
    out = folds.tag(later, lambda c: (F.col(DAY) > c) & (F.col(DAY) <= F.date_add(c, folds.horizon)))
    return out.withColumn("h", F.datediff(DAY, "cutoff"))


def horizon_grid(ids: DataFrame, folds: Folds) -> DataFrame:
    """The days to forecast: (unique_id, cutoff, ds, h)."""
    per_fold = ids.select(KEY, F.explode(folds.array()).alias("cutoff"))
    steps = per_fold.select(KEY, "cutoff", F.explode(F.sequence(F.lit(1), F.lit(folds.horizon))).alias("h"))
    return steps.select(KEY, "cutoff", F.date_add("cutoff", F.col("h")).alias(DAY), "h")


def attach_actuals(grid: DataFrame, panel: DataFrame) -> DataFrame:
    """Actuals for each forecast day; NULL where the panel has none."""
    return grid.join(panel.select(KEY, DAY, TARGET), [KEY, DAY], "left")


def drop_missing_actuals(grid: DataFrame, panel: DataFrame) -> DataFrame:
    return grid.join(panel.select(KEY, DAY, TARGET), [KEY, DAY], "inner")


def drop_short_context(panel: DataFrame, folds: Folds, season: int = DEFAULTS.season) -> DataFrame:
    """(unique_id, cutoff, n_context) for the folds in which a series has at least two seasons of rows."""
    counted = folds.tag(panel.select(KEY, DAY), lambda c: F.col(DAY) <= c).groupBy(KEY, "cutoff")
    return counted.agg(F.count(F.lit(1)).alias("n_context")).filter(F.col("n_context") >= 2 * season)


def refit_frames(panel: DataFrame, folds: Folds, refit: bool = DEFAULTS.refit) -> DataFrame:
    """Training rows by the cutoff their model is fitted at: one fit at the first cutoff, or one per fold."""
    if not refit:
        return panel.filter(F.col(DAY) <= F.lit(folds.first)).withColumn("fit_cutoff", F.lit(folds.first))
    return folds.tag(panel, lambda c: F.col(DAY) <= c, "fit_cutoff")


def inner_validation(panel: DataFrame, folds: Folds) -> DataFrame:
    """Training rows per fold with the last horizon of them marked as held out."""
    out = folds.tag(panel, lambda c: F.col(DAY) <= c)
    held = F.col(DAY) > F.date_sub("cutoff", folds.horizon)
    return out.withColumn("part", F.when(held, "valid").otherwise("fit"))


@dataclass(frozen=True)
class SparsePanel:
    """A panel whose missing days inside ``span`` have the value ``fill``, kept as the rows that exist.

    Back-tests that look at a few recent days fill only those. ``ids`` has one row per series.
    """

    rows: DataFrame
    ids: DataFrame
    span: tuple[date, date]
    fill: float = 0.0


def fold_context(panel: "DataFrame | SparsePanel", folds: Folds, lookback: int,
                 per_fold: dict[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """One row per series and cutoff: ``past``, the last ``lookback`` values up to the cutoff, oldest first,
    and ``future``, the values of the test window. Folds in which a series has no known past are left out.

    A series is grouped once and cut per fold afterwards. The group holds its days from the first context to the
    last test day, so its size is bounded. Without ``per_fold`` older days are filtered at the scan; with it,
    those aggregates (name -> aggregate of all rows, given the cutoff) come from the same pass. Of a sparse panel
    only the days of the contexts are read and filled.
    """
    oldest = folds.first - timedelta(days=lookback - 1)
    newest = folds.cutoffs[-1] + timedelta(days=folds.horizon)
    size = (newest - oldest).days + 1
    used = F.col(DAY).between(F.lit(oldest), F.lit(newest))
    cell = F.struct(F.datediff(DAY, F.lit(oldest)).alias("at"), F.col(TARGET).alias("v"))
    sparse = isinstance(panel, SparsePanel)
    if sparse and per_fold:
        raise ValueError("a sparse panel has no rows to aggregate for the missing days")
    extras = [
        how(F.lit(c)).alias(f"_{name}_{i}")
        for name, how in (per_fold or {}).items() for i, c in enumerate(folds.cutoffs)
    ]
    whole = panel.rows if sparse else panel
    rows = whole if per_fold else whole.filter(used)
    packed = rows.groupBy(KEY).agg(F.sort_array(F.collect_list(F.when(used, cell))).alias("_rows"), *extras)
    if sparse:
        packed = panel.ids.select(KEY).join(packed, KEY, "left")
        packed = packed.withColumn("_rows", F.coalesce("_rows", F.expr("cast(array() as array<struct<at: int, v: double>>)")))
    else:
        packed = packed.filter(F.size("_rows") > 0)

    # each row stands for itself and the days up to the next one, so the work is one step per day
    def unknown(n: Column) -> Column:
        return F.array_repeat(F.lit(None).cast("double"), n)

    def until_next(row: Column, i: Column) -> Column:
        following = F.coalesce(F.get(F.col("_rows"), i + 1)["at"], F.lit(size))
        return F.concat(F.array(row["v"]), unknown(following - row["at"] - 1))

    opening = F.coalesce(F.get(F.col("_rows"), F.lit(0))["at"], F.lit(size))
    every = F.concat(unknown(opening), F.flatten(F.transform("_rows", until_next)))
    if sparse:
        since, until = (panel.span[0] - oldest).days, (panel.span[1] - oldest).days
        every = F.transform(every, lambda v, o: F.coalesce(v, F.when(o.between(since, until), F.lit(panel.fill))))
    packed = packed.withColumn("_all", every)

    def fold(i: int, cutoff: date) -> Column:
        start = (cutoff - oldest).days - lookback + 2  # slices count from 1
        return F.struct(
            F.lit(cutoff).alias("cutoff"),
            F.slice("_all", start, lookback).alias("past"),
            F.slice("_all", start + lookback, folds.horizon).alias("future"),
            *[F.col(f"_{name}_{i}").alias(name) for name in per_fold or {}],
        )

    cut = packed.select(KEY, F.inline(F.array(*[fold(i, c) for i, c in enumerate(folds.cutoffs)])))
    return cut.filter(F.exists("past", lambda v: v.isNotNull()))


def unpack(contexts: DataFrame, folds: Folds, y_hat, extra: dict[str, Column] | None = None) -> DataFrame:
    """Contexts to forecast rows (unique_id, ds, cutoff, h, y, y_hat…).

    ``y_hat`` maps the step column to the forecast. Days without an actual are dropped unless the folds look ahead.
    """
    steps = contexts.select("*", F.posexplode("future").alias("_i", TARGET))
    if not folds.ahead:
        steps = steps.filter(F.col(TARGET).isNotNull())
    steps = steps.withColumn("h", F.col("_i") + 1)
    columns = {"y_hat": y_hat(F.col("h")), **(extra or {})}
    return steps.select(
        KEY, F.date_add("cutoff", F.col("h")).alias(DAY), "cutoff", "h", TARGET,
        *[c.alias(n) for n, c in columns.items()],
    )
