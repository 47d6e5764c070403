"""Lag, rolling and calendar features.

A spec gives the same feature in three forms: ``over`` a day-ordered window, for training tables, and ``at`` an
offset past the end of an array of recent values, for forecasting days whose lags are known so far. ``last`` is the
latter for the first unknown day in numpy, with one row of recent values per series and NaN for unknown. ``along`` is
``over`` in numpy, for many days of many series in one array, NaN for unknown, with the same sums in the same order. The
window columns a feature is made of are its ``parts``; features share those they have in common. Panels must be free of
gaps. A rolling feature is NULL until its window is full.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date
from typing import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.config import DAY, KEY, TARGET
from tidepanel.functions.ranks import running_total
from tidepanel.functions.scalars import day_of_week, fourier_annual, fourier_weekly
from tidepanel.operators.panel import in_order


def _back(values: Column, lag: int, ahead: Column | int) -> Column:
    """The value ``lag`` days before the day that lies ``ahead`` days after the first unknown one."""
    return F.try_element_at(values, F.lit(ahead) - F.lit(lag))


@dataclass(frozen=True)
class Lag:
    lag: int

    @property
    def name(self) -> str:
        return f"lag{self.lag}"

    @property
    def reach(self) -> int:
        return self.lag

    def parts(self, y: Column) -> dict[str, Column]:
        return {f"_lag{self.lag}": F.lag(y, self.lag).over(in_order())}

    def over(self) -> Column:
        return F.col(f"_lag{self.lag}")

    def at(self, values: Column, ahead: Column) -> Column:
        return _back(values, self.lag, ahead)

    def last(self, past: np.ndarray) -> np.ndarray:
        return past[:, -self.lag]

    def along(self, run: "Run") -> np.ndarray:
        return run.back(self.lag)


def _mean(x: Column, n: int) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, v: a + v) / n


def _std(x: Column, n: int) -> Column:
    # the one-element transform binds the mean, which the inner lambda would compute again for each value
    bound = F.transform(
        F.array(_mean(x, n)),
        lambda m: F.sqrt(F.aggregate(x, F.lit(0.0), lambda a, v: a + (v - m) * (v - m)) / (n - 1)),
    )
    return F.get(bound, F.lit(0))


def _quantile(ordered: Column, n: int, q: float) -> Column:
    place = q * (n - 1)
    low = int(place)
    share = place - low
    high = F.get(ordered, F.lit(min(low + 1, n - 1)))
    return F.get(ordered, F.lit(low)) * (1 - share) + high * share


@dataclass(frozen=True)
class Rolling:
    """mean, std, min, max or quantile of the ``window`` days that end ``lag`` days before."""

    kind: str
    lag: int
    window: int
    q: float | None = None

    @property
    def name(self) -> str:
        what = f"q{round(self.q * 100)}" if self.kind == "quantile" else self.kind
        return f"{what}_l{self.lag}_w{self.window}"

    @property
    def reach(self) -> int:
        return self.lag + self.window - 1

    @property
    def _frame(self) -> str:
        return f"_l{self.lag}_w{self.window}"

    @property
    def _sliding(self) -> bool:
        return self.kind in ("mean", "std")

    def parts(self, y: Column) -> dict[str, Column]:
        """Sums slide with the window; order statistics share the frame's collected values, sorted once, which is
        several times faster than a sliding aggregate for each."""
        frame = in_order().rowsBetween(-self.reach, -self.lag)
        if self._sliding:
            value = F.avg(y) if self.kind == "mean" else F.stddev_samp(y)
            return {f"_n{self._frame}": F.count(y).over(frame), f"_{self.kind}{self._frame}": value.over(frame)}
        return {f"_values{self._frame}": F.collect_list(y).over(frame)}

    def shared(self) -> dict[str, Column]:
        return {} if self._sliding else {f"_sorted{self._frame}": F.sort_array(f"_values{self._frame}")}

    def over(self) -> Column:
        if self._sliding:
            return F.when(F.col(f"_n{self._frame}") == self.window, F.col(f"_{self.kind}{self._frame}"))
        return self._of(F.col(f"_values{self._frame}"), F.col(f"_sorted{self._frame}"))

    def at(self, values: Column, ahead: Column) -> Column:
        part = F.slice(values, F.lit(ahead) - F.lit(self.reach), F.lit(self.window))
        known = F.filter(part, lambda v: v.isNotNull())
        return self._of(known, F.sort_array(known))

    def last(self, past: np.ndarray) -> np.ndarray:
        end = past.shape[1] - self.lag + 1
        part = past[:, end - self.window : end]  # an unknown value makes the result unknown
        return {
            "mean": lambda: part.mean(axis=1),
            "std": lambda: part.std(axis=1, ddof=1),
            "min": lambda: part.min(axis=1),
            "max": lambda: part.max(axis=1),
            "quantile": lambda: np.quantile(part, self.q, axis=1),
        }[self.kind]()

    def along(self, run: "Run") -> np.ndarray:
        n, known = self.window, run.full(self.lag, self.window)
        value = {
            "mean": lambda: run.total(self.lag, n) / n,
            "std": lambda: run.deviation(self.lag, n),
            "min": lambda: run.ordered(self.lag, n)[:, 0],
            "max": lambda: run.ordered(self.lag, n)[:, -1],
            "quantile": lambda: self._between(run.ordered(self.lag, n)),
        }[self.kind]()
        return np.where(known, value, np.nan)

    def _between(self, ordered: np.ndarray) -> np.ndarray:
        place = self.q * (self.window - 1)
        low = int(place)
        share = place - low
        return ordered[:, low] * (1 - share) + ordered[:, min(low + 1, self.window - 1)] * share

    def _of(self, values: Column, ordered: Column) -> Column:
        n = self.window
        value = {
            "mean": lambda: _mean(values, n),
            "std": lambda: _std(values, n),
            "min": lambda: F.get(ordered, F.lit(0)),
            "max": lambda: F.get(ordered, F.lit(n - 1)),
            "quantile": lambda: _quantile(ordered, n, self.q),
        }[self.kind]()
        return F.when(F.size(values) == n, value)


@dataclass(frozen=True)
class SeasonalMean:
    """Mean of the same weekday over the last ``seasons`` weeks."""

    seasons: int
    season: int = 7

    @property
    def name(self) -> str:
        return f"seasonal_mean_{self.seasons}"

    @property
    def reach(self) -> int:
        return self.seasons * self.season

    @property
    def lag(self) -> int:
        return self.season

    @property
    def _lags(self) -> range:
        return range(self.season, self.reach + 1, self.season)

    def parts(self, y: Column) -> dict[str, Column]:
        return {f"_lag{k}": F.lag(y, k).over(in_order()) for k in self._lags}

    def over(self) -> Column:
        return sum(F.col(f"_lag{k}") for k in self._lags) / self.seasons

    def at(self, values: Column, ahead: Column) -> Column:
        return sum(_back(values, k, ahead) for k in self._lags) / self.seasons

    def last(self, past: np.ndarray) -> np.ndarray:
        return sum(past[:, -k] for k in self._lags) / self.seasons

    def along(self, run: "Run") -> np.ndarray:
        return sum(run.back(k) for k in self._lags) / self.seasons


@dataclass(frozen=True)
class Calendar:
    """Any expression of the day."""

    name: str
    of: Callable[[Column], Column]


Spec = Lag | Rolling | SeasonalMean | Calendar

DOW = Calendar("dow", lambda d: day_of_week(d))
MONTH = Calendar("month", lambda d: F.month(d))


def fourier_specs(weekly: tuple[int, ...] = (1, 2), annual: tuple[int, ...] = (1,)) -> list[Calendar]:
    specs = []
    for k in weekly:
        specs.append(Calendar(f"week_sin{k}", lambda d, k=k: fourier_weekly(d, k)[0]))
        specs.append(Calendar(f"week_cos{k}", lambda d, k=k: fourier_weekly(d, k)[1]))
    for k in annual:
        specs.append(Calendar(f"year_sin{k}", lambda d, k=k: fourier_annual(d, k)[0]))
        specs.append(Calendar(f"year_cos{k}", lambda d, k=k: fourier_annual(d, k)[1]))
    return specs


# The feature sets of the two model variants.
BASE: list[Spec] = [Lag(7), Lag(14), Lag(28), Rolling("mean", 7, 28), DOW, MONTH]
RICH: list[Spec] = [
    Lag(7), Lag(14), Lag(21), Lag(28),
    Rolling("mean", 7, 28), Rolling("std", 7, 28), Rolling("min", 7, 28), Rolling("max", 7, 28),
    Rolling("quantile", 7, 28, 0.25), Rolling("quantile", 7, 28, 0.75),
    SeasonalMean(4), SeasonalMean(8),
    Rolling("mean", 14, 28),
    *fourier_specs(), MONTH,
]


def lagged(specs: list[Spec]) -> list[Spec]:
    return [s for s in specs if not isinstance(s, Calendar)]


def reach(specs: list[Spec]) -> int:
    """Days of history the features look back over."""
    return max(s.reach for s in lagged(specs))


def block(specs: list[Spec]) -> int:
    """Steps that can be forecast at once: none of them needs another one's result."""
    return min(s.lag for s in lagged(specs))


def add_features(panel: DataFrame, specs: list[Spec]) -> DataFrame:
    """One window per series, sorted once; all lags and frames are computed over it."""
    parts: dict[str, Column] = {}
    shared: dict[str, Column] = {}
    for s in lagged(specs):
        parts.update(s.parts(F.col(TARGET)))
        if isinstance(s, Rolling):
            shared.update(s.shared())
    windowed = panel.select("*", *[c.alias(n) for n, c in parts.items()]).withColumns(shared)
    day = F.col(DAY)
    features = [(s.of(day) if isinstance(s, Calendar) else s.over()).alias(s.name) for s in specs]
    return windowed.select(*panel.columns, *features)


class Run:
    """The values of consecutive rows of a table in series and day order, and of some rows before them.

    ``place`` counts the rows of the same series before each row, so that no look back leaves the series. What several
    features need of one frame is computed once.
    """

    def __init__(self, before: np.ndarray, values: np.ndarray, place: np.ndarray, reach: int):
        gap = np.full(reach - len(before), np.nan)
        self.all, self.reach, self.place = np.concatenate([gap, before, values]), reach, place
        self.kept: dict[tuple, np.ndarray] = {}

    def _shifted(self, days: int) -> np.ndarray:
        return self.all[self.reach - days : len(self.all) - days]

    def back(self, lag: int) -> np.ndarray:
        return np.where(self.place >= lag, self._shifted(lag), np.nan)

    def _once(self, key: tuple, make: Callable[[], np.ndarray]) -> np.ndarray:
        if key not in self.kept:
            self.kept[key] = make()
        return self.kept[key]

    def _frame(self, lag: int, window: int) -> Iterator[np.ndarray]:
        """The window's first value of each row, then the second…"""
        return (self._shifted(lag + window - 1 - i) for i in range(window))

    def full(self, lag: int, window: int) -> np.ndarray:
        unknown = lambda: np.logical_or.reduce([np.isnan(v) for v in self._frame(lag, window)])
        return self._once(("full", lag, window), lambda: (self.place >= lag + window - 1) & ~unknown())

    def total(self, lag: int, window: int) -> np.ndarray:
        return self._once(("total", lag, window), lambda: sum(self._frame(lag, window)))

    def deviation(self, lag: int, window: int) -> np.ndarray:
        """One value after the other moves mean and squares, as the engine's aggregate does."""
        mean, squares = np.zeros(len(self.place)), np.zeros(len(self.place))
        for i, v in enumerate(self._frame(lag, window)):
            delta = v - mean
            part = delta / (i + 1)
            mean = mean + part
            squares = squares + delta * (delta - part)
        return np.sqrt(squares / (window - 1))

    def ordered(self, lag: int, window: int) -> np.ndarray:
        return self._once(("ordered", lag, window), lambda: np.sort(np.column_stack(list(self._frame(lag, window))), axis=1))


def _feature_batches(batches: Iterator[pa.RecordBatch], own: list[str], back: list[Spec], sets: list[list[str]]
                     ) -> Iterator[pa.RecordBatch]:
    """Batches in series and day order with the features ``back``; rows with a target and all features of some set stay."""
    far = max((s.reach for s in back), default=0)
    key, before, seen = None, np.empty(0), 0  # of the rows before the batch
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        ids = batch.column(own.index(KEY)).dictionary_encode(null_encoding="encode")
        codes = ids.indices.to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
        place = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
        labels = ids.dictionary.to_pylist()
        if seen and labels[codes[0]] == key:
            place[: starts[1] if len(starts) > 1 else n] += seen
        values = batch.column(own.index(TARGET)).cast(pa.float64()).to_numpy(zero_copy_only=False)
        frames = Run(before, values, place, far)
        found = {s.name: s.along(frames) for s in back}
        whole = np.zeros(n, bool)
        for names in sets:
            known = np.ones(n, bool)
            for name in names:
                known &= ~np.isnan(found[name])
            whole |= known
        keep = whole & ~np.isnan(values)
        key, seen, before = labels[codes[-1]], int(place[-1]) + 1, frames.all[len(frames.all) - far :]
        columns = [*batch.columns, *[pa.array(v) for v in found.values()]]
        yield pa.RecordBatch.from_arrays(columns, [*own, *found]).filter(pa.array(keep))


def _sorted_days(panel: DataFrame, cutoff: date | None) -> DataFrame:
    rows = panel if cutoff is None else panel.filter(F.col(DAY) <= F.lit(cutoff))
    return rows.repartition(KEY).sortWithinPartitions(KEY, DAY)


def training_matrix(panel: DataFrame, specs: list[Spec], cutoff: date | None = None,
                    static: DataFrame | None = None) -> DataFrame:
    """Feature rows up to ``cutoff`` without NULLs, with the series' static columns if given.

    The features are those of :func:`add_features`. Spark brings the series together and sorts their days; the tasks
    pass over the rows in batches and keep the last values of one batch for the next, so that no frame is summed up by
    an aggregate of its own for each row.
    """
    rows = _sorted_days(panel, cutoff)
    back, names = lagged(specs), [s.name for s in specs]
    own, sets = [f.name for f in rows.schema], [[s.name for s in lagged(specs)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _feature_batches(batches, own, back, sets)

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema] + [f"`{s.name}` double" for s in back]
    out = rows.mapInArrow(run, ", ".join(kinds))
    out = out.withColumns({s.name: s.of(F.col(DAY)) for s in specs if isinstance(s, Calendar)})
    out = out.dropna(subset=names).select(*own, *names)
    return attach_static(out, static) if static is not None else out


def training_batches(panel: DataFrame, sets: list[list[Spec]], cutoff: date | None, columns: dict[str, Column],
                     into: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """What ``into`` makes of the rows of :func:`training_matrix` in the tasks that compute them.

    ``into`` gets the features of all sets, the target and ``columns``. A row stays when the lagged features of one
    set are known; those of another set may be NULL or NaN in it, and calendar features are as they come.
    """
    specs = list(dict.fromkeys(s for own in sets for s in own))
    back, needed = lagged(specs), [[s.name for s in lagged(own)] for own in sets]
    calendars = [s.of(F.col(DAY)).alias(s.name) for s in specs if isinstance(s, Calendar)]
    rows = _sorted_days(panel, cutoff).select(KEY, TARGET, *[c.alias(n) for n, c in columns.items()], *calendars)
    own = rows.columns
    return rows.mapInArrow(lambda batches: into(_feature_batches(batches, own, back, needed)), schema)


def attach_static(rows: DataFrame, static: DataFrame) -> DataFrame:
    return rows.join(static, KEY, "left")


def static_of(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One row per series of its static columns."""
    return rows.select(KEY, *columns).distinct()


def category_codes(rows: DataFrame, column: str, into: str) -> DataFrame:
    """Alphabetical integer codes, 0 first. The distinct labels are numbered range by range."""
    labels = rows.select(column, F.lit(1).alias("_one")).filter(F.col(column).isNotNull()).distinct()
    numbered = running_total(labels, "_one", [F.col(column)], "_position")
    codes = numbered.select(column, (F.col("_position") - 1).cast("int").alias(into))
    return rows.join(codes, column, "left")


def multirate_pool(contexts: DataFrame, size: int = 84, rates: tuple[int, ...] = (1, 2, 7)) -> DataFrame:
    """Block means of the last ``size`` days at several rates, oldest block first, as rows
    (unique_id, cutoff, rate, block, pooled)."""
    parts = F.array(*[F.struct(F.lit(r).alias("rate"), pooled_blocks(F.col("past"), size, r).alias("m")) for r in rates])
    rows = contexts.select(KEY, "cutoff", F.inline(parts))
    return rows.select(KEY, "cutoff", "rate", F.posexplode("m").alias("block", "pooled"))


def pooled_blocks(values: Column, size: int, rate: int) -> Column:
    """Means of consecutive blocks of ``rate`` values; ``size`` must be a multiple of ``rate``."""
    if rate == 1:
        return values
    starts = F.sequence(F.lit(0), F.lit(size - rate), F.lit(rate))
    return F.transform(starts, lambda i: _mean(F.slice(values, i + 1, F.lit(rate)), rate))
