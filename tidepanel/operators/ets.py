"""Exponential smoothing per series: as Spark expressions, and a wide grid search in numpy."""

import itertools
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.config import DEFAULTS, KEY
from tidepanel.operators.folds import Folds, fold_context, unpack
from tidepanel.operators.panel import day_span


def series_arrays(panel: DataFrame, folds: Folds) -> DataFrame:
    """One row per series and cutoff with all values up to it (``past``) and the test values (``future``).

    Each series is shuffled once and cut per fold afterwards. Values stand at their day: a series begins with its
    first known one, and days without a row are NULL. An array is as long as the calendar at most.
    """
    start = day_span(panel)[0]
    length = max((folds.cutoffs[-1] - start).days + 1, 1)
    contexts = fold_context(panel, folds, length)
    first = F.array_position(F.transform("past", lambda v: v.isNotNull()), True).cast("int")
    return contexts.withColumn("past", F.slice("past", first, length))


def smoothed_level(values: Column, alpha: float) -> Column:
    """Level after simple exponential smoothing, started at the first value; an unknown day leaves it as it is."""
    return F.aggregate(
        F.slice(values, F.lit(2), F.size(values)), F.element_at(values, 1),
        lambda level, y: F.when(y.isNull(), level).otherwise(level * (1 - alpha) + y * alpha),
    )


def simple_smoothing(panel: DataFrame, folds: Folds, alpha: float = 0.3) -> DataFrame:
    contexts = series_arrays(panel, folds).withColumn("_level", smoothed_level(F.col("past"), alpha))
    return unpack(contexts.drop("past"), folds, lambda h: F.col("_level"))


ALPHAS = (0.05, 0.1, 0.2, 0.35, 0.5, 0.7, 0.9)
BETAS = (0.01, 0.1)
GAMMAS = (0.02, 0.1, 0.3)
DAMPING = (0.9, 0.98)
BATCH_ROWS = 64  # series whose arrays are handled together


def candidate_grid() -> np.ndarray:
    """Rows (alpha, beta, phi, gamma, n_parameters). beta 0 is no trend, phi 1 no damping, gamma 0 no season."""
    trends = [(0.0, 1.0, 0)] + [(b, 1.0, 2) for b in BETAS] + [(b, p, 3) for b in BETAS for p in DAMPING]
    seasons = [(0.0, 0)] + [(g, DEFAULTS.season) for g in GAMMAS]
    rows = [
        (a, b * a, phi, g * (1 - a), 2 + k_trend + k_season)
        for a, (b, phi, k_trend), (g, k_season) in itertools.product(ALPHAS, trends, seasons)
    ]
    return np.array(rows)


def fit_paths(values: np.ndarray, grid: np.ndarray, horizon: int, season: int) -> np.ndarray:
    """Best candidate's forecast for each row of ``values`` (series by day), all candidates at once.

    Additive-error recursions, chosen by AICc. Unknown days are NaN: they give no error, so a level moves on by its
    trend alone. The first day must be known.
    """
    n_series, n = values.shape
    known = ~np.isnan(values)
    seen = known.sum(axis=1)[:, None]
    alpha, beta, phi, gamma, k = grid.T
    seasonal = gamma > 0
    first = values[:, : 2 * season] if n >= 2 * season else values
    mean = np.nanmean(first, axis=1)
    level = np.repeat(mean[:, None], len(grid), axis=1)
    trend = np.zeros_like(level)
    cycle = np.zeros((season, n_series, len(grid)))
    for i in range(min(season, n)):
        days = first[:, i::season]
        some = ~np.isnan(days).all(axis=1)
        start = np.zeros(n_series)
        start[some] = np.nanmean(days[some], axis=1) - mean[some]
        cycle[i] = start[:, None] * seasonal
    sse = np.zeros_like(level)
    for t in range(n):
        slot = t % season
        base = level + phi * trend
        error = np.where(known[:, t, None], values[:, t, None] - base - cycle[slot], 0.0)
        sse += error * error
        level = base + alpha * error
        trend = phi * trend + beta * error
        cycle[slot] += gamma * error
    spare = np.maximum(seen - k - 1.0, 1.0)
    score = seen * np.log(np.maximum(sse, 1e-12) / seen) + 2 * k + 2 * k * (k + 1) / spare
    best, rows = score.argmin(axis=1), np.arange(n_series)
    damp = np.cumsum(phi[best][:, None] ** np.arange(1, horizon + 1), axis=1)
    out = level[rows, best][:, None] + damp * trend[rows, best][:, None]
    for h in range(horizon):
        out[:, h] += cycle[(n + h) % season, rows, best]
    return out


def ets_auto(panel: DataFrame, folds: Folds, season: int = DEFAULTS.season) -> DataFrame:
    """The best of a grid of level, trend, damped and weekly-season models, per series and cutoff.

    Arrow batches are cut into BATCH_ROWS series before anything is copied, so a task holds few of them as arrays.
    """
    horizon, grid = folds.horizon, candidate_grid()

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, BATCH_ROWS):
                few = batch.slice(begin, BATCH_ROWS).to_pandas()
                for _, same in few.groupby(few["past"].map(len)):
                    values = np.array([np.array(p, dtype=float) for p in same["past"]])
                    paths = fit_paths(values, grid, horizon, season)
                    out = same[[KEY, "cutoff", "future"]].assign(path=list(paths))
                    yield pa.RecordBatch.from_pandas(out, schema=fields, preserve_index=False)

    numbers = pa.list_(pa.float64())
    fields = pa.schema({KEY: pa.string(), "cutoff": pa.date32(), "future": numbers, "path": numbers})
    schema = f"{KEY} string, cutoff date, future array<double>, path array<double>"
    scored = series_arrays(panel, folds).mapInArrow(run, schema)
    return unpack(scored, folds, lambda h: F.get("path", h - 1))


@dataclass(frozen=True)
class Candidate:
    """beta and gamma are the shares that the recursions use; beta 0 is no trend, phi 1 no damping, gamma 0 no season."""

    alpha: float
    beta: float = 0.0
    phi: float = 1.0
    gamma: float = 0.0

    @property
    def size(self) -> int:
        """Parameters and starting values, beside the two of the level."""
        return 2 + (0 if self.beta == 0 else 2 if self.phi == 1 else 3) + (DEFAULTS.season if self.gamma > 0 else 0)

    def row(self) -> tuple[float, ...]:
        return self.alpha, self.beta, self.phi, self.gamma, self.size


# A short grid for the form on the JVM, where each candidate walks the days by itself.
SHORT_GRID = tuple(
    Candidate(a, b * a, phi, g * (1 - a))
    for a in (0.1, 0.4) for b, phi in ((0.0, 1.0), (0.1, 1.0), (0.1, 0.9)) for g in (0.0, 0.2)
)


def ets_grid(panel: DataFrame, folds: Folds, grid: tuple[Candidate, ...] = SHORT_GRID, season: int = DEFAULTS.season
             ) -> DataFrame:
    """The best candidate of a short grid per series and cutoff, by AICc, without leaving the JVM.

    The same recursions as :func:`ets_auto`: each candidate is one ``aggregate`` over the days, whose state is the
    level, the trend, the season's cycle and the squared errors. Ties go to the earlier candidate.
    """
    contexts = series_arrays(panel, folds)
    start = F.slice("past", 1, 2 * season)

    def mean(values: Column) -> Column:
        known = F.filter(values, lambda v: v.isNotNull())
        return F.try_divide(F.aggregate(known, F.lit(0.0), lambda a, v: a + v), F.size(known))

    def weekday(i: Column) -> Column:
        return F.coalesce(mean(F.filter("_start", lambda v, j: j % season == i)) - F.col("_mean"), F.lit(0.0))

    slots = F.sequence(F.lit(0), F.lit(season - 1))
    contexts = contexts.withColumn("_start", start).withColumn("_mean", mean(F.col("_start")))
    contexts = contexts.withColumn("_cycle", F.transform(slots, weekday))
    contexts = contexts.withColumn("_seen", F.size(F.filter("past", lambda v: v.isNotNull())))

    def step(c: Column) -> Callable[[Column, Column], Column]:
        def run(s: Column, y: Column) -> Column:
            slot = s["t"] % season
            base = s["level"] + c["phi"] * s["trend"]
            error = F.coalesce(y - base - F.get(s["cycle"], slot), F.lit(0.0))
            # the one-element transform binds the error, which each use would compute again
            return F.get(F.transform(F.array(error), lambda e: F.struct(
                (base + c["alpha"] * e).alias("level"), (c["phi"] * s["trend"] + c["beta"] * e).alias("trend"),
                F.transform(s["cycle"], lambda v, i: F.when(i == slot, v + c["gamma"] * e).otherwise(v)).alias("cycle"),
                (s["sse"] + e * e).alias("sse"), (s["t"] + 1).alias("t"),
            )), F.lit(0))

        return run

    def walked(c: Column, place: Column) -> Column:
        none = F.transform("_cycle", lambda v: F.lit(0.0))
        begin = F.struct(
            F.col("_mean").alias("level"), F.lit(0.0).alias("trend"),
            F.when(c["gamma"] > 0, F.col("_cycle")).otherwise(none).alias("cycle"), F.lit(0.0).alias("sse"),
            F.lit(0).alias("t"),
        )
        seen, size = F.col("_seen"), c["size"]

        def scored(s: Column) -> Column:
            spare = F.greatest(seen - size - 1.0, F.lit(1.0))
            fit = seen * F.log(F.greatest(s["sse"], F.lit(1e-12)) / seen)
            return F.struct(
                (fit + 2 * size + 2 * size * (size + 1) / spare).alias("score"), place.alias("place"),
                s["level"].alias("level"), s["trend"].alias("trend"), s["cycle"].alias("cycle"), c["phi"].alias("phi"),
            )

        return F.aggregate("past", begin, step(c), scored)

    names = ("alpha", "beta", "phi", "gamma", "size")
    cells = F.array(*[F.struct(*[F.lit(float(v)).alias(n) for n, v in zip(names, c.row())]) for c in grid])
    contexts = contexts.withColumn("_best", F.array_min(F.transform(cells, walked)))
    contexts = contexts.select(KEY, "cutoff", "future", "_best", F.size("past").alias("_n"))

    def ahead(h: Column) -> Column:
        phi = F.col("_best.phi")
        damped = F.aggregate(F.sequence(F.lit(1), h), F.lit(0.0), lambda a, k: a + F.pow(phi, k.cast("double")))
        return F.col("_best.level") + damped * F.col("_best.trend") + F.get("_best.cycle", ((F.col("_n") + h - 1) % season).cast("int"))

    return unpack(contexts, folds, ahead)
