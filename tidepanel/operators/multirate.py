"""Direct forecasts at several rates: coarse steps first, what they leave is forecast at the next finer rate."""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.config import DAY, KEY, TARGET
from tidepanel.functions.scalars import day_of_week, fourier_weekly
from tidepanel.operators.features import pooled_blocks
from tidepanel.operators.folds import Folds, fold_context, unpack
from tidepanel.operators.panel import day_span
from tidepanel.operators.trained import Learner, boosted_learner
from tidepanel.session import settle


def n_knots(horizon: int, rate: int) -> int:
    return -(-horizon // rate)


def coarse_steps(values: Column, horizon: int, rate: int) -> Column:
    """Means of blocks of ``rate`` steps; unknown steps do not count, a block without a known one is NULL."""

    def mean(j: Column) -> Column:
        known = F.filter(F.slice(values, j * rate + 1, F.lit(rate)), lambda v: v.isNotNull())
        return F.try_divide(F.aggregate(known, F.lit(0.0), lambda a, v: a + v), F.size(known))

    return F.transform(F.sequence(F.lit(0), F.lit(n_knots(horizon, rate) - 1)), mean)


def expanded_steps(knots: Column, horizon: int, rate: int) -> Column:
    """A value per step from a value per block: linear between the middles of the blocks, level outside of them."""
    last = n_knots(horizon, rate) - 1

    def value(step: Column) -> Column:
        place = F.greatest(F.least((step - (rate - 1) / 2.0) / rate, F.lit(float(last))), F.lit(0.0))
        low = F.floor(place).cast("int")
        share = place - low
        between = F.get(knots, low) * (1 - share) + F.get(knots, F.least(low + 1, F.lit(last))) * share
        return F.when(share == 0, F.get(knots, low)).otherwise(between)  # an unknown neighbour does not matter there

    return F.transform(F.sequence(F.lit(0), F.lit(horizon - 1)), value)


def _rate_rows(contexts: DataFrame, size: int, horizon: int, rate: int) -> tuple[DataFrame, list[str]]:
    """Rows per block with the history pooled at the rate, the block's place, its first weekday and its target."""
    rows = contexts.withColumn("_pool", pooled_blocks(F.col("past"), size, rate))
    names = [f"pool{rate}_{i}" for i in range(size // rate)]
    rows = rows.withColumns({n: F.coalesce(F.get("_pool", F.lit(i)), F.lit(0.0)) for i, n in enumerate(names)})
    rows = rows.select(KEY, "cutoff", "_train", *names, F.posexplode(coarse_steps(F.col("rest"), horizon, rate)).alias("knot", TARGET))
    day = F.date_add("cutoff", F.col("knot") * rate + 1)
    sin, cos = fourier_weekly(day, 1)
    rows = rows.withColumns({DAY: day, "dow": day_of_week(day), "week_sin1": sin, "week_cos1": cos})
    return rows, [*names, "knot", "dow", "week_sin1", "week_cos1"]


def multirate_direct(learner: Learner | None = None, size: int = 84, rates: tuple[int, ...] = (7, 2, 1),
                     start: date | None = None):
    """A forecaster of one model per rate, coarse to fine.

    The model of a rate sees the history in blocks of that many days and forecasts block means of what the coarser
    ones have left; its blocks are expanded to days, added to the forecast, and taken off the training targets before
    the next rate. Values are scaled by the context's mean. Training cutoffs are those of ``direct_multihorizon``.
    ``size`` must be a multiple of each rate.
    """
    learner = learner or boosted_learner()
    if any(size % r for r in rates):
        raise ValueError(f"a context of {size} days does not divide into blocks of {rates}")

    def forecaster(panel: DataFrame, folds: Folds) -> DataFrame:
        horizon = folds.horizon
        origins = ((folds.first - (start or day_span(panel)[0])).days + 1 - size) // horizon
        if origins < 1:
            raise ValueError(f"no room for a context of {size} days and a horizon before {folds.first}")
        past = Folds(folds.first, origins, horizon, horizon)
        both = fold_context(panel, past, size).withColumn("_train", F.lit(True)).unionByName(
            fold_context(panel, folds, size).withColumn("_train", F.lit(False))
        )
        scale = F.aggregate("past", F.lit(0.0), lambda a, v: a + F.coalesce(v, F.lit(0.0))) / size + 1.0
        both = both.withColumn("_scale", scale)
        both = both.withColumn("past", F.transform("past", lambda v: F.coalesce(v, F.lit(0.0)) / F.col("_scale")))
        state = both.withColumn("rest", F.transform("future", lambda v: v / F.col("_scale")))
        state = settle(state.withColumn("path", F.array_repeat(F.lit(0.0), horizon)), "contexts")
        keys = [KEY, "cutoff", "_train"]
        for rate in sorted(set(rates), reverse=True):
            rows, names = _rate_rows(state, size, horizon, rate)
            train = rows.filter(F.col("_train") & F.col(TARGET).isNotNull())
            scored = learner(train, names, [])(rows.select(*keys, *names))
            cells = F.sort_array(F.collect_list(F.struct("knot", "y_hat")))  # a row per block of one context
            knots = scored.groupBy(*keys).agg(F.transform(cells, lambda c: c["y_hat"]).alias("_knots"))
            state = state.join(knots, keys).withColumn("_days", expanded_steps(F.col("_knots"), horizon, rate))
            state = state.withColumns({
                "rest": F.zip_with("rest", "_days", lambda a, b: a - b),
                "path": F.zip_with("path", "_days", lambda a, b: a + b),
            })
            state = settle(state.drop("_knots", "_days"), "contexts")
        ahead = state.filter(~F.col("_train"))
        return unpack(ahead, folds, lambda h: F.get("path", h - 1) * F.col("_scale"))

    forecaster.fitted = True
    return forecaster
