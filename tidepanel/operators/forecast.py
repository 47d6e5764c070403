"""Forecasting without training: last value, last week, sample paths, intervals."""

from datetime import date
from typing import Callable, Protocol

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.config import DAY, DEFAULTS, KEY, TARGET
from tidepanel.functions.scalars import clip_lower
from tidepanel.operators.folds import Folds, fold_context, unpack
from tidepanel.operators.panel import day_span, in_order


class Forecaster(Protocol):
    """What a back-test needs of a model: rows (unique_id, ds, cutoff, h, y, y_hat) for every fold."""

    def __call__(self, panel: DataFrame, folds: Folds) -> DataFrame: ...


def _last(h: Column) -> Column:
    """The last known value of the context."""
    return F.element_at(F.filter("past", lambda v: v.isNotNull()), -1)


def _last_week(season: int) -> Callable[[Column], Column]:
    return lambda h: F.element_at("past", (((h - 1) % season) - season).cast("int"))


def naive(panel: DataFrame, folds: Folds) -> DataFrame:
    """The last value, repeated."""
    return unpack(fold_context(panel, folds, DEFAULTS.season), folds, _last)


def seasonal_naive(panel: DataFrame, folds: Folds, season: int = DEFAULTS.season) -> DataFrame:
    """The value of the same weekday in the last known week."""
    return unpack(fold_context(panel, folds, season), folds, _last_week(season))


def both_naive(panel: DataFrame, folds: Folds, season: int = DEFAULTS.season) -> DataFrame:
    """Naive and SeasonalNaive rows, with a ``model`` column, from one pass."""
    rows = unpack(fold_context(panel, folds, season), folds, _last, {"_week": _last_week(season)(F.col("h"))})
    pair = F.array(
        F.struct(F.lit("Naive").alias("model"), F.col("y_hat")),
        F.struct(F.lit("SeasonalNaive").alias("model"), F.col("_week").alias("y_hat")),
    )
    return rows.select(KEY, DAY, "cutoff", "h", TARGET, F.inline(pair))


def with_sigma(panel: DataFrame, folds: Folds, lookback: int, lag: int) -> DataFrame:
    """Contexts with ``sigma``, the root mean square of y - lag(y) over all training rows of the fold."""
    error = F.col(TARGET) - F.lag(TARGET, lag).over(in_order())
    squares = panel.select(KEY, DAY, TARGET, (error * error).alias("_sq"))
    return fold_context(squares, folds, lookback, {
        "sigma": lambda cutoff: F.sqrt(F.avg(F.when(F.col(DAY) <= cutoff, F.col("_sq"))))
    })


def gaussian(contexts: DataFrame, folds: Folds, point: Callable[[Column], Column], growth: Callable[[Column], Column],
             z: float = DEFAULTS.z) -> DataFrame:
    """Forecast rows with y_hat -/+ z * sigma * growth(h)."""
    h = F.col("h")
    half = z * F.col("sigma") * growth(h)
    return unpack(contexts, folds, point, {"lo_80": point(h) - half, "hi_80": point(h) + half})


def naive_gaussian(panel: DataFrame, folds: Folds, season: int = DEFAULTS.season) -> DataFrame:
    return gaussian(with_sigma(panel, folds, season, 1), folds, _last, F.sqrt)


def seasonal_naive_gaussian(panel: DataFrame, folds: Folds, season: int = DEFAULTS.season) -> DataFrame:
    contexts = with_sigma(panel, folds, season, season)
    return gaussian(contexts, folds, _last_week(season), lambda h: F.sqrt(F.floor((h - 1) / season) + 1))


def _quantile_of(sorted_values: Column, q: float) -> Column:
    place = (F.size(sorted_values) - 1) * q
    low = F.floor(place).cast("int")
    share = place - low
    upper = F.get(sorted_values, F.least(low + 1, F.size(sorted_values) - 1))
    return F.get(sorted_values, low) * (1 - share) + upper * share


def conformal_interval(panel: DataFrame, forecaster: Forecaster, folds: Folds, n_windows: int = DEFAULTS.windows,
                       coverage: float = DEFAULTS.coverage) -> DataFrame:
    """Forecasts with back-test intervals, per series and step.

    The model forecasts ``n_windows`` extra cutoffs, a horizon apart, before each fold. The bounds are quantiles
    of the forecast minus and plus those absolute errors. Needs step == horizon, so that the folds share their
    calibration cutoffs; each is forecast once, and one window per series reads the errors before each fold.

    A forecaster that is fitted (``fitted`` is set on it) runs twice: the errors come from the fit at the first
    calibration cutoff, which never leaks, the forecasts from the same fit as without intervals. One that has ``many``
    shares its training rows between the two.
    """
    if folds.step != folds.horizon:
        raise ValueError("conformal_interval needs step == horizon")
    both = [folds.earlier(n_windows), folds] if getattr(forecaster, "fitted", False) else [folds.earlier(n_windows)]
    many = getattr(forecaster, "many", lambda panel, several: [forecaster(panel, f) for f in several])
    rows, *points = many(panel, both)
    if points:
        point = points[0].select(KEY, "cutoff", "h", DAY, TARGET, F.col("y_hat").alias("_point"))
        later = F.col("cutoff") >= F.lit(folds.first)
        errors = rows.withColumn("_error", F.abs(F.col(TARGET) - F.col("y_hat")))
        errors = errors.select(KEY, "cutoff", "h", "_error")
        rows = rows.filter(~later).unionByName(point.withColumnRenamed("_point", "y_hat"))
        rows = rows.join(errors, [KEY, "cutoff", "h"], "left")
    else:
        rows = rows.withColumn("_error", F.abs(F.col(TARGET) - F.col("y_hat")))
    # range frame in days: a calibration cutoff without an actual must not let an older one in
    before = Window.partitionBy(KEY, "h").orderBy(F.unix_date("cutoff")).rangeBetween(-n_windows * folds.step, -1)
    rows = rows.withColumn("_errors", F.collect_list("_error").over(before))
    rows = rows.filter(F.col("cutoff") >= F.lit(folds.first))
    signed = F.sort_array(F.concat(F.col("_errors"), F.transform("_errors", lambda e: -e)))
    tail = (1 - coverage) / 2
    enough = F.size("_errors") == n_windows
    half = F.when(enough, _quantile_of(signed, 1 - tail))
    return (
        rows.withColumn("_half", half)
        .withColumn("lo_80", F.col("y_hat") - F.col("_half"))
        .withColumn("hi_80", F.col("y_hat") + F.col("_half"))
        .drop("_error", "_errors", "_half")
    )


def sample_paths(panel: DataFrame, folds: Folds, n_paths: int = 20, season: int = DEFAULTS.season,
                 start: date | None = None) -> DataFrame:
    """Simulated futures: last week's value plus a past seasonal error drawn per series, cutoff, step and path.

    Errors of all days up to the cutoff are drawn from; ``start``, the panel's first day, saves the scan for it.
    Series with less than two seasons of known days get no paths. Draws are a hash of the keys, so a lost task
    gives the same rows again. Rows (unique_id, cutoff, ds, h, y, sample, y_sim).
    """
    start = start or day_span(panel)[0]
    length = max((folds.cutoffs[-1] - start).days + 1, 2 * season)
    contexts = fold_context(panel, folds, length)
    known = F.size(F.filter("past", lambda v: v.isNotNull()))
    contexts = contexts.filter(known >= 2 * season)
    pool = F.zip_with(
        F.slice("past", season + 1, length - season), F.slice("past", 1, length - season), lambda new, old: new - old
    )
    contexts = contexts.withColumn("_pool", F.filter(pool, lambda e: e.isNotNull()))
    contexts = contexts.filter(F.size("_pool") > 0)

    # all draws of a context in one array, so that its pool is not copied for each of them
    def draw(k: Column) -> Column:
        h, sample = F.floor(k / n_paths).cast("int") + 1, (k % n_paths).cast("int") + 1
        label = F.concat_ws("|", KEY, F.col("cutoff").cast("string"), h.cast("string"), sample.cast("string"))
        seed = F.conv(F.substring(F.md5(label), 1, 8), 16, 10).cast("long")
        error = F.get("_pool", (seed % F.size("_pool")).cast("int"))
        value = _last_week(season)(h) + error
        return F.struct(
            F.date_add("cutoff", h).alias(DAY), h.alias("h"), F.get("future", h - 1).alias(TARGET),
            sample.alias("sample"), value.alias("y_sim"),
        )

    every = F.transform(F.sequence(F.lit(0), F.lit(folds.horizon * n_paths - 1)), draw)
    draws = contexts.select(KEY, "cutoff", F.inline(every))
    return draws if folds.ahead else draws.filter(F.col(TARGET).isNotNull())


def path_summary(paths: DataFrame, coverage: float = DEFAULTS.coverage) -> DataFrame:
    """Median and interval over the paths of each step, clipped at 0. A group has one row per path."""
    tail = (1 - coverage) / 2
    q = F.percentile("y_sim", F.array(F.lit(0.5), F.lit(tail), F.lit(1 - tail)))
    out = paths.groupBy(KEY, "cutoff", DAY, "h").agg(F.first(TARGET).alias(TARGET), q.alias("_q"))
    cells = {"y_hat": 0, "lo_80": 1, "hi_80": 2}
    return out.select(
        KEY, DAY, "cutoff", "h", TARGET, *[clip_lower(F.col("_q")[i]).alias(n) for n, i in cells.items()]
    )


def per_series(predict, lookback: int) -> Forecaster:
    """Plug in user code as a forecaster.

    ``predict(past, horizon) -> horizon values`` gets one series' last ``lookback`` values as a numpy array.
    Arrow batches of contexts go through mapInPandas, so Spark keeps the partitioning of the contexts.
    """

    def forecaster(panel: DataFrame, folds: Folds) -> DataFrame:
        contexts = fold_context(panel, folds, lookback)
        horizon = folds.horizon

        def run(batches):
            for batch in batches:
                batch["path"] = [list(map(float, predict(p, horizon))) for p in batch["past"]]
                yield batch[[KEY, "cutoff", "future", "path"]]

        schema = f"{KEY} string, cutoff date, future array<double>, path array<double>"
        scored = contexts.mapInPandas(run, schema)
        return unpack(scored, folds, lambda h: F.get("path", h - 1))

    return forecaster
