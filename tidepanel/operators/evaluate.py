"""From forecasts to scores, leaderboards and choices between models."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.config import DAY, DEFAULTS, KEY, METRICS, SCOPE, TARGET
from tidepanel.contracts import CONTRACTS, ContractError
from tidepanel.functions import metrics as M
from tidepanel.functions.scalars import clip_lower, pct_improvement

FORECAST_COLUMNS = (KEY, DAY, TARGET, "model", "y_hat", "lo_80", "hi_80", "cutoff", "stage")


def finalize(forecasts: DataFrame, stage: str, floor: float | None = 0.0) -> DataFrame:
    """The forecast contract's columns in order: stage set, values clipped, absent interval columns NULL."""
    have = forecasts.columns
    values = {"y_hat": clip_lower(F.col("y_hat"), floor)}
    for c in ("lo_80", "hi_80"):
        values[c] = clip_lower(F.col(c), floor) if c in have else F.lit(None).cast("double")
    return forecasts.withColumns({**values, "stage": F.lit(stage)}).select(*FORECAST_COLUMNS)


def named(forecasts: DataFrame, model: str, stage: str, floor: float | None = 0.0) -> DataFrame:
    return finalize(forecasts.withColumn("model", F.lit(model)), stage, floor)


def model_columns(wide: DataFrame) -> list[str]:
    """Columns of a wide back-test table that hold forecasts: neither keys nor interval bounds."""
    def is_bound(c: str) -> bool:
        head, _, level = c.rpartition("-")
        return level.isdigit() and head.endswith(("-lo", "-hi"))

    return [c for c in wide.columns if c not in (KEY, DAY, "cutoff", TARGET, "index") and not is_bound(c)]


def wide_to_long(wide: DataFrame, stage: str = "baseline", level: int = 80, models: list[str] | None = None,
                 floor: float | None = 0.0) -> DataFrame:
    """One row per model of a wide back-test table."""
    def bound(model: str, side: str) -> Column:
        name = f"{model}-{side}-{level}"
        return F.col(f"`{name}`") if name in wide.columns else F.lit(None).cast("double")

    cells = [
        F.struct(F.lit(m).alias("model"), F.col(f"`{m}`").cast("double").alias("y_hat"),
                 bound(m, "lo").alias("lo_80"), bound(m, "hi").alias("hi_80"))
        for m in models or model_columns(wide)
    ]
    long = wide.select(KEY, DAY, "cutoff", TARGET, F.inline(F.array(*cells)))
    return finalize(long, stage, floor)


def rename_model(wide: DataFrame, column: str, model: str, stage: str, level: int = 80, floor: float | None = 0.0
                 ) -> DataFrame:
    """One model column of a wide table as long rows under another name. Bounds that are absent stay NULL."""
    renamed = wide.select(KEY, DAY, "cutoff", TARGET, F.col(f"`{column}`").alias(model), *[
        F.col(f"`{column}-{side}-{level}`").alias(f"{model}-{side}-{level}")
        for side in ("lo", "hi") if f"{column}-{side}-{level}" in wide.columns
    ])
    return wide_to_long(renamed, stage, level, [model], floor)


def fill_missing(forecasts: DataFrame, bounds_from_point: bool = False, floor: float | None = 0.0) -> DataFrame:
    """NULL forecasts become 0 and all values are clipped; with ``bounds_from_point`` an absent bound column
    takes the point forecast."""
    out = forecasts.withColumn("y_hat", clip_lower(F.coalesce("y_hat", F.lit(0.0)), floor))
    for c in ("lo_80", "hi_80"):
        if c in forecasts.columns:
            out = out.withColumn(c, clip_lower(F.col(c), floor))
        elif bounds_from_point:
            out = out.withColumn(c, F.col("y_hat"))
    return out


def union_forecasts(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def metric_columns(with_intervals: bool = True, coverage: float = DEFAULTS.coverage) -> dict[str, Column]:
    y, y_hat, lo, hi = (F.col(c) for c in (TARGET, "y_hat", "lo_80", "hi_80"))
    out = {"wMAPE": M.wmape(y, y_hat), "Bias": M.bias(y, y_hat)}
    if with_intervals:
        out["IntervalScore_80"] = M.interval_score(y, lo, hi, coverage)
        out["Coverage_80"] = M.coverage_rate(y, lo, hi)
    return out


def _has_intervals(forecasts: DataFrame) -> bool:
    return {"lo_80", "hi_80"} <= set(forecasts.columns)


def wide_scores(forecasts: DataFrame, by: list[str], coverage: float = DEFAULTS.coverage) -> DataFrame:
    """Pooled metrics per group in one aggregation; only partial sums are shuffled."""
    columns = metric_columns(_has_intervals(forecasts), coverage)
    return forecasts.groupBy(*by).agg(*[c.alias(n) for n, c in columns.items()])


def score_forecasts(forecasts: DataFrame, subset_name: str, stage: str | None = None,
                    coverage: float = DEFAULTS.coverage) -> DataFrame:
    """Long score rows per model: two metrics, or four when the table has interval columns."""
    if stage is not None:
        forecasts = forecasts.filter(F.col("stage") == stage)
    needed = [c for c in CONTRACTS["forecast"].required if c != "stage"]
    missing = [c for c in needed if c not in forecasts.columns]
    if missing:
        raise ContractError(f"score_forecasts: missing columns {missing}")
    columns = metric_columns(_has_intervals(forecasts), coverage)
    label = F.min("stage") if "stage" in forecasts.columns else F.first(F.lit("unknown"))
    wide = forecasts.groupBy("model").agg(label.alias("stage"), *[c.alias(n) for n, c in columns.items()])
    long = wide.unpivot(["model", "stage"], list(columns), "metric", "score")
    return long.select(
        "model", "metric", "score", "stage", F.lit(SCOPE).alias("aggregation_scope"),
        F.lit(subset_name).alias("subset_name"),
    )


def pivot_metrics(scores: DataFrame, metrics: tuple[str, ...] = METRICS) -> DataFrame:
    """Score rows to one column per metric; a metric nobody has is a NULL column."""
    cells = [F.avg(F.when(F.col("metric") == m, F.col("score"))).alias(m) for m in metrics]
    return scores.groupBy("model", "stage", "subset_name").agg(*cells)


def build_leaderboard(scores: list[DataFrame], order_by: str = "wMAPE") -> DataFrame:
    return pivot_metrics(union_forecasts(*scores)).orderBy(F.col(order_by).asc_nulls_last(), "model")


def uncertainty_leaderboard(scores: list[DataFrame]) -> DataFrame:
    return build_leaderboard(scores, "IntervalScore_80")


def display_leaderboard(board: DataFrame, columns: list[str], order_by: str = "wMAPE") -> DataFrame:
    """The wanted columns that exist, without rows lacking the ordering metric."""
    return board.select(*[c for c in columns if c in board.columns]).dropna(subset=[order_by]).orderBy(
        order_by, "model")


def leaderboard_rank(board: DataFrame, metric: str = "wMAPE") -> DataFrame:
    """Position within each subset and stage-free margin to the next model. A subset has one row per model."""
    place = Window.partitionBy("subset_name").orderBy(F.col(metric).asc_nulls_last(), "model")
    return board.withColumns({
        "position": F.row_number().over(place),
        "margin_to_next": F.lead(metric).over(place) - F.col(metric),
    })


def metric_lookup(scores: DataFrame, model: str, metric: str) -> DataFrame:
    """One row with the score, NULL if the model lacks the metric."""
    hit = (F.col("model") == model) & (F.col("metric") == metric)
    return scores.agg(F.max(F.when(hit, F.col("score"))).alias("score"))


def coverage_diagnostic(board: DataFrame, target: float = DEFAULTS.coverage) -> DataFrame:
    out = board.select("model", "Coverage_80").dropna()
    return out.withColumn("label", M.calibration_label(F.col("Coverage_80"), target)).orderBy(
        F.desc("Coverage_80"), "model")


def accuracy_vs_interval(board: DataFrame) -> DataFrame:
    """Both headline metrics per model, flagged when both are at or below their median over models."""
    pairs = board.select("model", "wMAPE", "IntervalScore_80").dropna()
    mid = pairs.agg(F.struct(F.median("wMAPE").alias("w"), F.median("IntervalScore_80").alias("i"))).scalar()
    good = (F.col("wMAPE") <= mid.getField("w")) & (F.col("IntervalScore_80") <= mid.getField("i"))
    return pairs.withColumn("production_ready", good)


def best_baseline(board: DataFrame, stage: str = "baseline") -> DataFrame:
    """The defender: the baseline with the lowest wMAPE."""
    best = F.min(F.struct("wMAPE", "model"))
    rows = board.filter((F.col("stage") == stage) & F.col("wMAPE").isNotNull())
    return rows.agg(best.alias("b")).select("b.model", "b.wMAPE")


def champion_challenger(board: DataFrame, margin: float = 0.03, stage: str = "baseline") -> DataFrame:
    """The best model, the defender, and whether the best one wins by the margin."""
    pair = F.struct("wMAPE", "model")
    known = F.col("wMAPE").isNotNull()
    ends = board.agg(
        F.min(F.when(known, pair)).alias("c"), F.min(F.when(known & (F.col("stage") == stage), pair)).alias("d")
    )
    delta = F.col("d.wMAPE") - F.col("c.wMAPE")
    return ends.select(
        F.col("c.model").alias("challenger"), F.col("d.model").alias("defender"), delta.alias("delta"),
        F.when(delta >= margin, F.col("c.model")).otherwise(F.col("d.model")).alias("champion"),
    )


def final_tables(baselines: DataFrame, ml: dict[str, DataFrame], neural: DataFrame, subset_name: str,
                 preference: tuple[str, ...] = ("cat", "rich", "base")) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(all forecasts, scores of rows with intervals, leaderboard) with the preferred ML variant that exists."""
    chosen = next(ml[name] for name in preference if name in ml)
    every = union_forecasts(baselines, chosen, neural)
    scores = score_forecasts(
        every.filter(F.col("lo_80").isNotNull() & F.col("hi_80").isNotNull()), subset_name
    )
    return every, scores, build_leaderboard([score_forecasts(every, subset_name)])


def compare_losses(losses: DataFrame, default: str) -> DataFrame:
    """Each configuration's loss and its improvement over the default, in percent. ``losses`` is (name, loss)."""
    base = losses.filter(F.col("name") == default).agg(F.max("loss").alias("l")).scalar()
    return losses.withColumn("vs_default_pct", pct_improvement(base, F.col("loss")))


def best_so_far(trials: DataFrame) -> DataFrame:
    """Running minimum of the loss over trials, which are a few dozen rows."""
    run = Window.orderBy("trial").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return trials.withColumn("best_loss", F.min("loss").over(run))


def best_candidate(trials: DataFrame, fixed: dict[str, object] | None = None) -> DataFrame:
    """The trial with the lowest loss, together with the settings that were not searched."""
    columns = [c for c in trials.columns if c != "loss"]
    best = trials.agg(F.min(F.struct("loss", "trial", *[c for c in columns if c != "trial"])).alias("b"))
    out = best.select("b.*")
    return out.withColumns({k: F.lit(v) for k, v in (fixed or {}).items()})
