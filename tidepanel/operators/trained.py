"""Global models: one MLlib model over all series, forecast recursively or directly.

A learner turns a training matrix into a scorer; a scorer adds ``y_hat`` to rows that have the feature columns.
"""

import math
from dataclasses import dataclass, replace
from datetime import date, timedelta
from functools import reduce
from typing import Callable

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.config import DAY, DEFAULTS, KEY, TARGET
from tidepanel.functions.scalars import day_of_week, fourier_weekly, hierarchy_parts
from tidepanel.operators.boost import Ensemble, prepare
from tidepanel.operators.features import (
    BASE, RICH, Calendar, Spec, block, lagged, pooled_blocks, reach, training_matrix,
)
from tidepanel.operators.folds import Folds, fold_context, unpack
from tidepanel.operators.panel import day_span
from tidepanel.session import fresh_path, settle

Scorer = Callable[[DataFrame], DataFrame]
Learner = Callable[[DataFrame, list[str], list[str]], Scorer]


@dataclass(frozen=True)
class TreeParams:
    trees: int = 100
    rate: float = 0.1
    depth: int = 5
    min_rows: int = 20
    row_share: float = 1.0
    feature_share: float = 1.0
    bins: int = 32
    seed: int = DEFAULTS.seed

    def __post_init__(self):
        if not 1 <= self.depth <= 30:
            raise ValueError(f"trees have a depth of 1 to 30, not {self.depth}")

    @staticmethod
    def of(settings: dict) -> "TreeParams":
        """From a flat parameter mapping; keys that start with ``_`` are comments, unknown keys are ignored.

        A tree of ``num_leaves`` leaves becomes one of the depth that holds as many.
        """
        s = {k: v for k, v in settings.items() if not k.startswith("_")}
        return TreeParams(
            trees=int(s.get("n_estimators", 100)),
            rate=float(s.get("learning_rate", 0.1)),
            depth=math.ceil(math.log2(s.get("num_leaves", 31))),
            min_rows=int(s.get("min_child_samples", 20)),
            row_share=float(s.get("subsample", 1.0)),
            feature_share=float(s.get("colsample_bytree", 1.0)),
            seed=int(s.get("random_state", DEFAULTS.seed)),
        )


def _fit(matrix: DataFrame, features: list[str], labels: list[str], estimator) -> Scorer:
    """Fit on the matrix, kept in executor memory or disk for the passes of the fit."""
    columns = [KEY, DAY, TARGET, *features, *labels]
    kept = matrix.select(*[c for c in columns if c in matrix.columns]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        stages = []
        if labels:
            indexed = [f"_{c}_code" for c in labels]
            stages.append(StringIndexer(inputCols=labels, outputCols=indexed, stringOrderType="alphabetAsc",
                                        handleInvalid="keep"))
            model_labels = stages[0].fit(kept)
            stages[0] = model_labels
            if hasattr(estimator, "setMaxBins"):
                estimator.setMaxBins(max(estimator.getMaxBins(), *[len(x) + 1 for x in model_labels.labelsArray]))
        else:
            indexed = []
        stages.append(VectorAssembler(inputCols=[*features, *indexed], outputCol="_vector"))
        model = Pipeline(stages=[*stages, estimator]).fit(kept)
    finally:
        kept.unpersist()

    def scorer(rows: DataFrame) -> DataFrame:
        return model.transform(rows).drop("_vector", *indexed).withColumnRenamed("prediction", "y_hat")

    return scorer


def tree_estimator(params: TreeParams = TreeParams()) -> GBTRegressor:
    share = "all" if params.feature_share >= 1.0 else str(params.feature_share)
    return GBTRegressor(
        featuresCol="_vector", labelCol=TARGET, maxIter=params.trees, stepSize=params.rate, maxDepth=params.depth,
        minInstancesPerNode=params.min_rows, subsamplingRate=params.row_share, featureSubsetStrategy=share,
        maxBins=params.bins, seed=params.seed, cacheNodeIds=False, maxMemoryInMB=512,
    )


def tree_learner(params: TreeParams = TreeParams()) -> Learner:
    return lambda matrix, features, labels: _fit(matrix, features, labels, tree_estimator(params))


def boosted_learner(params: TreeParams = TreeParams()) -> Learner:
    """Boosted trees by cohorts and shards, which fit in one job."""

    def learn(matrix: DataFrame, features: list[str], labels: list[str]) -> Scorer:
        ensemble = Ensemble(matrix, features, labels, {0: params})
        return lambda rows: ensemble.scored(rows).drop("trial", "trees")

    return learn


def tweedie_estimator(power: float = 1.5, max_iter: int = 25, penalty: float = 1e-6, tol: float = 1e-4
                      ) -> GeneralizedLinearRegression:
    return GeneralizedLinearRegression(
        featuresCol="_vector", labelCol=TARGET, family="tweedie", variancePower=power, linkPower=0.0,
        maxIter=max_iter, regParam=penalty, tol=tol,
    )


def tweedie_learner(power: float = 1.5, max_iter: int = 25, penalty: float = 1e-6, tol: float = 1e-4) -> Learner:
    """Generalised linear model with log link and variance ~ mean ** power.

    With a log link the mean is a product of powers of the features, so they enter as logarithms; a raw lag
    would be exponentiated, and a recursion on it would run away.
    """

    def logs(rows: DataFrame, features: list[str]) -> DataFrame:
        return rows.withColumns({f"_log_{f}": F.signum(f) * F.log1p(F.abs(f)) for f in features})

    def learn(matrix: DataFrame, features: list[str], labels: list[str]) -> Scorer:
        names = [f"_log_{f}" for f in features]
        score = _fit(logs(matrix, features), names, labels, tweedie_estimator(power, max_iter, penalty, tol))
        return lambda rows: score(logs(rows, features)).drop(*names)

    return learn


def linear_scorer(weights: dict[str, float], intercept: float = 0.0) -> Scorer:
    """A fixed linear formula over feature columns."""

    def scorer(rows: DataFrame) -> DataFrame:
        total = F.lit(intercept)
        for name, weight in weights.items():
            total = total + F.col(name) * weight
        return rows.withColumn("y_hat", total)

    return scorer


def recursive_forecast(scorer: Scorer, panel: DataFrame, folds: Folds, specs: list[Spec],
                       static: dict[str, Column] | None = None) -> DataFrame:
    """Forecast the horizon in blocks, feeding predictions back as lags.

    A block is as long as the smallest lag, so its steps do not need each other. The contexts are built with
    one shuffle; every later step keeps their (unique_id, cutoff) partitioning, so the grouping that puts a
    block's predictions back into the context shuffles nothing. Contexts hold only the days the features reach.
    """
    static = static or {}
    width, far, horizon = block(specs), reach(specs), folds.horizon
    state = fold_context(panel, folds, far).withColumn("path", F.array().cast("array<double>"))
    state = state.withColumns(static)
    for start in range(0, horizon, width):
        count = min(width, horizon - start)
        rows = state.withColumn("_ahead", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
        day = F.date_add("cutoff", F.col("_ahead") + F.lit(start + 1))
        rows = rows.withColumns({
            s.name: s.of(day) if isinstance(s, Calendar) else s.at(F.col("past"), F.col("_ahead")) for s in specs
        })
        # a series that is too short for a feature gets no forecast, but keeps its place
        known = F.lit(True)
        for s in lagged(specs):
            known = known & F.col(s.name).isNotNull()
        rows = rows.withColumn("_known", known).fillna(0.0, subset=[s.name for s in lagged(specs)])
        scored = scorer(rows).withColumn("y_hat", F.when(F.col("_known"), F.col("y_hat")))
        steps = F.sort_array(F.collect_list(F.struct("_ahead", F.col("y_hat").alias("v"))))
        state = scored.groupBy(KEY, "cutoff").agg(
            *[F.first(c).alias(c) for c in ("past", "future", "path", *static)], steps.alias("_new")
        )
        state = state.select(
            KEY, "cutoff", "future", *static,
            F.slice(F.concat("past", "_new.v"), F.lit(-far), F.lit(far)).alias("past"),
            F.concat("path", "_new.v").alias("path"),
        )
    out = unpack(state, folds, lambda h: F.get("path", h - 1))
    return out.filter(F.col("y_hat").isNotNull())


def _only(folds: Folds, i: int) -> Folds:
    """The folds with just the i-th window."""
    return replace(folds, last=folds.cutoffs[i] + timedelta(days=folds.step), windows=1)


def recursive_model(learner: Learner, specs: list[Spec] = BASE, static: dict[str, Column] | None = None,
                    refit: bool = DEFAULTS.refit, matrix: Callable[..., DataFrame] = training_matrix):
    """A forecaster that fits once at the first cutoff, or at each cutoff when ``refit`` is set.

    ``matrix(panel, specs, cutoff)`` makes the training rows; a search passes one that stores them.
    """
    static = static or {}
    names = [s.name for s in specs]

    def forecaster(panel: DataFrame, folds: Folds) -> DataFrame:
        fits = [_only(folds, i) for i in range(folds.windows)] if refit else [folds]
        parts = []
        for fold in fits:
            scorer = learner(matrix(panel, specs, fold.first).withColumns(static), names, list(static))
            parts.append(recursive_forecast(scorer, panel, fold, specs, static))
        return reduce(DataFrame.unionByName, parts)

    forecaster.fitted = True
    return forecaster


def boosted_model(params: TreeParams = TreeParams(), specs: list[Spec] = BASE, static: dict[str, Column] | None = None,
                  refit: bool = DEFAULTS.refit):
    """A forecaster of boosted trees that fits in one job and forecasts all steps in another; lags may be short.

    ``many(panel, several)`` gives the forecasts of several folds. All fits read the training rows of the newest one,
    which are made and stored once: a feature only looks back, so an older fit takes the rows up to its cutoff.
    """
    static, names = static or {}, [s.name for s in specs]

    def many(panel: DataFrame, several: list[Folds]) -> list[DataFrame]:
        fits = [[_only(folds, i) for i in range(folds.windows)] if refit else [folds] for folds in several]
        cutoffs = sorted({fold.first for own in fits for fold in own})
        matrix = training_matrix(panel, specs, cutoffs[-1]).withColumns(static)
        matrix = settle(matrix.select(DAY, TARGET, *names, *static), "matrix")
        prepared = dict(zip(cutoffs, prepare(matrix, names, list(static), {0: params}, cutoffs)))

        def forecast(fold: Folds) -> DataFrame:
            ensemble = Ensemble(matrix, names, list(static), {0: params}, prepared=prepared[fold.first])
            return ensemble.recursed(panel, fold, specs, static).drop("trial", "trees")

        return [reduce(DataFrame.unionByName, [forecast(fold) for fold in own]) for own in fits]

    def forecaster(panel: DataFrame, folds: Folds) -> DataFrame:
        return many(panel, [folds])[0]

    forecaster.fitted, forecaster.many = True, many
    return forecaster


def gbt_base(params: TreeParams = TreeParams(), refit: bool = DEFAULTS.refit):
    return boosted_model(params, BASE, refit=refit)


def gbt_rich(params: TreeParams = TreeParams(), refit: bool = DEFAULTS.refit):
    return boosted_model(params, RICH, refit=refit)


def gbt_cat(params: TreeParams = TreeParams(), refit: bool = DEFAULTS.refit):
    """Rich features plus the levels of the id hierarchy."""
    return boosted_model(params, RICH, hierarchy_parts(F.col(KEY)), refit)


def tweedie_glm(power: float = 1.5, specs: list[Spec] = BASE, refit: bool = DEFAULTS.refit):
    return recursive_model(tweedie_learner(power), specs, refit=refit)


def direct_features(contexts: DataFrame, size: int, rates: tuple[int, ...]) -> tuple[DataFrame, list[str]]:
    """Rows per step with the pooled history, scaled by the context's mean, plus the step and its weekday.

    Each rate pools the whole context, in blocks of so many days.
    """
    scale = F.aggregate("past", F.lit(0.0), lambda a, v: a + F.coalesce(v, F.lit(0.0))) / size + 1.0
    out = contexts.withColumn("_scale", scale)
    names: list[str] = []
    for rate in rates:
        out = out.withColumn(f"_pool{rate}", pooled_blocks(F.col("past"), size, rate))
        for i in range(size // rate):
            name = f"pool{rate}_{i}"
            out = out.withColumn(name, F.coalesce(F.get(f"_pool{rate}", F.lit(i)) / F.col("_scale"), F.lit(0.0)))
            names.append(name)
        out = out.drop(f"_pool{rate}")
    out = out.drop("past").select("*", F.posexplode("future").alias("_i", TARGET)).drop("future")
    day = F.date_add("cutoff", F.col("_i") + 1)
    sin, cos = fourier_weekly(day, 1)
    out = out.withColumns({DAY: day, "h": F.col("_i") + 1, "dow": day_of_week(day), "week_sin1": sin,
                           "week_cos1": cos}).drop("_i")
    return out, [*names, "h", "dow", "week_sin1", "week_cos1"]


def direct_frames(panel: DataFrame, folds: Folds, size: int, rates: tuple[int, ...], start: date | None = None
                  ) -> tuple[DataFrame, DataFrame, list[str]]:
    """Training rows with a scaled target, rows to forecast, and the features of a direct model."""
    days = (folds.first - (start or day_span(panel)[0])).days + 1
    origins = (days - size) // folds.horizon
    if origins < 1:
        raise ValueError(f"{days} days of history have no room for a context of {size} days and a horizon")
    past = Folds(folds.first, origins, folds.horizon, folds.horizon)
    train, names = direct_features(fold_context(panel, past, size), size, rates)
    train = train.filter(F.col(TARGET).isNotNull()).withColumn(TARGET, F.col(TARGET) / F.col("_scale"))
    rows, _ = direct_features(fold_context(panel, folds, size), size, rates)
    return train, rows if folds.ahead else rows.filter(F.col(TARGET).isNotNull()), names


def direct_rows(scored: DataFrame, *more: str) -> DataFrame:
    """Forecast rows at the series' own scale."""
    return scored.select(KEY, DAY, "cutoff", "h", TARGET, *more, (F.col("y_hat") * F.col("_scale")).alias("y_hat"))


def direct_multihorizon(learner: Learner | None = None, size: int = 84, rates: tuple[int, ...] = (1, 2, 7),
                        start: date | None = None):
    """All steps at once: one model of the step and the pooled history, without feedback.

    It is trained on all earlier cutoffs, a horizon apart, whose test windows end by the first fold's cutoff and
    whose context lies in the panel. ``start``, the panel's first day, saves the scan for it.
    """
    learner = learner or boosted_learner()

    def forecaster(panel: DataFrame, folds: Folds) -> DataFrame:
        train, rows, names = direct_frames(panel, folds, size, rates, start)
        return direct_rows(learner(train, names, [])(rows))

    forecaster.fitted = True
    return forecaster


def per_category(learner: Learner, of: Column, specs: list[Spec] = BASE):
    """One global model per category, on the same features. ``of`` gives a series' category.

    The panel is stored once, partitioned by category, so each model reads its own files. The categories are the
    stored folders; the driver holds their names, one model each.
    """

    def forecaster(panel: DataFrame, folds: Folds) -> DataFrame:
        path = fresh_path(panel.sparkSession, "categories")
        panel.withColumn("category", of).repartition("category", KEY).write.partitionBy("category").parquet(path)
        stored = panel.sparkSession.read.parquet(path)
        names = [r[0] for r in stored.select("category").distinct().orderBy("category").collect()]
        parts = []
        for name in names:
            mine = stored.filter(F.col("category") == name).drop("category")
            parts.append(recursive_model(learner, specs)(mine, folds).withColumn("category", F.lit(str(name))))
        return reduce(DataFrame.unionByName, parts)

    forecaster.fitted = True
    return forecaster
