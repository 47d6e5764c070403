"""Hand-made frames for the cases that whole tables do not reach."""

import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepanel import contracts as C
from tidepanel.functions import scalars
from tidepanel.functions.ranks import exact_quantiles, running_total
from tidepanel.operators import evaluate as E
from tidepanel.operators import features as X
from tidepanel.operators import forecast as N
from tidepanel.operators import monitor as O
from tidepanel.operators import panel as P
from tidepanel.operators import profile as R
from tidepanel.operators import runs as U
from tidepanel.operators import select as S
from tidepanel.operators import trained as T
from tidepanel.operators import tune as H
from tidepanel.operators.ets import SHORT_GRID, candidate_grid, ets_auto, ets_grid, fit_paths, series_arrays
from tidepanel.operators.folds import Folds, SparsePanel, cv_folds, fold_context
from tidepanel.session import scratch, settle
from tidepanel.sources import readers, writers
from tidepanel.sources.batches import BatchTable

START = date(2020, 1, 1)


def forecasts(spark, rows):
    """rows of (model, y, y_hat, lo, hi)"""
    data = [(f"s{i}", START + timedelta(days=i), y, m, p, lo, hi, START, "baseline")
            for i, (m, y, p, lo, hi) in enumerate(rows)]
    return spark.createDataFrame(data, "unique_id string, ds date, y double, model string, y_hat double, "
                                       "lo_80 double, hi_80 double, cutoff date, stage string")


def panel(spark, series):
    """{id: values from START on}, None values are skipped"""
    rows = [(k, START + timedelta(days=i), float(v)) for k, vs in series.items() for i, v in enumerate(vs) if v is not None]
    return spark.createDataFrame(rows, "unique_id string, ds date, y double")


def scores(df):
    return {r["metric"]: r["score"] for r in E.score_forecasts(df, "x").collect()}


def test_golden_metrics(spark):
    rows = zip([100.0, 200.0, 150.0, 80.0, 120.0], [115.0, 180.0, 160.0, 75.0, 130.0], [80.0, 150.0, 120.0, 50.0, 90.0],
               [140.0, 220.0, 200.0, 110.0, 160.0])
    got = scores(forecasts(spark, [("m", *r) for r in rows]))
    assert got["wMAPE"] == pytest.approx(0.0923077, abs=1e-7)
    assert got["Bias"] == pytest.approx(0.0153846, abs=1e-7)
    assert got["IntervalScore_80"] == pytest.approx(68.0)
    assert got["Coverage_80"] == 1.0


def test_zero_actuals_give_null(spark):
    got = scores(forecasts(spark, [("m", 0.0, 1.0, 0.0, 2.0), ("m", 0.0, 3.0, 0.0, 2.0)]))
    assert got["wMAPE"] is None and got["Bias"] is None


def test_missing_bound_counts_as_miss(spark):
    got = scores(forecasts(spark, [("m", 1.0, 1.0, 1.0, 2.0), ("m", 1.0, 1.0, None, None)]))
    assert got["IntervalScore_80"] is None and got["Coverage_80"] == 0.5


def test_interval_ends_are_inside(spark):
    assert scores(forecasts(spark, [("m", 1.0, 1.0, 1.0, 2.0), ("m", 2.0, 1.0, 1.0, 2.0)]))["Coverage_80"] == 1.0


def test_no_interval_columns_give_two_metrics(spark):
    df = forecasts(spark, [("m", 1.0, 1.0, None, None)]).drop("lo_80", "hi_80")
    assert set(scores(df)) == {"wMAPE", "Bias"}


def test_missing_column_is_named(spark):
    with pytest.raises(C.ContractError, match="y_hat"):
        E.score_forecasts(forecasts(spark, [("m", 1.0, 1.0, 0.0, 2.0)]).drop("y_hat"), "x")


def test_clip_keeps_null(spark):
    row = spark.sql("SELECT double(NULL) AS a, double(-1) AS b").select(
        scalars.clip_lower(F.col("a")).alias("a"), scalars.clip_lower(F.col("b")).alias("b")).first()
    assert row["a"] is None and row["b"] == 0.0


def test_fill_missing(spark):
    df = forecasts(spark, [("m", 1.0, None, None, None), ("m", 1.0, -2.0, None, None)])
    assert [r["y_hat"] for r in E.fill_missing(df).collect()] == [0.0, 0.0]
    bare = E.fill_missing(df.drop("lo_80", "hi_80"), bounds_from_point=True)
    assert [(r["lo_80"], r["hi_80"]) for r in bare.collect()] == [(0.0, 0.0)] * 2


def test_contracts(spark):
    good = panel(spark, {"a": [1, 2]})
    assert C.validate(good, "panel", unique=True).count() == 2
    with pytest.raises(C.ContractError, match="unknown contract"):
        C.validate(good, "nothing")
    with pytest.raises(C.ContractError, match="missing required columns"):
        C.validate(good.drop("y"), "panel")
    with pytest.raises(C.ContractError, match="null values"):
        C.validate(good.withColumn("y", F.lit(float("nan"))), "panel")
    with pytest.raises(C.ContractError, match="cannot be cast"):
        C.validate(good.withColumn("ds", F.lit("soon")), "panel")
    with pytest.raises(C.ContractError, match="repeated keys"):
        C.validate(good.union(good), "panel", unique=True)
    score = E.score_forecasts(forecasts(spark, [("m", 1.0, 1.0, 0.0, 2.0)]), "x")
    with pytest.raises(C.ContractError, match="per_series"):
        C.validate(score.withColumn("aggregation_scope", F.lit("per_series")), "score")


def test_wide_leaderboard_is_not_a_score_table(spark):
    board = E.build_leaderboard([E.score_forecasts(forecasts(spark, [("m", 1.0, 1.0, 0.0, 2.0)]), "x")])
    with pytest.raises(C.ContractError, match="metric"):
        C.validate(board, "score")
    assert C.validate(board, "leaderboard").count() == 1


def test_dataset_errors(spark, tmp_path):
    with pytest.raises(KeyError):
        readers.load_dataset(spark, {}, "x")
    with pytest.raises(FileNotFoundError):
        readers.load_dataset(spark, {"x": readers.Dataset(str(tmp_path / "x.parquet"))}, "x")
    with pytest.raises(ValueError):
        readers.load_dataset(spark, {"x": readers.Dataset(str(tmp_path / "x.pkl"))}, "x")
    with pytest.raises(FileNotFoundError, match="sales.csv"):
        readers.read_raw(spark, str(tmp_path))


def test_melt_with_missing_day_label(spark):
    wide = spark.createDataFrame([("i", "s", 1, 3)], "item_id string, store_id string, d_1 int, d_3 int")
    assert sorted((r["d"], r["y"]) for r in P.melt_wide(wide).collect()) == [("d_1", 1), ("d_3", 3)]


def test_unknown_calendar_day_is_caught(spark):
    melted = P.key_sales(spark.createDataFrame([("i", "s", "d_9", 1)], "item_id string, store_id string, d string, y int"))
    calendar = spark.createDataFrame([("d_1", START)], "d string, ds date")
    with pytest.raises(C.ContractError, match="ds"):
        C.validate(P.join_calendar(melted, calendar), "panel")


def test_fill_gaps_ranges(spark):
    p = panel(spark, {"a": [1, None, None, 4], "b": [None, 5]})
    count = lambda **k: {r[0]: r[1] for r in P.fill_gaps(p, **k).groupBy("unique_id").count().collect()}
    assert count() == {"a": 4, "b": 3}
    assert count(end="series") == {"a": 4, "b": 1}
    assert count(start="global") == {"a": 4, "b": 4}
    filled = P.fill_gaps(p)
    assert P.zero_fill(filled).agg(F.sum("y")).first()[0] == 10.0
    assert [r["y"] for r in P.forward_fill(filled).filter("unique_id = 'a'").orderBy("ds").collect()] == [1, 1, 1, 4]
    with pytest.raises(ValueError):
        P.assert_no_gaps(p)
    assert P.assert_no_gaps(filled) is filled


def test_policy_borders(spark):
    days = 365 + 84
    series = {
        "first_day_fits": [1] * (days + 1),
        "one_day_short": [None] + [2] * days,
        "never_sells": [0] * (days + 1),
    }
    p = panel(spark, series)
    kept = [r["unique_id"] for r in S.policy_series(p).collect()]
    assert kept == ["first_day_fits"]
    zeros = panel(spark, {"half": [0, 1] * 50 + [1] * 85, "more": [0, 1] * 49 + [0] * 2 + [1] * 85})
    assert [r["unique_id"] for r in S.policy_series(zeros, min_history=100).collect()] == ["half"]
    tie = panel(spark, {"b": [1, 2], "a": [2, 1], "c": [0, 1]})
    assert [r["unique_id"] for r in S.top_series(tie, 2).collect()] == ["a", "b"]
    assert S.top_series(tie, 10).count() == 3


def test_folds_do_not_leak(spark):
    p = panel(spark, {"a": list(range(200))})
    folds = Folds.of(p)
    assert folds.cutoffs[-1] == START + timedelta(days=199 - 28)
    rows = cv_folds(p, folds)
    assert rows.filter("part = 'train' AND ds > cutoff").count() == 0
    assert rows.filter("part = 'test'").count() == 3 * 28
    context = fold_context(p, folds, 10).orderBy("cutoff").first()
    assert context["past"][-1] == 199 - 84 and context["future"][0] == 199 - 83 and len(context["future"]) == 28


def test_fold_context_with_gaps(spark):
    values = [float(i) for i in range(120)]
    values[115 - 28] = None
    p = panel(spark, {"a": values})
    context = fold_context(p, Folds.of(p, windows=1), 6).first()
    assert context["past"] == [86.0, None, 88.0, 89.0, 90.0, 91.0]


def test_array_features_equal_window_features(spark):
    random.seed(1)
    p = panel(spark, {"a": [random.random() for _ in range(120)], "b": [random.randint(0, 3) for _ in range(120)]})
    specs = X.lagged(X.RICH)
    by_window = X.add_features(p, specs).filter(F.col("ds") == START + timedelta(days=119 - 27))
    contexts = fold_context(p, Folds.of(p, windows=1), X.reach(specs))
    by_array = contexts.select("unique_id", *[s.at(F.col("past"), F.lit(0)).alias(s.name) for s in specs])
    left = {r["unique_id"]: r.asDict() for r in by_window.collect()}
    for row in by_array.collect():
        for s in specs:
            assert row[s.name] == pytest.approx(left[row["unique_id"]][s.name], abs=1e-9), s.name


def test_recursion_follows_its_own_output(spark):
    p = panel(spark, {"a": list(range(1, 120))})
    rows = T.recursive_forecast(T.linear_scorer({"lag7": 2.0}), p, Folds.of(p, windows=1), [X.Lag(7)])
    got = {r["h"]: r["y_hat"] for r in rows.collect()}
    last = 119 - 28
    assert got[1] == 2 * (last - 6) and got[8] == 4 * (last - 6) and got[28] == 16 * last


def test_recursion_shuffles_once(spark):
    p = panel(spark, {"a": list(range(1, 200)), "b": list(range(1, 200))})
    rows = T.recursive_forecast(T.linear_scorer({"lag7": 1.0, "mean_l7_w28": 0.1}), p, Folds.of(p),
                                [X.Lag(7), X.Rolling("mean", 7, 28)])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_day_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "panel")
    writers.write_panel(panel(spark, {"a": list(range(200))}), path)
    stored = spark.read.parquet(path)
    plan = N.seasonal_naive(stored, Folds.of(stored))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ds,2020-04-" in plan and plan.count("Exchange") == 1


def test_features_use_one_window(spark):
    plan = X.add_features(panel(spark, {"a": [1, 2, 3]}), X.RICH)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1 and plan.count("Exchange") == 1


def test_sample_limits_rows_before_the_shuffle(spark):
    series = spark.range(100).select(F.col("id").cast("string").alias("unique_id"), (F.col("id") % 2).alias("s"))
    sample = O.stratified_sample(series, "s", 5)
    assert "WindowGroupLimit" in sample._jdf.queryExecution().executedPlan().toString()
    assert sample.count() == 10


def test_exact_quantiles_on_large_and_skewed_groups(spark):
    rng = np.random.default_rng(3)
    normal, flat = rng.normal(size=150_000), np.where(rng.random(150_000) < 0.6, 1.0, rng.random(150_000))
    rows = spark.createDataFrame(
        [("normal", float(v)) for v in normal] + [("flat", float(v)) for v in flat] + [("one", 4.0)], "g string, v double")
    probs = [0.0, 0.1, 0.5, 0.99, 1.0]
    got = {(r["g"], r["prob"]): r["quantile"] for r in exact_quantiles(rows, "v", probs, ["g"]).collect()}
    for name, values in (("normal", normal), ("flat", flat), ("one", np.array([4.0]))):
        for p in probs:
            assert got[name, p] == pytest.approx(np.quantile(values, p), abs=1e-12)
    whole = {r["prob"]: r["quantile"] for r in exact_quantiles(rows.filter("g = 'normal'"), "v", [0.3]).collect()}
    assert whole[0.3] == pytest.approx(np.quantile(normal, 0.3), abs=1e-12)


def test_running_total_with_ties(spark):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.lit(2).alias("v"))
    out = running_total(rows, "v", [F.desc("v"), F.col("k")], "total", "place")
    assert sorted(r["total"] for r in out.collect()) == [2 * i for i in range(1, 1001)]
    ordered = [r["k"] for r in out.orderBy("place").collect()]
    assert ordered == sorted(ordered)


def test_histogram_keeps_the_maximum(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,), (1.0,)], "v double")
    assert [r["n"] for r in R.histogram(df, "v", 2).orderBy("bin").collect()] == [1, 3]
    one = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert sum(r["n"] for r in R.histogram(one, "v", 5).collect()) == 2


def test_leaderboard_keeps_null_metric(spark):
    df = forecasts(spark, [("m", 1.0, 1.0, None, None), ("n", 1.0, 2.0, 0.0, 3.0)])
    board = E.build_leaderboard([E.score_forecasts(df, "x")])
    rows = {r["model"]: r for r in board.collect()}
    assert rows["m"]["IntervalScore_80"] is None and rows["n"]["IntervalScore_80"] == 3.0
    ranked = {r["model"]: r for r in E.leaderboard_rank(board).collect()}
    assert ranked["m"]["position"] == 1 and ranked["m"]["margin_to_next"] == 1.0
    choice = E.champion_challenger(board).first()
    assert choice["champion"] == "m" and choice["defender"] == "m"


def test_ets_follows_season_and_trend():
    t = np.arange(200.0)
    season = np.tile([0, 1, 2, 3, 4, 5, 6.0], 40)
    values = np.stack([10 + 3 * season[:200], 5 + 0.5 * t])
    out = fit_paths(values, candidate_grid(), 28, 7)
    assert np.allclose(out[0], 10 + 3 * season[200:228], atol=0.5)
    assert np.allclose(out[1], 5 + 0.5 * np.arange(200, 228), rtol=0.05)


def test_smoothing_on_the_jvm_equals_numpy(spark):
    rng = random.Random(4)
    p = panel(spark, {
        "a": [20 + 5 * (i % 7) + rng.random() for i in range(130)], "b": [3 * i + rng.randint(0, 9) for i in range(130)],
        "gaps": [None if i % 11 == 3 else 10 + (i % 7) + rng.random() for i in range(130)],
        "late": [None] * 90 + [rng.randint(0, 9) for _ in range(40)], "flat": [4] * 130,
    })
    folds = Folds.of(p, windows=2)
    grid = np.array([c.row() for c in SHORT_GRID])
    got = {(r.unique_id, r.cutoff, r.h): r.y_hat for r in ets_grid(p, folds).collect()}
    for row in series_arrays(p, folds).collect():
        values = np.array([[np.nan if v is None else v for v in row.past]])
        want = fit_paths(values, grid, folds.horizon, 7)[0]
        for h in range(1, 29):
            if (row.unique_id, row.cutoff, h) in got:
                assert got[row.unique_id, row.cutoff, h] == pytest.approx(want[h - 1], rel=1e-9, abs=1e-9)
    assert len(got) > 4 * 2 * 25
    plan = ets_grid(p, folds)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "Pandas" not in plan


def test_models_beat_naive_on_a_weekly_series(spark):
    rng = random.Random(5)
    weekly = [20.0 * (1 + i % 7) for i in range(7)]
    p = panel(spark, {f"s{k}": [(k + 1) * weekly[i % 7] + rng.random() for i in range(400)] for k in range(4)})
    folds = Folds.of(p)
    trees = T.TreeParams(trees=10, rate=0.3, depth=4, min_rows=5)
    models = {
        "naive": N.naive, "snaive": N.seasonal_naive, "ets": ets_auto, "base": T.gbt_base(trees),
        "direct": T.direct_multihorizon(T.tree_learner(trees)), "tweedie": T.tweedie_glm(1.5),
    }
    loss = {}
    for name, model in models.items():
        rows = model(p, folds)
        assert rows.count() == 4 * 3 * 28, name
        loss[name] = H.pooled_loss(rows)
    assert all(loss[m] < loss["naive"] for m in models if m != "naive"), loss


def test_trained_models_repeat(spark):
    rng = random.Random(7)
    p = panel(spark, {f"s{k}": [rng.randint(0, 9) for _ in range(300)] for k in range(3)})
    run = T.gbt_rich(T.TreeParams(trees=3, depth=3))
    folds = Folds.of(p)
    a, b = ([tuple(r) for r in run(p, folds).orderBy("unique_id", "cutoff", "h").collect()] for _ in range(2))
    assert a == b


def test_paths_repeat_and_bound_the_median(spark):
    rng = random.Random(9)
    p = panel(spark, {"a": [rng.randint(0, 9) for _ in range(500)]})
    folds = Folds.of(p)
    first, second = (sorted(map(tuple, N.sample_paths(p.repartition(n), folds).collect())) for n in (1, 5))
    assert first == second
    assert N.path_summary(N.sample_paths(p, folds)).filter("lo_80 > y_hat OR y_hat > hi_80 OR lo_80 < 0").isEmpty()


def test_search_space(spark):
    a, b = (sorted(map(tuple, H.search_space(spark, 50).repartition(n).collect())) for n in (1, 4))
    assert a == b
    rows = H.search_space(spark, 200).collect()
    assert {r["lags"] for r in rows} == {"7_14_28", "7_14_21_28", "7_28"}
    assert all(0.005 <= r["learning_rate"] <= 0.2 and 15 <= r["num_leaves"] <= 127 for r in rows)
    rows = H.search_space(spark, 200, tweedie=True).collect()
    assert all(1.0 <= r["tweedie_variance_power"] < 1.9 and 1e-4 <= r["reg_lambda"] <= 1 for r in rows)
    direct = H.search_space_direct(spark, 100).collect()
    assert {r["input_size"] for r in direct} == {28, 56, 84}
    assert all(r["max_steps"] in (100, 200, 300, 400, 500) for r in direct)


def test_candidates_are_fitted_with_their_settings(spark):
    for row in H.search_space(spark, 20).collect():
        fit = H.estimator_for(row.asDict())
        assert fit.getMaxIter() == row["n_estimators"] and fit.getStepSize() == row["learning_rate"]
        assert 2 ** (fit.getMaxDepth() - 1) < row["num_leaves"] <= 2 ** fit.getMaxDepth()
        assert fit.getMinInstancesPerNode() == row["min_child_samples"]
        assert fit.getSubsamplingRate() == row["subsample"]
        assert float(fit.getFeatureSubsetStrategy()) == row["colsample_bytree"]
        assert [x.lag for x in H.specs_for(row["lags"])[:-3]] == [int(x) for x in row["lags"].split("_")]
    for row in H.search_space(spark, 20, tweedie=True).collect():
        fit = H.estimator_for(row.asDict())
        assert fit.getVariancePower() == row["tweedie_variance_power"] and fit.getRegParam() == row["reg_lambda"]
    for row in H.search_space_direct(spark, 20).collect():
        params = H.direct_params(row.asDict())
        assert params.trees == row["max_steps"] and params.rate == row["learning_rate"]
    # every setting of a row has an effect
    used = {"lags", "n_estimators", "learning_rate", "num_leaves", "min_child_samples", "subsample", "colsample_bytree"}
    assert set(H.TREE_RANGES) == used and set(H.TWEEDIE_RANGES) == {"lags", "tweedie_variance_power", "reg_lambda"}


def test_search_feeds_a_fit(spark):
    p = panel(spark, {f"s{k}": [10 * (k + i % 7) for i in range(200)] for k in range(2)})
    folds = Folds.of(p, windows=1)
    found = H.search_cv(p, H.search_space(spark, 2, tweedie=True), H.recursive_candidate, folds)
    best = H.winner(found)
    losses = {r["trial"]: r["loss"] for r in found.collect()}
    assert losses[best["trial"]] == min(losses.values())
    assert H.pooled_loss(H.recursive_candidate(best)(p, folds)) == pytest.approx(losses[best["trial"]], rel=1e-6)


def test_intervals_leave_the_forecast_alone(spark):
    rng = random.Random(3)
    p = panel(spark, {f"s{k}": [rng.randint(0, 9) + i % 7 for i in range(320)] for k in range(3)})
    folds = Folds.of(p)
    trees = T.TreeParams(trees=4, depth=3, min_rows=2)
    for model in (T.gbt_base(trees), T.direct_multihorizon(T.tree_learner(trees)), ets_auto, N.seasonal_naive):
        key = ["unique_id", "cutoff", "h", "ds", "y", "y_hat"]
        plain = sorted(map(tuple, model(p, folds).select(*key).collect()))
        rows = N.conformal_interval(p, model, folds)
        assert sorted(map(tuple, rows.select(*key).collect())) == plain
        assert rows.filter("lo_80 IS NULL OR lo_80 > y_hat OR hi_80 < y_hat").isEmpty()


def test_forecasts_beyond_the_last_day(spark):
    p = panel(spark, {"a": [1 + i % 7 for i in range(200)], "b": [5.0] * 200})
    last = START + timedelta(days=199)
    ahead = Folds.beyond(last)
    trees = T.TreeParams(trees=3, depth=3, min_rows=2)
    blend = lambda q, f: T.recursive_forecast(T.linear_scorer({"lag7": 1.0}), q, f, [X.Lag(7)])
    models = (N.naive, N.seasonal_naive, N.naive_gaussian, ets_auto, T.gbt_base(trees), blend,
              T.direct_multihorizon(T.tree_learner(trees)), N.per_series(lambda past, h: [past[-1]] * h, 7))
    for model in models:
        rows = model(p, ahead).collect()
        assert len(rows) == 2 * 28 and {r["ds"] for r in rows} == {last + timedelta(days=i) for i in range(1, 29)}
        assert all(r["y"] is None and r["y_hat"] is not None for r in rows)
    week = {r["h"]: r["y_hat"] for r in blend(p, ahead).filter("unique_id = 'a'").collect()}
    assert all(week[h] == 1 + (199 + h) % 7 for h in range(1, 29))
    bands = N.conformal_interval(p, N.seasonal_naive, Folds.beyond(last))
    assert bands.count() == 56
    assert N.sample_paths(p, ahead, 3).count() == 2 * 28 * 3


def test_last_known_value(spark):
    values = [float(i) for i in range(120)]
    values[119 - 28] = None
    p = panel(spark, {"a": values})
    assert {r["y_hat"] for r in N.naive(p, Folds.of(p, windows=1)).collect()} == {90.0}


def test_sparse_panel_equals_the_filled_one(spark):
    rows = panel(spark, {"a": [1, None, 3] + [None] * 90 + [5, None], "b": [None] * 20 + [2] + [None] * 75, "c": [7] * 96})
    span = P.day_span(rows)
    full = P.zero_fill(P.fill_gaps(rows, "global", "global", span))
    sparse = SparsePanel(rows, rows.select("unique_id").distinct(), span)
    folds = Folds(span[1], windows=2, step=28, horizon=28)
    for model in (N.naive, N.seasonal_naive):
        a, b = (sorted(map(tuple, model(x, folds).collect())) for x in (full, sparse))
        assert a == b and len(a) == 3 * 2 * 28


def test_short_series_get_no_paths(spark):
    p = panel(spark, {"a": [1] * 60, "b": [None] * 20 + [2] * 40})
    folds = Folds.of(p, windows=1)  # b has 12 days before the cutoff, less than two weeks
    assert {r["unique_id"] for r in N.sample_paths(p, folds, 2).collect()} == {"a"}


def test_smoothing_keeps_days_and_unknown_values(spark):
    p = panel(spark, {"a": [1, None, 3, 4] + [5] * 30, "b": [None, None] + [2] * 32})
    arrays = {r["unique_id"]: r for r in series_arrays(p, Folds.of(p, windows=1)).collect()}
    assert arrays["a"]["past"] == [1, None, 3, 4, 5, 5] and arrays["b"]["past"] == [2] * 4
    weekly = np.tile(np.arange(7.0), 30)
    gappy = weekly.copy()
    gappy[50:55] = np.nan
    out = fit_paths(np.stack([weekly, gappy]), candidate_grid(), 28, 7)
    assert np.allclose(out[1], out[0], atol=0.5) and len(candidate_grid()) <= 200


def test_quantiles_on_every_size(spark):
    rng = random.Random(8)
    for n in (1, 2, 3, 7, 100, 3000):
        values = [float(rng.choice([rng.randint(0, 5), rng.random()])) for _ in range(n)]
        df = spark.createDataFrame([(v, "g") for v in values] + [(1.5, None), (None, "g")], "v double, k string")
        probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
        got = {r["prob"]: r["quantile"] for r in exact_quantiles(df.filter("k = 'g'"), "v", probs).collect()}
        assert [got[p] for p in probs] == pytest.approx(list(np.quantile(values, probs)))
    by = {(r["k"], r["prob"]): r["quantile"] for r in exact_quantiles(df.fillna("h", ["k"]), "v", [0.5], ["k"]).collect()}
    assert by["g", 0.5] == pytest.approx(np.median(values)) and by["h", 0.5] == 1.5


def test_backfill_leaves_other_partitions_alone(spark, tmp_path):
    path = str(tmp_path / "features")
    p = panel(spark, {"a": [i % 11 for i in range(1200)], "b": [i % 5 for i in range(1200)]})
    specs = [X.Lag(7), X.Rolling("mean", 7, 28)]
    O.write_features(p, specs, path)

    def files():
        return {str(f.relative_to(path)) for f in (tmp_path / "features").rglob("*.parquet")}

    before = files()
    fixes = spark.createDataFrame([("a", START + timedelta(days=500), 99.0)], "unique_id string, ds date, y double")
    assert O.backfill_features(p, fixes, specs, path) == [2021]
    kept = {f for f in before if not f.startswith("year=2021")}
    assert kept <= files() and not {f for f in before if f.startswith("year=2021")} & files()
    corrected = p.join(fixes.withColumnRenamed("y", "new"), ["unique_id", "ds"], "left")
    corrected = corrected.select("unique_id", "ds", F.coalesce("new", "y").alias("y"))
    want = X.add_features(corrected, specs).drop("y").withColumn("year", F.year("ds"))
    got = spark.read.parquet(path)
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    day = START + timedelta(days=1199)
    for d in (day - timedelta(days=1), day, day):
        O.write_snapshot(p, specs, str(tmp_path / "snap"), d)
    assert spark.read.parquet(str(tmp_path / "snap")).groupBy("snapshot_date").count().count() == 2


def test_per_category_reads_its_own_files(spark):
    p = panel(spark, {f"{c}_{k}": [(k + 1) * (5 + i % 7) for i in range(200)] for c in "xy" for k in range(2)})
    rows = T.per_category(T.tweedie_learner(1.5), F.split("unique_id", "_")[0])(p, Folds.of(p, windows=1)).collect()
    assert {(r["category"], r["unique_id"][0]) for r in rows} == {("x", "x"), ("y", "y")} and len(rows) == 4 * 28


def test_contract_error_has_all_values(spark):
    score = E.score_forecasts(forecasts(spark, [("m", 1.0, 1.0, 0.0, 2.0)]), "x")
    many = score.withColumn("aggregation_scope", F.explode(F.transform(F.sequence(F.lit(100), F.lit(149)),
                                                                       lambda i: i.cast("string"))))
    with pytest.raises(C.ContractError, match="50 values from '100' to '149'") as error:
        C.validate(many, "score")
    assert error.value.values["aggregation_scope"].count() == 50
    with pytest.raises(FileNotFoundError, match="prices.csv"):
        readers.read_raw(spark, *_raw_without_prices(spark))


def _raw_without_prices(spark):
    from tidepanel.session import fresh_path

    folder = fresh_path(spark, "raw")
    spark.createDataFrame([("i", "s", 1)], "item_id string, store_id string, d_1 int").write.option("header", True).csv(
        f"{folder}/sales.csv")
    spark.createDataFrame([("d_1", START)], "d string, date date").write.option("header", True).csv(f"{folder}/calendar.csv")
    return (folder,)


def test_scratch_empties_what_was_settled(spark):
    before = settle(spark.range(5), "before")
    with pytest.raises(RuntimeError), scratch(spark):
        inside = settle(spark.range(7), "inside")
        assert inside.count() == 7
        raise RuntimeError
    assert before.count() == 5 and spark.read.parquet(inside.inputFiles()[0].rsplit("/", 1)[0]).count() == 0


def test_depth_beyond_the_learner_is_refused():
    with pytest.raises(ValueError, match="depth"):
        T.TreeParams.of({"num_leaves": 2**31})


def test_parameters_skip_comments():
    p = T.TreeParams.of({"_comment": "x", "n_estimators": 675, "num_leaves": 95, "subsample": 0.8, "reg_alpha": 1})
    assert (p.trees, p.depth, p.row_share) == (675, 7, 0.8)


def test_best_so_far_and_candidate(spark):
    trials = spark.createDataFrame([(0, 3.0, "a"), (1, 1.0, "b"), (2, 2.0, "c")], "trial long, loss double, lags string")
    assert [r["best_loss"] for r in E.best_so_far(trials).orderBy("trial").collect()] == [3.0, 1.0, 1.0]
    best = E.best_candidate(trials, {"objective": "tweedie"}).first()
    assert best["lags"] == "b" and best["objective"] == "tweedie"


def test_fallback_and_freshness(spark):
    expected = panel(spark, {"a": [0, 0]})
    now = expected.filter(F.col("ds") == START).withColumn("y_hat", F.lit(5.0))
    old = expected.withColumn("y_hat", F.lit(1.0))
    rows = {r["ds"]: (r["y_hat"], r["used_fallback"]) for r in O.fallback_forecast(expected, now, old).collect()}
    assert rows == {START: (5.0, False), START + timedelta(days=1): (1.0, True)}


def test_batches_are_there_once_and_whole(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"), "unique_id string, ds date, y double, store string", ("store",), "panel")
    assert table.read().columns == ["unique_id", "ds", "y", "store", "batch"] and table.read().count() == 0

    def rows(series):
        return panel(spark, series).withColumn("store", F.concat(F.lit("s/"), "unique_id"))

    def there():
        return sorted((r.unique_id, r.y, r.store, r.batch) for r in table.read().collect())

    assert table.append(rows({"a": [1, 2], "b": [3]}), "1 a/b")
    want = [("a", 1.0, "s/a", "1 a/b"), ("a", 2.0, "s/a", "1 a/b"), ("b", 3.0, "s/b", "1 a/b")]
    assert there() == want
    assert not table.append(rows({"a": [1, 2], "b": [3]}), "1 a/b") and there() == want
    # a run that stops after it has staged, or fails while it stages, changes nothing; the next one adds its rows once
    table.stage(rows({"c": [4]}), "2")
    with pytest.raises(Exception, match="bad value in column y"):
        table.append(rows({"c": [4]}).withColumn("y", F.lit(None).cast("double")), "2")
    assert there() == want
    assert table.append(rows({"c": [4]}), "2") and there() == [*want, ("c", 4.0, "s/c", "2")]
    # two runs that stage and commit the same batch side by side
    first, second = table.stage(rows({"d": [5]}), "3"), table.stage(rows({"d": [5]}), "3")
    table.commit("3", first)
    table.commit("3", second)
    assert there() == [*want, ("c", 4.0, "s/c", "2"), ("d", 5.0, "s/d", "3")]
    assert table.append(rows({}), "empty") and table.commits().count() == 4 and table.read("empty").count() == 0
    assert [r.n_rows for r in table.commits().orderBy("batch").collect()] == [3, 1, 1, 0]


def test_the_last_valid_run_is_served(spark, tmp_path):
    known = U.largest_known(panel(spark, {"a": [1, 10], "b": [2, 4]}))
    days = [START + timedelta(days=i) for i in range(6)]

    def run(day, values):
        rows = [(k, START + timedelta(days=9), "m", v, day, "ml") for k, v in values.items()]
        return spark.createDataFrame(rows, "unique_id string, ds date, model string, y_hat double, cutoff date, stage string")

    table = U.run_table(spark, str(tmp_path / "runs"))
    assert U.store_run(table, run(days[1], {"a": 1.0, "b": 1.0, "other": 1e9}), days[1])
    assert not U.store_run(table, run(days[1], {"a": 5.0, "b": 5.0}), days[1])  # the job of that day ran again
    U.store_run(table, run(days[2], {"a": 30.0, "b": 12.5}), days[2])  # above three times the largest known
    with pytest.raises(Exception, match="bad value in column y_hat"):  # refused before it is stored
        U.store_run(table, run(days[3], {"a": float("nan"), "b": 1.0}), days[3])
    U.store_run(table, run(days[3], {"a": float("inf"), "b": -1.0}), days[3])
    U.store_run(table, run(days[4], {"a": 2.0}), days[4])  # a series is missing
    U.store_run(table, run(days[5], {"a": 3.0, "b": 0.0}), days[5])
    checks = U.run_checks(table.read(), known)
    rows = {r.run_date: tuple(r)[1:] for r in checks.collect()}
    assert rows == {days[1]: (3, 0, 0, True), days[2]: (2, 1, 0, False), days[3]: (2, 2, 0, False),
                    days[4]: (1, 0, 1, False), days[5]: (2, 0, 0, True)}
    asked = spark.createDataFrame([(d, k, START + timedelta(days=9)) for d in days for k in "ab"],
                                  "as_of date, unique_id string, ds date")
    got = {(r.as_of, r.unique_id): (r.y_hat, r.run_date, r.used_fallback) for r in
           U.fallback_forecast(asked, table.read(), checks).collect()}
    assert got[days[0], "a"] == (None, None, False) and got[days[1], "b"] == (1.0, days[1], False)
    assert all(got[days[i], "a"] == (1.0, days[1], True) for i in (2, 3, 4)) and got[days[5], "a"] == (3.0, days[5], False)
    odd = run(days[0], {"a": float("nan"), "b": None}).withColumn("run_date", F.lit(days[0]))
    assert tuple(U.run_checks(odd, known).first()) == (days[0], 2, 2, 0, False)
    assert U.run_checks(odd.limit(0), known).count() == 0
    events = U.event_table(spark, str(tmp_path / "events"))
    expected = asked.select("unique_id", "ds").distinct()
    for day in (days[3], days[4], days[3], days[5]):
        U.serve(table, events, expected, known, day)
    found = events.read().orderBy("as_of").collect()
    assert [tuple(r)[:5] for r in found] == [(days[3], days[3], days[1], 2, 0), (days[4], days[4], days[1], 0, 1)]


def test_append_adds_and_overwrite_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    first = panel(spark, {"a": [1, 2], "b": [3]}).withColumn("store", F.col("unique_id"))
    writers.append_partitions(first, path, "panel", ("store",))
    more = panel(spark, {"c": [4]}).withColumn("store", F.col("unique_id"))
    writers.append_partitions(more, path, "panel", ("store",))
    assert spark.read.parquet(path).count() == 4
    writers.overwrite_partitions(panel(spark, {"a": [9]}).withColumn("store", F.col("unique_id")), path, ("store",))
    rows = sorted((r["unique_id"], r["y"]) for r in spark.read.parquet(path).collect())
    assert rows == [("a", 9.0), ("b", 3.0), ("c", 4.0)]
    with pytest.raises(Exception, match="bad value in column y"):
        writers.append_partitions(first.withColumn("y", F.lit(None).cast("double")), path, "panel", ("store",))
    assert spark.read.parquet(path).count() == 3


def test_enforce_keeps_good_rows(spark):
    df = forecasts(spark, [("m", 1.0, 1.0, None, 2.0)]).withColumn("note", F.lit("x")).withColumn("y", F.lit("1.5"))
    row = C.enforce(df, "forecast").first()
    assert (row["y"], row["lo_80"], row["note"]) == (1.5, None, "x")
    with pytest.raises(Exception, match="bad value in column hi_80: wide"):
        C.enforce(df.withColumn("hi_80", F.lit("wide")), "forecast").collect()
    score = E.score_forecasts(forecasts(spark, [("m", 1.0, 1.0, 0.0, 2.0)]), "x")
    assert C.enforce(score, "score").count() == 4
    with pytest.raises(Exception, match="per_series"):
        C.enforce(score.withColumn("aggregation_scope", F.lit("per_series")), "score").collect()


def test_final_tables_prefer_the_richest_variant(spark):
    base = forecasts(spark, [("base", 1.0, 1.0, 0.0, 2.0)])
    rich = forecasts(spark, [("rich", 1.0, 1.0, 0.0, 2.0)])
    every, _, board = E.final_tables(forecasts(spark, [("n", 1.0, 2.0, 0.0, 3.0)]), {"base": base, "rich": rich},
                                     forecasts(spark, [("d", 1.0, 3.0, None, None)]), "x")
    assert {r["model"] for r in every.collect()} == {"n", "rich", "d"}
    assert [r["model"] for r in board.collect()] == ["rich", "n", "d"]
