"""Daily features from stored states, and grouped tweedie models."""

import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import functions as F

from tidepanel.operators import features as X
from tidepanel.operators import glm as G
from tidepanel.operators import tune as H
from tidepanel.operators.folds import Folds
from tidepanel.operators.state import FeatureTable, state_of
from tidepanel.session import settle

START = date(2020, 1, 1)


def panel(spark, series):
    rows = [(k, START + timedelta(days=i), None if v is None else float(v)) for k, vs in series.items() for i, v in vs]
    return spark.createDataFrame(rows, "unique_id string, ds date, y double")


def cells(df, names):
    return sorted(tuple(None if v is None else round(v, 9) if isinstance(v, float) else v for v in r)
                  for r in df.select(names).collect())


def test_states_give_the_features_of_windows(spark, tmp_path):
    rng = random.Random(6)
    p = panel(spark, {
        "a": [(i, rng.randint(0, 9)) for i in range(80)], "b": [(i, rng.randint(0, 9)) for i in range(40, 80)],
        "new": [(i, 5) for i in range(76, 80)],
    })
    specs = X.RICH
    table = FeatureTable(spark, str(tmp_path / "t"), specs)
    table.begin(p, START + timedelta(days=74))
    for i in (75, 76, 77, 77, 78, 79):  # a day's run repeats
        table.add(p, START + timedelta(days=i))
    names = ["unique_id", "ds", "y", *[s.name for s in specs]]
    windows = X.add_features(p, specs)
    for i in (75, 77, 79):
        day = START + timedelta(days=i)
        assert cells(table.features(day), names) == cells(windows.filter(F.col("ds") == F.lit(day)), names)
    last = START + timedelta(days=79)
    assert cells(table.state(last), table.state(last).columns) == cells(state_of(p, last, 56), table.state(last).columns)


def test_a_day_without_a_row_is_unknown(spark, tmp_path):
    p = panel(spark, {"a": [(0, 1), (1, 2), (3, 4), (4, None)], "b": [(4, 7)]})
    table = FeatureTable(spark, str(tmp_path / "t"), [X.Lag(1), X.Lag(2), X.Rolling("mean", 1, 2)])
    table.begin(p, START)
    for i in range(1, 5):
        table.add(p, START + timedelta(days=i))
    rows = {(r.unique_id, r.ds): tuple(r)[2:6] for i in range(1, 5) for r in table.features(START + timedelta(days=i)).collect()}
    assert rows["a", START + timedelta(days=1)] == (2.0, 1.0, None, None)
    assert rows["a", START + timedelta(days=3)] == (4.0, None, 2.0, None)  # the window holds an unknown day
    assert rows["b", START + timedelta(days=4)] == (7.0, None, None, None) and len(rows) == 4
    state = {r.unique_id: tuple(r)[1:4] for r in table.state(START + timedelta(days=4)).collect()}
    assert state == {"a": ([4.0, None], 3, 7.0), "b": ([None, 7.0], 1, 7.0)}


def test_a_day_reads_one_day_and_one_state(spark, tmp_path):
    path = str(tmp_path / "p")
    panel(spark, {"a": [(i, i) for i in range(30)]}).write.partitionBy("ds").parquet(path)
    stored = spark.read.parquet(path)
    table = FeatureTable(spark, str(tmp_path / "t"), [X.Lag(7)])
    table.begin(stored, START + timedelta(days=20))
    table.add(stored, START + timedelta(days=21))
    day = START + timedelta(days=21)
    state, rows = table.state(day), stored.filter(F.col("ds") == F.lit(day))
    assert len(state.inputFiles()) and all(f"state_date={day}" in f for f in spark.read.parquet(
        f"{tmp_path}/t/states/state_date={day}").inputFiles())
    from tidepanel.operators.state import day_features
    plan = day_features(state, rows, [X.Lag(7)], day)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull") == 2 and "Window" not in plan


def numpy_glm(x, y, power, penalty, steps):
    mean = np.where(y > 0, y, 0.1)
    for _ in range(steps):
        w, z = mean ** (2 - power), np.log(mean) + (y - mean) / mean
        a = (x * w[:, None]).T @ x + np.diag([0.0, *[penalty * w.sum()] * (x.shape[1] - 1)])
        beta = np.linalg.solve(a, (x * w[:, None]).T @ z)
        mean = np.exp(x @ beta)
    return beta


@pytest.fixture(scope="module")
def glm_rows(spark):
    rng = np.random.default_rng(3)
    rows = []
    for g, (a, b, c) in {"u": (1.0, 0.5, -0.2), "v": (0.2, -0.3, 0.6), "w": (2.0, 0.0, 0.1)}.items():
        x = rng.normal(size=(300, 2))
        y = rng.poisson(np.exp(a + b * x[:, 0] + c * x[:, 1])).astype(float)
        rows += [(g, i % 2, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    return rows, spark.createDataFrame(rows, "g string, half int, x1 double, x2 double, y double")


def test_groups_are_fitted_like_each_alone(spark, glm_rows):
    rows, table = glm_rows
    beta = {r.g: r._beta for r in G.coefficients(table.repartition(5), ["x1", "x2"], ["g"], 1.5, 0.01, 6).collect()}
    for g in "uvw":
        own = np.array([r[2:] for r in rows if r[0] == g])
        x = np.column_stack([np.ones(len(own)), own[:, :2]])
        assert beta[g] == pytest.approx(numpy_glm(x, own[:, 2], 1.5, 0.01, 6).tolist(), rel=1e-8)
    # power and penalty may differ by group
    two = G.coefficients(table, ["x1"], ["g", "half"], F.col("half") * 0.4 + 1.1, F.col("half") * 0.1, 4)
    for r in two.collect():
        own = np.array([x[2:] for x in rows if x[0] == r.g and x[1] == r.half])
        x = np.column_stack([np.ones(len(own)), own[:, 0]])
        assert r._beta == pytest.approx(numpy_glm(x, own[:, 2], 1.1 + 0.4 * r.half, 0.1 * r.half, 4).tolist(), rel=1e-8)


def test_steps_reach_the_estimator_of_the_library(spark, glm_rows):
    _, table = glm_rows
    one = VectorAssembler(inputCols=["x1", "x2"], outputCol="f").transform(table.filter("g = 'u'"))
    fit = GeneralizedLinearRegression(featuresCol="f", labelCol="y", family="tweedie", variancePower=1.5, linkPower=0.0,
                                      maxIter=50, tol=1e-10).fit(one)
    beta = G.coefficients(table, ["x1", "x2"], ["g"], 1.5, 0.0, 15).filter("g = 'u'").first()._beta
    assert beta == pytest.approx([fit.intercept, *fit.coefficients], rel=1e-4)


def test_singular_groups_and_groups_without_rows(spark):
    rows = spark.createDataFrame([("a", 1.0, 1.0, 5.0), ("a", 1.0, 1.0, 5.0), ("b", 2.0, 0.0, 0.0)],
                                 "g string, x1 double, x2 double, y double")
    beta = G.coefficients(rows, ["x1", "x2"], ["g"])
    scored = G.glm_scorer(beta.withColumnRenamed("g", "k"), ["x1", "x2"], ["k"])
    out = {r.k: r.y_hat for r in scored(spark.createDataFrame([("a", 0.0, 0.0), ("z", 1.0, 1.0)], "k string, x1 double, x2 double")).collect()}
    assert out["z"] is None and np.isfinite(out["a"])
    assert G.coefficients(rows.limit(0), ["x1"], ["g"], steps=2).count() == 0


def test_models_of_categories_follow_their_series(spark):
    p = panel(spark, {f"s{k}_{'up' if k % 2 else 'down'}": [(i, (5 + k) * (1 + i % 7)) for i in range(150)] for k in range(4)})
    out = G.per_category_glm(F.split("unique_id", "_")[1])(p, Folds.of(p, windows=1))
    assert out.count() == 4 * 28 and {r.category for r in out.collect()} == {"up", "down"}
    worst = out.agg(F.max(F.abs(F.col("y_hat") / F.col("y") - 1))).first()[0]
    assert worst < 0.25


def test_a_step_reads_packed_rows(spark, monkeypatch):
    """What is stored for the steps has a value per PIECE rows, not a field per feature and row."""
    p = panel(spark, {f"s{k}": [(i, (5 + k) * (1 + (i * i) % 7)) for i in range(400)] for k in range(6)})
    kept = []
    monkeypatch.setattr(G, "settle", lambda df, label: kept.append((label, settle(df, label))) or kept[-1][1])
    folds = Folds.of(p, windows=1)
    out = G.tweedie_glm(1.5)(p, folds)
    assert out.count() == 6 * 28 and "category" not in out.columns
    rows = X.training_matrix(p, X.BASE, folds.first).toPandas()
    stored = [df for label, df in kept if label == "matrix"]
    assert len(stored) == 1 and stored[0].count() < len(rows) / (G.PIECE / 4)
    names = [s.name for s in X.BASE]
    x = np.column_stack([np.ones(len(rows)), np.log1p(rows[names].to_numpy(float))])
    beta = kept[-1][1].first()._beta
    assert beta == pytest.approx(numpy_glm(x, rows["y"].to_numpy(), 1.5, 1e-6, G.STEPS).tolist(), rel=1e-6)


def test_groups_that_share_small_batches(spark, glm_rows):
    """Pieces of any length, of groups in any order, unknown groups and rows with unknown numbers among them."""
    rows, _ = glm_rows
    more = [(None, 0, 1.0, 1.0, 3.0), ("u", 0, None, 1.0, 3.0), ("v", 1, 1.0, 1.0, None)]
    table = spark.createDataFrame(sorted(rows, key=lambda r: r[3]) + more, "g string, half int, x1 double, x2 double, y double")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "101")
    try:
        found = G.coefficients(table.coalesce(2), ["x1", "x2"], ["g", "half"], 1.3, 0.01, 6).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {(r.g, r.half) for r in found} == {(g, h) for g in "uvw" for h in (0, 1)}
    for r in found:
        own = np.array([x[2:] for x in rows if x[0] == r.g and x[1] == r.half])
        x = np.column_stack([np.ones(len(own)), own[:, :2]])
        assert r._beta == pytest.approx(numpy_glm(x, own[:, 2], 1.3, 0.01, 6).tolist(), rel=1e-8)


def test_candidates_are_fitted_together_as_alone(spark, monkeypatch):
    """One table of training rows for all sets of lags, and the losses of separate fits by MLlib's estimator."""
    rng = random.Random(11)
    values = {f"s{k}": [(i, None if k == 2 and i == 90 else rng.randint(0, 5) * (1 + i % 7) + k) for i in range(200)]
              for k in range(4)}
    p, kept = panel(spark, values | {"young": [(i, 3) for i in range(150, 200)]}), []
    space = spark.createDataFrame([(0, "7_14_28", 1.0, 0.5), (1, "7_14_21_28", 1.6, 1e-3), (2, "14_28", 1.2, 0.1)],
                                  "trial long, lags string, tweedie_variance_power double, reg_lambda double")
    folds = Folds.of(p, windows=2)
    monkeypatch.setattr(G, "settle", lambda df, label: kept.append(label) or settle(df, label))
    found = {r.trial: r.loss for r in H.search_cv(p, space, H.recursive_candidates(), folds).collect()}
    assert kept == ["matrix"]
    alone = {r.trial: r.loss for r in H.search_cv(p, space, H.recursive_candidate, folds).collect()}
    assert found == pytest.approx(alone, rel=1e-9) and len(set(found.values())) == 3


def test_a_tweedie_candidate_needs_targets_that_are_not_negative(spark):
    p = panel(spark, {"a": [(i, i % 7 - 1) for i in range(200)]})
    one = {0: G.Tweedie(tuple(X.BASE), 1.5, 0.1)}
    with pytest.raises(Exception, match="below zero"):
        G.fitted_candidates(p, one, START + timedelta(days=180))
    with pytest.raises(ValueError, match="no training rows"):
        G.fitted_candidates(p, one, START + timedelta(days=10))
