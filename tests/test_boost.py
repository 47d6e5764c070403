"""Boosted trees by shards, their recursion, and staged search."""

import math
import random
from collections import defaultdict
from dataclasses import replace
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepanel.operators import boost
from tidepanel.operators import features as X
from tidepanel.operators import forecast as N
from tidepanel.operators import multirate as R
from tidepanel.operators import trained as T
from tidepanel.operators import tune as H
from tidepanel.operators.folds import Folds
from tidepanel.plans import base

START = date(2020, 1, 1)


def panel(spark, n_series=6, days=260, seed=5, first=lambda k: 0):
    rng = random.Random(seed)
    rows = [(f"s{k}_x{k % 2}", START + timedelta(days=i), float(10 * (k + 1) + 6 * (i % 7) + rng.randint(0, 9)))
            for k in range(n_series) for i in range(first(k), days)]
    return spark.createDataFrame(rows, "unique_id string, ds date, y double")


def sorted_rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_first_tree_has_the_best_split():
    rng = np.random.default_rng(3)
    for _ in range(20):
        x = rng.integers(0, 9, (80, 3)).astype(float)
        y = np.round(x[:, 1] * 2 + (x[:, 0] > 4) * rng.integers(0, 9, 80))
        own = boost.fit_booster(x, y, T.TreeParams(trees=1, rate=1.0, depth=1, min_rows=7, bins=64), 0)
        losses = []
        for f in range(3):
            for edge in np.unique(x[:, f]):
                left = x[:, f] <= edge
                if 7 <= left.sum() <= 73:
                    losses.append(((y[left] - y[left].mean()) ** 2).sum() + ((y[~left] - y[~left].mean()) ** 2).sum())
        assert ((y - own.predict(x, 1)) ** 2).sum() == pytest.approx(min(losses))


@pytest.mark.parametrize("share", [1.0, 0.7])
def test_a_prefix_is_a_shorter_booster(share):
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=(400, 4)), rng.normal(size=400)
    long = boost.fit_booster(x, y, T.TreeParams(trees=30, depth=4, min_rows=3, row_share=share, feature_share=share), 2)
    for k in (0, 1, 7, 30):
        short = boost.fit_booster(x, y, T.TreeParams(trees=k, depth=4, min_rows=3, row_share=share, feature_share=share), 2)
        assert np.array_equal(short.predict(x, k), long.predict(x, k))
    # every leaf that rows reach was fitted on min_rows of them or more, when all rows take part
    if share == 1.0:
        one = boost.fit_booster(x, y, T.TreeParams(trees=1, depth=4, min_rows=30), 2).predict(x, 1)
        assert np.unique(one, return_counts=True)[1].min() >= 30


def test_constant_columns_and_targets():
    x, y = np.ones((50, 2)), np.arange(50.0)
    assert np.allclose(boost.fit_booster(x, y, T.TreeParams(trees=5), 0).predict(x, 5), y.mean())
    x[:, 0] = y
    assert np.allclose(boost.fit_booster(x, np.full(50, 3.0), T.TreeParams(trees=5), 0).predict(x, 5), 3.0)


def test_features_agree_in_all_forms(spark):
    rng = random.Random(8)
    past = [[float(rng.randint(0, 30)) for _ in range(60)] for _ in range(5)]
    past[1][50] = past[2][1] = None
    specs = [X.Lag(1), X.Lag(7), *X.lagged(X.RICH)]
    frame = spark.createDataFrame([(i, p) for i, p in enumerate(past)], "i int, past array<double>")
    rows = frame.select("i", *[s.at(F.col("past"), F.lit(0)).alias(f"f{n}") for n, s in enumerate(specs)]).orderBy("i").collect()
    values = np.array([[np.nan if v is None else v for v in p] for p in past])
    for n, s in enumerate(specs):
        want = np.array([np.nan if r[n + 1] is None else r[n + 1] for r in rows])
        assert np.allclose(s.last(values), want, equal_nan=True), s


@pytest.mark.parametrize("cohort_rows", [2_000_000, 500])
def test_recursion_in_one_task_equals_rounds(spark, monkeypatch, cohort_rows):
    """The same ensemble through the rounds that shuffle and through the walk inside a task; one series is short."""
    monkeypatch.setattr(boost, "COHORT_ROWS", cohort_rows)
    p = panel(spark, first=lambda k: 235 if k == 5 else 0)
    folds, specs = Folds.of(p, windows=2), X.BASE
    ensemble = boost.Ensemble(X.training_matrix(p, specs, folds.first), [s.name for s in specs], [],
                              {0: T.TreeParams(trees=12, depth=3, min_rows=3)})
    assert ensemble.cohorts == (1 if cohort_rows > 500 else 2)
    walked = ensemble.recursed(p, folds, specs)
    rounds = T.recursive_forecast(lambda rows: ensemble.scored(rows).drop("trial", "trees"), p, folds, specs)
    columns = ["unique_id", "ds", "cutoff", "h", "y", "y_hat"]
    a, b = sorted_rows(walked, *columns), sorted_rows(rounds, *columns)
    assert [r[:5] for r in a] == [r[:5] for r in b] and len(a) == 5 * 2 * 28
    assert np.allclose([r[5] for r in a], [r[5] for r in b])


def test_short_lags_feed_each_step(spark):
    p = panel(spark, 3, 120)
    folds, specs = Folds.of(p, windows=1), [X.Lag(1), X.Lag(2), X.DOW]
    ensemble = boost.Ensemble(X.training_matrix(p, specs, folds.first), [s.name for s in specs], [],
                              {0: T.TreeParams(trees=6, depth=3, min_rows=3)})
    import pickle
    boosters = [pickle.loads(r.booster) for r in ensemble.models.orderBy("shard").collect()]
    series = defaultdict(dict)
    for r in p.collect():
        series[r.unique_id][r.ds] = r.y
    want = []
    for key, own in series.items():
        one, two = own[folds.first], own[folds.first - timedelta(days=1)]
        for h in range(1, 29):
            day = folds.first + timedelta(days=h)
            y = float(np.mean([b.predict(np.array([[one, two, day.weekday()]], float), 6)[0] for b in boosters]))
            want.append((key, h, pytest.approx(y)))
            one, two = y, one
    got = sorted_rows(ensemble.recursed(p, folds, specs), "unique_id", "h", "y_hat")
    assert got == sorted(want, key=lambda r: r[:2])


def test_recursion_shuffles_contexts_once(spark):
    p = panel(spark, 3, 120)
    folds = Folds.of(p, windows=1)
    ensemble = boost.Ensemble(X.training_matrix(p, [X.Lag(1)], folds.first), ["lag1"], [], {0: T.TreeParams(trees=2)})
    plan = ensemble.recursed(p, folds, [X.Lag(1)])._jdf.queryExecution().executedPlan().toString()
    own = plan.split("FlatMapCoGroupsInArrow")[1]
    assert own.count("Exchange hashpartitioning(cohort") <= 2  # contexts, and the boosters
    assert own.count("Exchange") <= 3  # and the series, to build the contexts


def test_staged_losses_are_those_of_separate_fits(spark):
    p = panel(spark)
    folds = Folds.of(p, windows=2)
    ranges = H.TREE_RANGES | {"n_estimators": (6, 24), "min_child_samples": (3, 9)}
    space = H.search_space(spark, 6, ranges=ranges)
    found = H.staged_search(p, space, folds, rungs=(6, 12), stages=(2, 6, 9, 12, 16))
    rows = found.collect()
    assert {r.trial for r in rows} == set(range(6)) and len({(r.trial, r.trees) for r in rows}) == len(rows)
    for r in random.Random(1).sample(rows, 5):
        settings = r.asDict() | {"n_estimators": r.trees}
        assert H.pooled_loss(H.recursive_candidate(settings)(p, folds)) == pytest.approx(r.loss, rel=1e-9)
    best = H.winner(found)
    assert "trees" not in best and min((r.loss, r.trial, r.trees) for r in rows)[1:] == (best["trial"], best["n_estimators"])
    # the worse half of those that want more is stopped on each rung
    by = defaultdict(dict)
    for r in rows:
        by[r.trial][r.trees] = r.loss
    want_more = [r.trial for r in space.collect() if r.n_estimators > 6]
    loss = {t: min(v for k, v in by[t].items() if k <= 6) for t in by}
    going = sorted(want_more, key=lambda t: (loss[t], t))[: math.ceil(len(want_more) / 2)]
    assert {t for t in by if max(by[t]) > 6} == set(going)


def test_staged_direct_losses(spark):
    p = panel(spark, 3, 240)
    folds = Folds.of(p, windows=1)
    ranges = H.DIRECT_RANGES | {"max_steps": [3, 8], "input_size": [28, 56]}
    found = H.staged_search_direct(p, H.search_space_direct(spark, 3, ranges=ranges), folds, rungs=(3,), stages=(2, 3, 5))
    for r in found.collect()[:4]:
        settings = r.asDict() | {"max_steps": r.trees}
        assert H.pooled_loss(H.direct_candidate(settings)(p, folds)) == pytest.approx(r.loss, rel=1e-9)


def test_labels_enter_and_unknown_ones_pass(spark):
    p = panel(spark, 6, 200)
    folds = Folds.of(p, windows=1)
    static = {"kind": F.split("unique_id", "_")[1]}
    model = T.boosted_model(T.TreeParams(trees=5, depth=3, min_rows=3), X.BASE, static)
    assert model(p, folds).count() == 6 * 28
    ensemble = boost.Ensemble(X.training_matrix(p, X.BASE, folds.first).withColumns(static), ["lag7"], ["kind"],
                              {0: T.TreeParams(trees=3)})
    rows = spark.createDataFrame([("s0_x0", 1.0, "x0"), ("new", None, "x9"), ("newer", 2.0, None)],
                                 "unique_id string, lag7 double, kind string")
    assert ensemble.scored(rows).filter("y_hat IS NOT NULL").count() == 3
    assert ensemble.scored(rows.limit(0)).count() == 0


def test_rates_hand_on_what_they_leave(spark):
    p = panel(spark, 4, 260)
    folds = Folds.of(p, windows=2)
    trees = T.TreeParams(trees=25, depth=3, min_rows=3)
    loss = {rates: H.pooled_loss(R.multirate_direct(T.boosted_learner(trees), 56, rates)(p, folds)) for rates in ((7,), (7, 2, 1))}
    assert loss[7, 2, 1] < 0.6 * loss[7,]  # blocks of a week know nothing of weekdays
    ahead = R.multirate_direct(T.boosted_learner(trees), 28, (4, 1))(p, Folds.beyond(START + timedelta(days=259)))
    assert ahead.count() == 4 * 28 and ahead.filter("y_hat IS NULL").isEmpty()
    with pytest.raises(ValueError, match="blocks"):
        R.multirate_direct(size=28, rates=(5,))


def test_steps_of_one_day_come_back(spark):
    rows = spark.createDataFrame([([1.0, 5.0, None, 2.0, 8.0],)], "v array<double>")
    one = R.coarse_steps(F.col("v"), 5, 1)
    two = R.coarse_steps(F.col("v"), 5, 2)
    assert rows.select(one, R.expanded_steps(one, 5, 1), two).first() == ([1.0, 5.0, None, 2.0, 8.0], [1.0, 5.0, None, 2.0, 8.0], [3.0, 2.0, 8.0])
    flat = rows.select(R.expanded_steps(F.array(F.lit(4.0), F.lit(4.0), F.lit(4.0)), 5, 2)).first()[0]
    assert flat == [4.0] * 5


def plain_booster(x, y, params, seed):
    """The same boosting by plain sums: each bin adds its errors in row order, the larger child is what the smaller one
    leaves of the parent."""
    n, width = x.shape
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, params.bins + 1)[1:-1])) for c in x.T]
    codes = np.stack([np.searchsorted(e, c) for e, c in zip(edges, x.T)])
    bins = max(len(e) for e in edges) + 1
    rest, trees = y - y.mean(), []
    for t in range(params.trees):
        draw = np.random.default_rng((seed, params.seed, t))
        rows = np.flatnonzero(draw.random(n) < params.row_share) if params.row_share < 1 else np.arange(n)
        some = max(1, round(width * params.feature_share))
        used = np.sort(draw.permutation(width)[:some]) if some < width else np.arange(width)
        node, made = np.zeros(n, int), []
        sums = sizes = None
        for level in range(params.depth):
            def count(own, of, nodes):
                s, k = np.zeros((len(used), nodes, bins)), np.zeros((len(used), nodes, bins), int)
                for f, u in enumerate(used):
                    for i in own:
                        s[f, of[i], codes[u, i]] += rest[i]
                        k[f, of[i], codes[u, i]] += 1
                return s, k
            if level == 0:
                sums, sizes = count(rows, node, 1)
            else:
                less = np.bincount(node[rows], minlength=2**level).reshape(-1, 2).argmin(axis=1)
                part = count([i for i in rows if less[node[i] >> 1] == node[i] & 1], node >> 1, 2 ** (level - 1))
                sums, sizes = (boost._both(whole, own, less) for whole, own in zip((sums, sizes), part))
            best, f, at = boost._splits(sums, sizes, params.min_rows)
            split, at = np.where(best > 1e-12, used[f], 0), np.where(best > 1e-12, at, bins - 1)
            made += [(int(u), edges[u][k] if k < len(edges[u]) else np.inf) for u, k in zip(split, at)]
            node = 2 * node + (codes[split[node], np.arange(n)] > at[node])
        own = np.bincount(node[rows], rest[rows], 2**params.depth)
        leaf = params.rate * own / np.maximum(np.bincount(node[rows], minlength=2**params.depth), 1)
        rest = rest - leaf[node]
        trees.append((made, leaf))
    return trees


@pytest.mark.parametrize("shares", [(1.0, 1.0), (0.7, 0.5)])
def test_fit_is_that_of_plain_sums(shares):
    """To the last bit, as ties of gain hang on it; a constant feature and one that is nearly always zero."""
    rng = np.random.default_rng(9)
    x = np.column_stack([rng.normal(size=300), rng.integers(0, 9, 300) * (rng.random(300) < 0.2), np.ones(300), rng.integers(0, 40, 300)])
    y = rng.normal(size=300) + 3 * (x[:, 1] > 2) + x[:, 3] / 7
    params = T.TreeParams(trees=4, depth=4, min_rows=4, row_share=shares[0], feature_share=shares[1])
    own = boost.fit_booster(x, y, params, 5)
    for t, (made, leaf) in enumerate(plain_booster(x, y, params, 5)):
        assert list(zip(own.feature[t].tolist(), own.above[t].tolist())) == made
        assert np.array_equal(own.leaf[t], leaf)


@pytest.mark.parametrize("share", [1.0, 0.7])
def test_a_fit_goes_on_where_a_shorter_one_ended(share, monkeypatch):
    rng = np.random.default_rng(6)
    x, y = rng.normal(size=(500, 4)).round(1), rng.normal(size=500)
    whole = T.TreeParams(trees=12, depth=4, min_rows=3, row_share=share, feature_share=share)
    first = boost.fit_booster(x, y, replace(whole, trees=7), 2)
    alone = boost.fit_booster(x, y, whole, 2)
    looked = []
    monkeypatch.setattr(boost, "_splits", lambda *a, own=boost._splits: looked.append(1) or own(*a))
    longer = boost.fit_booster(x, y, whole, 2, begun=first)
    assert len(looked) == 5 * 4  # only the five new trees look for splits
    for name in ("feature", "above", "leaf"):
        assert np.array_equal(getattr(alone, name), getattr(longer, name))


def test_fits_at_several_cutoffs_share_their_rows(spark, monkeypatch):
    """One table of training rows for all fits of a refit, and for both fits of intervals; results as of each alone."""
    made = []
    monkeypatch.setattr(T, "training_matrix", lambda *a, own=T.training_matrix, **b: made.append(1) or own(*a, **b))
    p, trees = panel(spark, 3, 220), T.TreeParams(trees=3, depth=3, min_rows=3)
    folds = Folds.of(p, windows=2)
    columns = ["unique_id", "cutoff", "h", "y_hat"]
    got = sorted_rows(T.gbt_base(trees, refit=True)(p, folds), *columns)
    assert len(made) == 1
    assert got == sorted(r for i in range(2) for r in sorted_rows(T.gbt_base(trees)(p, T._only(folds, i)), *columns))
    made.clear()
    banded = N.conformal_interval(p, T.gbt_base(trees), folds, 2)
    assert len(made) == 1
    assert sorted_rows(banded, *columns) == sorted_rows(T.gbt_base(trees)(p, folds), *columns)


def test_training_rows_have_the_features_of_windows(spark):
    """Bit by bit, over batches that cut series, with fractions, unknown days and a series without a name."""
    rng = random.Random(4)
    rows = [(k, START + timedelta(days=i), None if rng.random() < 0.01 else rng.choice([0.0, rng.random() * 9]))
            for k in ("a", "b", None, "short") for i in range(20 if k == "short" else 190)]
    p = spark.createDataFrame(rows, "unique_id string, ds date, y double").withColumn("more", F.lit(1))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        for specs in (X.RICH, [X.Lag(1), X.DOW], [X.MONTH]):
            want = X.add_features(p, specs).dropna(subset=["y", *[s.name for s in specs]])
            got = X.training_matrix(p, specs)
            assert got.dtypes == want.dtypes
            key = lambda r: (r[0] or "", r[1])
            assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
            assert "Window" not in got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_tasks_of_a_panel_follow_its_filled_days(spark, monkeypatch, tmp_path):
    """Few rows that fill to many days: the engine would put them into one task."""
    orders = [(i, 0, START + timedelta(days=i % 400)) for i in range(400)]
    lines = [(i, 0, i % 40, 1.0) for i in range(400)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate date").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(40).withColumnRenamed("id", "s_suppkey").write.parquet(f"{tmp_path}/supplier.parquet")
    monkeypatch.setattr(base, "FILLED_ROWS", 1_000)
    filled = base.Tables(spark, str(tmp_path)).panel("supplier")
    sizes = [r["n"] for r in filled.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 40 * 400 and len(sizes) > 8 and max(sizes) <= 5_000


def models(ensemble):
    import pickle
    return [pickle.loads(r.booster) for r in ensemble.models.orderBy("trial").collect()]


@pytest.mark.parametrize("share", [1.0, 0.7])
def test_one_booster_of_all_rows(spark, monkeypatch, share):
    """The same to the last bit from rows or from sums over rows, by one task or by several; and that of all rows in one
    table."""
    matrix = X.training_matrix(panel(spark, 5, 300), X.BASE).persist()
    names, trees = [s.name for s in X.BASE], T.TreeParams(trees=5, depth=4, min_rows=6, row_share=share)
    made = []
    for part_rows in (10_000, 100):
        for cohort_rows in (2_000_000, 300):
            monkeypatch.setattr(boost, "PART_ROWS", part_rows)
            monkeypatch.setattr(boost, "COHORT_ROWS", cohort_rows)
            made += models(boost.Ensemble(matrix, names, [], {0: trees}))
    made.append(models(boost.Ensemble(matrix, names, [], {0: trees, 1: replace(trees, rate=0.2)}, stored=True))[0])
    if share == 1.0:
        (laid,) = boost.prepare(matrix, names, [], {0: trees})
        rows = boost.Rows(names, [])
        for packed, packs in ((boost._dealt(matrix, rows, laid.layout), laid.count),
                              boost._summed(matrix, rows, {0: laid.layout}, False, None)[0]):
            prepared = replace(laid, packed=packed, packs=packs)
            made += models(boost.Ensemble(matrix, names, [], {0: trees}, prepared=prepared))
        table = matrix.toPandas().sort_values(["unique_id", "ds"])
        alone = boost.fit_booster(table[names].to_numpy(float), table["y"].to_numpy(), trees, 0)
        assert np.array_equal(alone.feature, made[0].feature) and np.array_equal(alone.above, made[0].above)
        assert np.allclose(alone.leaf, made[0].leaf, atol=1e-5) and alone.base == pytest.approx(made[0].base)
    for own in made[1:]:
        for name in ("base", "feature", "above", "leaf"):
            assert np.array_equal(getattr(own, name), getattr(made[0], name)), name


@pytest.mark.parametrize("specs", [X.BASE, X.RICH])
def test_forecasts_do_not_depend_on_a_size(spark, monkeypatch, specs):
    """A panel that was dealt out into several cohorts had several models."""
    p, columns = panel(spark, 5, 220), ["unique_id", "cutoff", "h", "y_hat"]
    model = T.boosted_model(T.TreeParams(trees=4, depth=3, min_rows=3), specs)
    want = sorted_rows(model(p, Folds.of(p, windows=1)), *columns)
    monkeypatch.setattr(boost, "COHORT_ROWS", 100)
    monkeypatch.setattr(boost, "PART_ROWS", 80)
    assert sorted_rows(model(p, Folds.of(p, windows=1)), *columns) == want and len(want) == 5 * 28


def test_steps_give_the_quantiles_of_all_values():
    rng = np.random.default_rng(2)
    values = np.concatenate([rng.integers(-5, 40, 999), [0.0, -0.0, 0.25]]).astype(float)
    step, size, top = (np.concatenate(v) for v in zip(boost._steps(values[:400]), boost._steps(values[400:])))
    order = np.argsort(step, kind="stable")
    assert set(top) == set(values) and size.sum() == len(values)
    assert np.array_equal(boost._quantiles(top[order], size[order], 32), np.unique(np.quantile(values, np.linspace(0, 1, 33)[1:-1])))


def test_scratch_leaves_memory(monkeypatch, tmp_path):
    monkeypatch.setattr(boost, "HELD", 50)
    with open(tmp_path / "f", "w+b") as f:
        scratch = boost.Scratch(f)
        kept = [scratch.keep(np.arange(i, i + 5.0)) for i in range(4)]
        kept[3] -= 1
        assert [k.tolist() for k in kept] == [[0, 1, 2, 3, 4], [1, 2, 3, 4, 5], [2, 3, 4, 5, 6], [2, 3, 4, 5, 6]]
        assert scratch.file.tell() == 120


def test_a_search_scores_every_candidate_to_its_whole_length(spark):
    p = panel(spark, 3, 200)
    ranges = H.TREE_RANGES | {"n_estimators": (101, 130), "min_child_samples": (3, 9), "num_leaves": (3, 7)}
    found = H.staged_search(p, H.search_space(spark, 4, ranges=ranges), Folds.of(p, windows=1)).collect()
    assert {r.trial for r in found if r.finished and r.trees == r.n_estimators} == set(range(4))
    assert sorted((r.trial, r.trees) for r in found if not r.finished) == [(t, k) for t in range(4) for k in (25, 50, 100)]
