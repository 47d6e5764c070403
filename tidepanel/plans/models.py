"""Registered queries: forecasts, intervals, search."""

from pyspark.sql import functions as F

from tidepanel.config import DAY, KEY, TARGET
from tidepanel.functions.metrics import wmape
from tidepanel.operators import evaluate as E
from tidepanel.operators import features as X
from tidepanel.operators import forecast as N
from tidepanel.operators import glm as G
from tidepanel.operators import multirate as R
from tidepanel.operators import trained as T
from tidepanel.operators import tune as H
from tidepanel.operators.custom import LinearModel, custom_learner
from tidepanel.operators.ets import SHORT_GRID, ets_auto, ets_grid, simple_smoothing
from tidepanel.operators.folds import fold_context
from tidepanel.operators.select import keep_series, top_series
from tidepanel.plans.base import BLEND, BLEND_SPECS, METRIC_SQL, Tables, query, sql, tidy
from tidepanel.session import settle

# the library's defaults: 100 trees
TREES = T.TreeParams()
CANDIDATES = 10


@query("naive", sql("SELECT * FROM naive_supplier"))
def _(t):
    return N.naive(t.sparse("supplier"), t.folds())


@query("seasonal_naive", sql("SELECT * FROM snaive_supplier"))
def _(t):
    return N.seasonal_naive(t.sparse("supplier"), t.folds())


@query("naive_interval_gaussian", sql("SELECT * FROM naive_band_nation", "lo_80 hi_80"))
def _(t):
    return tidy(N.naive_gaussian(t.panel("nation"), t.folds()))


@query("snaive_interval_gaussian", sql("SELECT * FROM snaive_band_nation", "lo_80 hi_80"))
def _(t):
    return tidy(N.seasonal_naive_gaussian(t.panel("nation"), t.folds()))


@query("ets_simple", sql(
    "SELECT t.*, l.level AS y_hat FROM tests_nation t JOIN (SELECT p.unique_id, c.cutoff, "
    "list_reduce(list(p.y ORDER BY p.ds), lambda a, b: CAST(a * 0.7::DOUBLE + b * 0.3::DOUBLE AS DOUBLE)) AS level "
    "FROM panel_nation p JOIN cutoffs c ON p.ds <= c.cutoff GROUP BY 1, 2) l "
    "ON l.unique_id = t.unique_id AND l.cutoff = t.cutoff", "y_hat"))
def _(t):
    return tidy(simple_smoothing(t.panel("nation"), t.folds(), 0.3))


@query("ets_auto")
def _(t):
    return tidy(ets_auto(t.panel("nation"), t.folds()))


def _ets_sql() -> str:
    """The recursions day by day for all candidates at once; the best one by AICc at each cutoff."""
    grid = ", ".join(f"({i}, {', '.join(f'{v}::DOUBLE' for v in c.row())})" for i, c in enumerate(SHORT_GRID))
    parts = {
        "grid": f"SELECT * FROM (VALUES {grid}) g(c, a, b, phi, g, k)",
        "long": "SELECT unique_id, list(y ORDER BY ds) AS ys FROM panel_nation GROUP BY 1",
        "opened": "SELECT unique_id, ys, list_avg(ys[1:14]) AS m, list_transform(range(1, 8), lambda i: (ys[i] + ys[i + 7]) "
                  "/ 2 - list_avg(ys[1:14])) AS cyc FROM long",
        "walk": "SELECT o.unique_id, g.c, 0 AS t, o.m AS level, 0.0::DOUBLE AS trend, CASE WHEN g.g > 0 THEN o.cyc ELSE "
                "list_transform(o.cyc, lambda v: 0.0::DOUBLE) END AS cyc, 0.0::DOUBLE AS sse FROM opened o, grid g "
                "UNION ALL SELECT unique_id, c, t + 1, base + a * e, phi * trend + b * e, list_transform(cyc, lambda v, i: "
                "CASE WHEN i - 1 = t % 7 THEN v + g * e ELSE v END), sse + e * e FROM (SELECT w.*, g.a, g.b, g.phi, g.g, "
                "w.level + g.phi * w.trend AS base, l.ys[w.t + 1] - (w.level + g.phi * w.trend) - w.cyc[w.t % 7 + 1] AS e "
                "FROM walk w JOIN grid g ON g.c = w.c JOIN long l ON l.unique_id = w.unique_id WHERE w.t < len(l.ys)) x",
        "ends": "SELECT cutoff, CAST(cutoff - lo AS INTEGER) + 1 AS n FROM cutoffs, span",
        "best": "SELECT w.*, e.cutoff, g.phi FROM walk w JOIN ends e ON e.n = w.t JOIN grid g ON g.c = w.c QUALIFY "
                "row_number() OVER (PARTITION BY w.unique_id, e.cutoff ORDER BY w.t * ln(greatest(w.sse, 1e-12) / w.t) + 2 "
                "* g.k + 2 * g.k * (g.k + 1) / greatest(w.t - g.k - 1, 1), w.c) = 1",
    }
    text = sql(
        "SELECT s.unique_id, s.ds, s.cutoff, s.h, s.y, b.level + b.trend * list_sum(list_transform(range(1, s.h + 1), lambda "
        "i: pow(b.phi, i))) + b.cyc[(b.t + s.h - 1) % 7 + 1] AS y_hat FROM tests_nation s JOIN best b ON b.unique_id = "
        "s.unique_id AND b.cutoff = s.cutoff", "y_hat", **parts)
    return text.replace("WITH ", "WITH RECURSIVE ", 1)


@query("ets_grid", _ets_sql())
def _(t):
    return tidy(ets_grid(t.panel("nation"), t.folds()))


@query("recursive_linear", sql("SELECT * FROM blend_nation", "y_hat"))
def _(t):
    return tidy(T.recursive_forecast(T.linear_scorer(BLEND), t.panel("nation"), t.folds(), BLEND_SPECS))


def _stored(t: Tables, kind: str = "supplier"):
    """A panel that grows with the input, stored, as fitting and forecasting read it several times."""
    return settle(t.panel(kind), "model-panel")


def _trained(t: Tables, forecaster, model: str, kind: str = "supplier"):
    return E.named(forecaster(_stored(t, kind), t.folds()), model, "ml")


@query("gbt_base")
def _(t):
    return _trained(t, T.gbt_base(TREES), "Trees")


@query("gbt_rich")
def _(t):
    return _trained(t, T.gbt_rich(TREES), "Trees-Rich")


def leveled(t: Tables):
    """The type and region panel with ids of five levels, stored."""
    parts = F.split(KEY, "_")
    five = F.concat_ws("_", parts[0], F.lit("ALL"), F.lit("0"), parts[1], F.lit("0"))
    return settle(t.panel("type_region").withColumn(KEY, five), "model-panel")


@query("gbt_cat")
def _(t):
    return E.named(T.gbt_cat(TREES)(leveled(t), t.folds()), "Trees-Cat", "ml")


@query("tweedie_glm")
def _(t):
    return _trained(t, G.tweedie_glm(1.5), "Tweedie")


@query("recursive_forecast")
def _(t):
    return _trained(t, T.gbt_base(TREES, refit=True), "Trees-Refit")


@query("recursive_short_lags")
def _(t):
    """The day before enters, so each step needs the one before it."""
    return _trained(t, T.boosted_model(TREES, [X.Lag(1), *X.BASE]), "Trees-Lag1", "nation")


@query("direct_multihorizon")
def _(t):
    return _trained(t, T.direct_multihorizon(), "Direct", "nation")


def _glm_sql(steps: int, power: float) -> str:
    """Weighted least squares on an intercept and one feature, so many times; a group's system is solved by Cramer's rule."""
    parts = {
        "glm_rows": "SELECT p.region, p.y, ln(1 + p.x) AS x FROM (SELECT split_part(unique_id, '_', 2) AS region, ds, y, "
                    "lag(y, 7) OVER (PARTITION BY unique_id ORDER BY ds) AS x FROM panel_type_region) p "
                    "WHERE p.x IS NOT NULL AND p.ds <= (SELECT min(cutoff) FROM cutoffs)",
    }
    for k in range(steps):
        eta = "ln(CASE WHEN y > 0 THEN y ELSE 0.1::DOUBLE END)" if k == 0 else "b0 + b1 * x"
        rows = "glm_rows" if k == 0 else f"glm_rows JOIN glm{k - 1} USING (region)"
        parts[f"glm{k}"] = (
            f"SELECT region, (r0 * s11 - r1 * s01) / (s00 * s11 - s01 * s01) AS b0, (r1 * s00 - r0 * s01) / (s00 * s11 - s01 "
            f"* s01) AS b1 FROM (SELECT region, sum(w) AS s00, sum(w * x) AS s01, sum(w * x * x) AS s11, sum(w * z) AS r0, "
            f"sum(w * x * z) AS r1 FROM (SELECT region, x, pow(exp(eta), {2 - power}::DOUBLE) AS w, eta + (y - exp(eta)) / "
            f"exp(eta) AS z FROM (SELECT region, x, y, {eta} AS eta FROM {rows}) a) b GROUP BY region) c")
    return sql(f"SELECT region AS category, b0 AS intercept, b1 AS slope FROM glm{steps - 1}", "intercept slope", **parts)


@query("direct_multirate")
def _(t):
    return _trained(t, R.multirate_direct(), "Direct-Rates", "nation")


_BLOCKS_SQL = ("SELECT unique_id, cutoff, r.rate, CAST((h - 1) // r.rate AS INTEGER) AS knot, avg(y) AS v FROM tests_nation "
               "CROSS JOIN (VALUES (2), (5), (7)) r(rate) GROUP BY ALL")


@query("coarse_steps", sql("SELECT unique_id, cutoff, rate, knot, v FROM blocks", "v", blocks=_BLOCKS_SQL))
def _(t):
    """Block means of the test windows at three rates; 28 steps have a short last block at rate 5."""
    contexts = fold_context(t.panel("nation"), t.folds(), 7)
    parts = F.array(*[F.struct(F.lit(r).alias("rate"), R.coarse_steps(F.col("future"), 28, r).alias("k")) for r in (2, 5, 7)])
    rows = contexts.select(KEY, "cutoff", F.inline(parts))
    return tidy(rows.select(KEY, "cutoff", "rate", F.posexplode("k").alias("knot", "v")))


@query("expanded_steps", sql(
    "SELECT p.unique_id, p.cutoff, p.rate, CAST(p.d + 1 AS INTEGER) AS h, a.v * (1 - (p.place - floor(p.place))) + b.v * "
    "(p.place - floor(p.place)) AS v FROM (SELECT k.unique_id, k.cutoff, k.rate, max(k.knot) AS last, d.d, greatest(least((d.d "
    "- (k.rate - 1) / 2) / k.rate, max(k.knot)), 0) AS place FROM blocks k CROSS JOIN range(28) d(d) GROUP BY k.unique_id, "
    "k.cutoff, k.rate, d.d) p JOIN blocks a ON a.unique_id = p.unique_id AND a.cutoff = p.cutoff AND a.rate = p.rate AND a.knot "
    "= floor(p.place) JOIN blocks b ON b.unique_id = p.unique_id AND b.cutoff = p.cutoff AND b.rate = p.rate AND b.knot = "
    "least(floor(p.place) + 1, p.last)", "v", blocks=_BLOCKS_SQL))
def _(t):
    """The block means as a value per step again."""
    contexts = fold_context(t.panel("nation"), t.folds(), 7)
    parts = F.array(*[F.struct(F.lit(r).alias("rate"), R.expanded_steps(
        R.coarse_steps(F.col("future"), 28, r), 28, r).alias("s")) for r in (2, 5, 7)])
    rows = contexts.select(KEY, "cutoff", F.inline(parts)).select(KEY, "cutoff", "rate", F.posexplode("s").alias("_i", "v"))
    return tidy(rows.select(KEY, "cutoff", "rate", (F.col("_i") + 1).alias("h"), "v"))


@query("per_category_coefficients", _glm_sql(4, 1.5))
def _(t):
    """The coefficients of all categories after four steps, on last week's value."""
    panel, specs = t.panel("type_region"), [X.Lag(7)]
    rows = G.logged(X.training_matrix(panel, specs, t.folds().first), ["lag7"])
    rows = settle(rows.select(F.split(KEY, "_")[1].alias("category"), TARGET, "_log_lag7"), "matrix")
    beta = G.coefficients(rows, ["_log_lag7"], ["category"], steps=4)
    return tidy(beta.select("category", F.col("_beta")[0].alias("intercept"), F.col("_beta")[1].alias("slope")))


@query("per_category_models")
def _(t):
    panel = settle(t.panel("type_region"), "model-panel")
    return tidy(G.per_category_glm(F.split(KEY, "_")[1])(panel, t.folds()))


@query("user_forecaster", sql(
    "SELECT t.*, m.m AS y_hat FROM tests_nation t JOIN (SELECT p.unique_id, c.cutoff, avg(p.y) AS m FROM panel_nation p "
    "JOIN cutoffs c ON p.ds <= c.cutoff AND p.ds > c.cutoff - 28 GROUP BY 1, 2) m ON m.unique_id = t.unique_id "
    "AND m.cutoff = t.cutoff", "y_hat"))
def _(t):
    def four_week_mean(past, horizon):
        return [past.mean()] * horizon

    return tidy(N.per_series(four_week_mean, 28)(t.panel("nation"), t.folds()))


@query("user_model", sql(
    "SELECT t.*, f.a * list_sum(list_transform(range(0, (t.h + 6) // 7), lambda i: pow(f.b, i))) + pow(f.b, (t.h + 6) // 7) * "
    "p.y AS y_hat FROM tests_nation t JOIN panel_nation p ON p.unique_id = t.unique_id AND p.ds = t.cutoff - 6 + (t.h - 1) % 7 "
    "CROSS JOIN fitted f", "y_hat",
    fitted="SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM (SELECT ds, y, lag(y, 7) OVER (PARTITION BY unique_id "
           "ORDER BY ds) AS x FROM panel_nation) m WHERE ds <= (SELECT min(cutoff) FROM cutoffs)"))
def _(t):
    """A user's linear model of last week's value, fitted by partial states, in the recursion of the library."""
    panel = settle(t.panel("nation"), "model-panel")
    return tidy(T.recursive_model(custom_learner(LinearModel()), [X.Lag(7)])(panel, t.folds()))


# the pool is all seasonal errors up to the cutoff; every day is known in this panel
PATHS_SQL = """SELECT t.unique_id, t.cutoff, t.ds, t.h, t.y, CAST(s.sample AS INTEGER) AS sample,
n.y_hat + e.es[CAST('0x' || md5(t.unique_id || '|' || CAST(t.cutoff AS VARCHAR) || '|' || t.h || '|' || s.sample)[1:8] AS
BIGINT) % len(e.es) + 1] AS y_sim
FROM tests_nation t CROSS JOIN range(1, 21) s(sample)
JOIN snaive_nation n ON n.unique_id = t.unique_id AND n.cutoff = t.cutoff AND n.ds = t.ds
JOIN pool e ON e.unique_id = t.unique_id AND e.cutoff = t.cutoff"""
POOL_SQL = """SELECT unique_id, cutoff, list(e ORDER BY ds) AS es FROM (SELECT unique_id, ds, y - lag(y, 7) OVER
(PARTITION BY unique_id ORDER BY ds) AS e FROM panel_nation) a JOIN cutoffs c ON a.ds <= c.cutoff WHERE e IS NOT NULL
GROUP BY 1, 2"""


@query("sample_path_bootstrap", sql(PATHS_SQL, pool=POOL_SQL))
def _(t):
    return N.sample_paths(t.panel("nation"), t.folds(), 20)


@query("sample_path_summary", sql(
    "SELECT unique_id, cutoff, ds, h, any_value(y) AS y, greatest(quantile_cont(y_sim, 0.5), 0.0) AS y_hat, "
    "greatest(quantile_cont(y_sim, 0.1), 0.0) AS lo_80, greatest(quantile_cont(y_sim, 0.9), 0.0) AS hi_80 "
    "FROM paths GROUP BY unique_id, cutoff, ds, h", "y_hat lo_80 hi_80", pool=POOL_SQL, paths=PATHS_SQL))
def _(t):
    return tidy(N.path_summary(N.sample_paths(t.panel("nation"), t.folds(), 20)))


def _conformal_sql(model: str, source: str) -> str:
    """Naive forecasts at six cutoffs; each fold's interval from the three before it."""
    six = "SELECT CAST(i AS INTEGER) AS fold, hi - CAST((6 - i) * 28 AS INTEGER) AS cutoff FROM span, range(6) t(i)"
    rows = (
        f"SELECT p.unique_id, p.ds, c.cutoff, c.fold, CAST(p.ds - c.cutoff AS INTEGER) AS h, p.y, n.y AS y_hat "
        f"FROM panel_nation p JOIN six c ON p.ds > c.cutoff AND p.ds <= c.cutoff + 28 "
        f"JOIN panel_nation n ON n.unique_id = p.unique_id AND n.ds = {source}")
    errors = ("SELECT f.unique_id, f.cutoff, f.h, s.sign * abs(e.y - e.y_hat) AS e FROM rows6 f JOIN rows6 e "
              "ON e.unique_id = f.unique_id AND e.h = f.h AND e.fold BETWEEN f.fold - 3 AND f.fold - 1 "
              "CROSS JOIN (VALUES (-1), (1)) s(sign) WHERE f.fold >= 3")
    return sql(
        "SELECT f.unique_id, f.ds, f.cutoff, f.h, f.y, f.y_hat, f.y_hat + q.lo AS lo_80, f.y_hat + q.hi AS hi_80 "
        "FROM rows6 f JOIN (SELECT unique_id, cutoff, h, quantile_cont(e, 0.1) AS lo, quantile_cont(e, 0.9) AS hi "
        "FROM errors GROUP BY 1, 2, 3) q ON q.unique_id = f.unique_id AND q.cutoff = f.cutoff AND q.h = f.h",
        "lo_80 hi_80", six=six, rows6=rows, errors=errors)


@query("conformal_interval", _conformal_sql("naive", "c.cutoff"))
def _(t):
    return tidy(N.conformal_interval(t.panel("nation"), N.naive, t.folds()))


@query("conformal_interval_seasonal", _conformal_sql("snaive", "c.cutoff - 6 + CAST((p.ds - c.cutoff - 1) % 7 AS INTEGER)"))
def _(t):
    return tidy(N.conformal_interval(t.panel("nation"), N.seasonal_naive, t.folds()))


def _banded(t: Tables, forecaster, model: str, panel):
    """Point forecasts of a trained model, as without intervals, with intervals from earlier back-tests."""
    return E.named(N.conformal_interval(panel, forecaster, t.folds()), model, "ml")


@query("conformal_interval_trees")
def _(t):
    return _banded(t, T.gbt_base(TREES), "Trees", _stored(t))


@query("conformal_interval_rich")
def _(t):
    return _banded(t, T.gbt_rich(TREES), "Trees-Rich", _stored(t))


@query("conformal_interval_cat")
def _(t):
    return _banded(t, T.gbt_cat(TREES), "Trees-Cat", leveled(t))


@query("conformal_interval_direct")
def _(t):
    return _banded(t, T.direct_multihorizon(), "Direct", _stored(t, "nation"))


@query("conformal_interval_ets")
def _(t):
    return E.named(N.conformal_interval(_stored(t, "nation"), ets_auto, t.folds()), "ETS", "baseline")


@query("score_full_and_micro", sql(
    "SELECT * FROM scores_type_region UNION ALL SELECT model, metric, score, stage, aggregation_scope, 'micro' AS "
    "subset_name FROM (SELECT model, 'wMAPE' AS metric, \"wMAPE\" AS score, stage, 'pooled_all_windows' AS "
    "aggregation_scope FROM micro UNION ALL SELECT model, 'Bias', \"Bias\", stage, 'pooled_all_windows' FROM micro "
    "UNION ALL SELECT model, 'IntervalScore_80', \"IntervalScore_80\", stage, 'pooled_all_windows' FROM micro "
    "UNION ALL SELECT model, 'Coverage_80', \"Coverage_80\", stage, 'pooled_all_windows' FROM micro) x", "score",
    micro="SELECT model, min(stage) AS stage, %s FROM forecasts_type_region WHERE unique_id IN (SELECT unique_id FROM "
          "panel_type_region GROUP BY 1 ORDER BY sum(y) DESC, unique_id LIMIT 10) GROUP BY 1" % METRIC_SQL))
def _(t):
    every = t.forecasts_on("type_region")
    micro = keep_series(every, top_series(t.panel("type_region"), 10))
    return tidy(E.union_forecasts(E.score_forecasts(every, "type_region"), E.score_forecasts(micro, "micro")))


# --- search ---------------------------------------------------------------------------------------------
@query("search_cv")
def _(t):
    return tidy(H.staged_search(t.panel("supplier"), H.search_space(t.spark, CANDIDATES), t.folds()))


@query("search_cv_tweedie")
def _(t):
    space = H.search_space(t.spark, CANDIDATES, tweedie=True)
    return tidy(H.search_cv(t.panel("supplier"), space, H.recursive_candidates(), t.folds()))


@query("search_cv_direct")
def _(t):
    return tidy(H.staged_search_direct(t.panel("nation"), H.search_space_direct(t.spark, CANDIDATES), t.folds()))


WEIGHTS = [round(i / 10, 1) for i in range(11)]
TRIALS_SQL = ("SELECT CAST(w.i AS BIGINT) AS trial, w.i / 10 AS weight, sum(abs(n.y - (w.i / 10 * n.y_hat + "
              "(1 - w.i / 10) * s.y_hat))) / sum(abs(n.y)) AS loss FROM naive_nation n JOIN snaive_nation s "
              "ON s.unique_id = n.unique_id AND s.cutoff = n.cutoff AND s.ds = n.ds CROSS JOIN range(11) w(i) GROUP BY w.i")


def trials(t: Tables):
    """Loss of eleven mixtures of the two naive forecasts."""
    both = N.both_naive(t.panel("nation"), t.folds())
    pairs = both.groupBy(KEY, DAY, "cutoff").agg(
        F.max(TARGET).alias(TARGET),
        F.max(F.when(F.col("model") == "Naive", F.col("y_hat"))).alias("n"),
        F.max(F.when(F.col("model") == "SeasonalNaive", F.col("y_hat"))).alias("s"),
    )
    cells = F.array(*[F.struct(F.lit(i).cast("long").alias("trial"), F.lit(w).alias("weight"))
                      for i, w in enumerate(WEIGHTS)])
    rows = pairs.select(TARGET, "n", "s", F.inline(cells))
    mixed = F.col("weight") * F.col("n") + (1 - F.col("weight")) * F.col("s")
    return rows.groupBy("trial", "weight").agg(wmape(F.col(TARGET), mixed).alias("loss"))


@query("best_so_far", sql(
    "SELECT *, min(loss) OVER (ORDER BY trial ROWS UNBOUNDED PRECEDING) AS best_loss FROM trials", "loss best_loss weight",
    trials=TRIALS_SQL))
def _(t):
    return tidy(E.best_so_far(trials(t)))


@query("best_candidate", sql(
    "SELECT loss, trial, weight, 'mixture' AS objective FROM trials ORDER BY loss, trial LIMIT 1", "loss weight",
    trials=TRIALS_SQL))
def _(t):
    return tidy(E.best_candidate(trials(t), {"objective": "mixture"}))


@query("compare_tuned")
def _(t):
    """The default settings, the winner of a search over trees, and that of one over the tweedie model."""
    panel, folds = _stored(t, "nation"), t.folds()
    spaces = H.search_space(t.spark, CANDIDATES), H.search_space(t.spark, CANDIDATES, tweedie=True)
    best = {
        "tuned": H.staged_search(panel, spaces[0], folds),
        "tweedie": H.search_cv(panel, spaces[1], H.recursive_candidates(), folds),
    }
    runs = {"default": T.gbt_base(TREES)}
    runs |= {name: H.recursive_candidate(H.winner(found)) for name, found in best.items()}
    rows = [(name, H.pooled_loss(run(panel, folds))) for name, run in runs.items()]
    losses = t.spark.createDataFrame(rows, "name string, loss double")
    return tidy(E.compare_losses(losses, "default"))


@query("compare_losses", sql(
    "SELECT model AS name, \"wMAPE\" AS loss, ((SELECT \"wMAPE\" FROM wide_scores_nation WHERE model = 'Naive') - \"wMAPE\") / "
    "(SELECT \"wMAPE\" FROM wide_scores_nation WHERE model = 'Naive') * 100 AS vs_default_pct FROM wide_scores_nation",
    "loss vs_default_pct"))
def _(t):
    losses = E.wide_scores(t.forecasts, ["model"]).select(F.col("model").alias("name"), F.col("wMAPE").alias("loss"))
    return tidy(E.compare_losses(losses, "Naive"))
