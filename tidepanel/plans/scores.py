"""Registered queries: metrics, scores, leaderboards, choices between models."""

from pyspark.sql import functions as F

from tidepanel.config import TARGET
from tidepanel.functions import metrics as M
from tidepanel.operators import evaluate as E
from tidepanel.operators import forecast as N
from tidepanel.operators import trained as T
from tidepanel.operators.ets import ets_auto
from tidepanel.plans.base import Tables, query, sql, tidy
from tidepanel.session import settle

FOUR = "wMAPE Bias IntervalScore_80 Coverage_80"


def scores(t: Tables):
    return E.score_forecasts(t.forecasts, "nation")


def board(t: Tables):
    return E.build_leaderboard([scores(t)])


def flagship(t: Tables, kind: str = "type"):
    """Panel, folds, two baselines, scores, leaderboard."""
    rows = N.both_naive(t.sparse(kind), t.folds())
    return E.build_leaderboard([E.score_forecasts(E.finalize(rows, "baseline").drop("lo_80", "hi_80"), kind)])


@query("flagship", sql(
    "SELECT model, 'baseline' AS stage, 'type' AS subset_name, sum(abs(y - y_hat)) / sum(abs(y)) AS \"wMAPE\", "
    "sum(y_hat - y) / sum(y) AS \"Bias\", NULL::DOUBLE AS \"IntervalScore_80\", NULL::DOUBLE AS \"Coverage_80\" FROM "
    "(SELECT 'Naive' AS model, y, y_hat FROM naive_type UNION ALL SELECT 'SeasonalNaive', y, y_hat FROM snaive_type) x "
    "GROUP BY model", "wMAPE Bias"))
def _(t):
    return tidy(flagship(t))


def _metric(name: str, column: str) -> None:
    @query(name, sql(f'SELECT model, "{column}" FROM wide_scores_nation', column))
    def _(t):
        value = E.metric_columns()[column]
        return tidy(t.forecasts.groupBy("model").agg(value.alias(column)))


_metric("pooled_wmape", "wMAPE")
_metric("pooled_bias", "Bias")
_metric("pooled_interval_score", "IntervalScore_80")
_metric("coverage_rate", "Coverage_80")


@query("score_forecasts", sql("SELECT * FROM scores_nation", "score"))
def _(t):
    return tidy(scores(t))


@query("pivot_metrics", sql("SELECT * FROM board_nation", FOUR))
def _(t):
    return tidy(E.pivot_metrics(scores(t)))


@query("build_leaderboard", sql("SELECT * FROM board_nation UNION ALL SELECT * FROM board_type", FOUR))
def _(t):
    return tidy(E.build_leaderboard([scores(t), E.score_forecasts(t.forecasts_on("type"), "type")]))


@query("display_leaderboard", sql('SELECT model, "wMAPE", "Bias" FROM board_nation WHERE "wMAPE" IS NOT NULL',
                                  "wMAPE Bias"))
def _(t):
    return tidy(E.display_leaderboard(board(t), ["model", "wMAPE", "Bias", "runtime"]))


@query("uncertainty_leaderboard", sql("SELECT * FROM board_nation WHERE stage = 'baseline'", FOUR))
def _(t):
    with_bounds = t.forecasts.filter(F.col("lo_80").isNotNull() & F.col("hi_80").isNotNull())
    return tidy(E.uncertainty_leaderboard([E.score_forecasts(with_bounds, "nation")]))


@query("leaderboard_rank", sql(
    'SELECT *, CAST(row_number() OVER (ORDER BY "wMAPE", model) AS INTEGER) AS position, '
    'lead("wMAPE") OVER (ORDER BY "wMAPE", model) - "wMAPE" AS margin_to_next FROM board_nation',
    FOUR + " margin_to_next"))
def _(t):
    return tidy(E.leaderboard_rank(board(t)))


@query("metric_lookup", sql("SELECT \"wMAPE\" AS score FROM wide_scores_nation WHERE model = 'LagBlend'", "score"))
def _(t):
    return tidy(E.metric_lookup(scores(t), "LagBlend", "wMAPE"))


@query("coverage_diagnostic", sql(
    'SELECT model, "Coverage_80", CASE WHEN abs("Coverage_80" - 0.8) < 0.05 THEN \'green\' '
    "WHEN \"Coverage_80\" > 0.8 THEN 'orange' ELSE 'red' END AS label FROM board_nation", "Coverage_80"))
def _(t):
    return tidy(E.coverage_diagnostic(board(t)))


@query("accuracy_vs_interval", sql(
    'SELECT model, "wMAPE", "IntervalScore_80", "wMAPE" <= (SELECT median("wMAPE") FROM b) AND "IntervalScore_80" <= '
    '(SELECT median("IntervalScore_80") FROM b) AS production_ready FROM b', "wMAPE IntervalScore_80",
    b='SELECT * FROM board_nation WHERE "wMAPE" IS NOT NULL AND "IntervalScore_80" IS NOT NULL'))
def _(t):
    return tidy(E.accuracy_vs_interval(board(t)))


@query("best_baseline", sql("SELECT model, \"wMAPE\" FROM board_nation WHERE stage = 'baseline' "
                            'ORDER BY "wMAPE", model LIMIT 1', "wMAPE"))
def _(t):
    return tidy(E.best_baseline(board(t)))


@query("champion_challenger", sql(
    'SELECT c.model AS challenger, d.model AS defender, d."wMAPE" - c."wMAPE" AS delta, CASE WHEN d."wMAPE" - '
    'c."wMAPE" >= 0.03 THEN c.model ELSE d.model END AS champion FROM (SELECT * FROM board_nation ORDER BY "wMAPE", '
    "model LIMIT 1) c, (SELECT * FROM board_nation WHERE stage = 'baseline' ORDER BY \"wMAPE\", model LIMIT 1) d",
    "delta"))
def _(t):
    return tidy(E.champion_challenger(board(t)))


@query("final_artifacts", sql(
    "SELECT 'forecasts' AS part, count(*) AS n_rows, sum(y_hat) AS total FROM forecasts_nation UNION ALL "
    "SELECT 'scores', 8, sum(\"wMAPE\" + \"Bias\" + \"IntervalScore_80\" + \"Coverage_80\") FROM wide_scores_nation WHERE stage "
    "= 'baseline' UNION ALL SELECT 'leaderboard', count(*), sum(\"wMAPE\") FROM board_nation", "total"))
def _(t):
    f = settle(t.forecasts)  # three results are computed from it
    baselines = f.filter("model = 'Naive'")
    every, scored, ranked = E.final_tables(
        baselines, {"base": f.filter("model = 'LagBlend'")}, f.filter("model = 'SeasonalNaive'"), "nation")
    parts = [
        every.agg(F.lit("forecasts").alias("part"), F.count(F.lit(1)).alias("n_rows"), F.sum("y_hat").alias("total")),
        scored.agg(F.lit("scores").alias("part"), F.count(F.lit(1)).alias("n_rows"), F.sum("score").alias("total")),
        ranked.agg(F.lit("leaderboard").alias("part"), F.count(F.lit(1)).alias("n_rows"), F.sum("wMAPE").alias("total")),
    ]
    return tidy(E.union_forecasts(*parts))


@query("final_artifacts_models")
def _(t):
    """The same tables from smoothing, boosted trees of three kinds and the direct model, all with intervals."""
    panel, folds = settle(t.panel("nation"), "model-panel"), t.folds()

    def banded(forecaster, model: str, stage: str):
        return settle(E.named(N.conformal_interval(panel, forecaster, folds), model, stage), "banded")

    baselines = E.union_forecasts(banded(N.seasonal_naive, "SeasonalNaive", "baseline"), banded(ets_auto, "ETS", "baseline"))
    trees = {"base": banded(T.gbt_base(), "Trees", "ml"), "rich": banded(T.gbt_rich(), "Trees-Rich", "ml")}
    direct = banded(T.direct_multihorizon(), "Direct", "dl")
    every, scored, ranked = E.final_tables(baselines, trees, direct, "nation")
    counts = every.groupBy("model", "stage").agg(F.count(F.lit(1)).alias("n_rows"))
    losses = scored.filter("metric = 'IntervalScore_80'").select("model", F.col("score").alias("interval_score"))
    return tidy(ranked.select("model", "wMAPE").join(counts, "model").join(losses, "model"))


@query("interval_coverage_levels", sql(
    "SELECT model, avg((hi_80 - lo_80) + 2 / (1 - 0.9::DOUBLE) * greatest(lo_80 - y, 0.0) + 2 / (1 - 0.9::DOUBLE) * "
    "greatest(y - hi_80, 0.0)) AS score FROM forecasts_nation WHERE lo_80 IS NOT NULL GROUP BY 1", "score"))
def _(t):
    rows = t.forecasts.filter(F.col("lo_80").isNotNull())
    return tidy(rows.groupBy("model").agg(
        M.interval_score(F.col(TARGET), F.col("lo_80"), F.col("hi_80"), coverage=0.9).alias("score")))
