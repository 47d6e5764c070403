"""Times the headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""

import json
import os
import time

from pyspark.sql import functions as F

from tidepanel.config import KEY
from tidepanel.operators import evaluate as E
from tidepanel.operators import features as X
from tidepanel.operators import folds as B
from tidepanel.operators import forecast as N
from tidepanel.operators import glm as G
from tidepanel.operators import monitor as O
from tidepanel.operators import panel as P
from tidepanel.operators import profile as R
from tidepanel.operators import select as S
from tidepanel.operators import trained as T
from tidepanel.operators.ets import ets_auto
from tidepanel.plans.base import BLEND, BLEND_SPECS, Tables
from tidepanel.plans.scores import flagship
from tidepanel.session import local_session, settle


def jobs(t: Tables, panel, types):
    """Name to a function that returns the DataFrame to run. ``panel`` has one series per supplier."""
    folds = t.folds()
    top = settle(S.top_n_panel(panel, 50), "bench-top")
    # ids of five levels for the hierarchy of the categorical model
    five = F.concat_ws("_", F.lit("F"), F.col(KEY).cast("int") % 3, KEY, F.lit("R"), F.col(KEY).cast("int") % 5)
    levels = settle(top.withColumn(KEY, five), "bench-levels")

    def both():
        return E.union_forecasts(
            E.named(N.naive_gaussian(panel, folds), "Naive", "baseline"),
            E.named(N.seasonal_naive_gaussian(panel, folds), "SeasonalNaive", "baseline"),
        )

    return {
        "flagship": lambda: flagship(t),
        "naive_all_series": lambda: N.naive(t.sparse("supplier"), folds),
        "panel_build": lambda: t.panel("supplier"),
        "gap_summary": lambda: P.gap_summary(t.raw("supplier")),
        "subset_policy": lambda: S.subset_policy(panel, max_zero=1.0, last=t.last),
        "zero_fraction_summary": lambda: R.zero_fraction_summary(R.zero_fraction(panel)),
        "dow_profile": lambda: R.dow_profile(panel),
        "cv_folds": lambda: B.cv_folds(panel, folds),
        "features_base": lambda: X.add_features(panel, X.BASE),
        "features_rich": lambda: X.add_features(panel, X.RICH),
        "baselines_leaderboard": lambda: E.build_leaderboard([E.score_forecasts(both(), "supplier")]),
        "conformal_seasonal_naive": lambda: N.conformal_interval(panel, N.seasonal_naive, folds),
        "recursive_linear": lambda: T.recursive_forecast(T.linear_scorer(BLEND), panel, folds, BLEND_SPECS),
        "ets_auto": lambda: ets_auto(panel, folds),
        "sample_paths": lambda: N.path_summary(N.sample_paths(panel, folds)),
        "abc_tiers": lambda: O.abc_tiers(panel),
        "gbt_base_50_series": lambda: T.gbt_base()(top, folds),
        "gbt_rich_50_series": lambda: T.gbt_rich()(top, folds),
        "gbt_cat_50_series": lambda: T.gbt_cat()(levels, folds),
        "direct_50_series": lambda: T.direct_multihorizon()(top, folds),
        "tweedie_glm_all_series": lambda: G.tweedie_glm(1.5)(panel, folds),
        "gbt_base_types": lambda: T.gbt_base()(types, folds),
    }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "tidepanel-bench")
    t = Tables(spark, folder)
    panel, types = settle(t.panel("supplier"), "bench"), settle(t.panel("type"), "bench-types")
    times = {}
    for name, job in jobs(t, panel, types).items():
        start = time.perf_counter()
        job().write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "total_seconds", "value": total, "unit": "sec", "queries": times,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1], "panel_rows": panel.count(),
    }))


if __name__ == "__main__":
    main()
