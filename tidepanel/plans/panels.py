"""Registered queries: series selection, joins, panel profile and repair."""

from pyspark.sql import functions as F

from tidepanel.config import DAY, KEY, TARGET
from tidepanel.functions.ranks import exact_quantiles
from tidepanel.operators import features as X
from tidepanel.operators import folds as B
from tidepanel.operators import panel as P
from tidepanel.operators import profile as R
from tidepanel.operators import select as S
from tidepanel.plans.base import query, sql, tidy
from tidepanel.session import settle

CUT = "(SELECT hi - 84 FROM span)"
STATS = (f"SELECT unique_id, min(ds) AS first_day, avg(CASE WHEN y = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS "
         f"zero_share, sum(y) AS total FROM %s WHERE ds < {CUT} GROUP BY 1")


def cut(t):
    return P.first_cutoff(t.last)


@query("train_before_cutoff", sql(f"SELECT * FROM panel_nation WHERE ds < {CUT}"))
def _(t):
    return P.train_rows(t.panel("nation"), cut(t))


@query("context_upto_cutoff", sql(f"SELECT * FROM panel_nation WHERE ds <= {CUT}"))
def _(t):
    return P.context_rows(t.panel("nation"), cut(t))


# every fourth supplier enters the panel 300 days before its end
LATE_SQL = "SELECT r.* FROM raw_supplier r, span WHERE CAST(unique_id AS INTEGER) % 4 <> 0 OR ds > hi - 300"


@query("filter_min_history", sql(
    f"SELECT r.* FROM late r WHERE unique_id IN (SELECT unique_id FROM stats WHERE first_day <= {CUT} - 365)",
    stats=STATS % "late", late=LATE_SQL))
def _(t):
    entered = (F.col(KEY).cast("int") % 4 != 0) | (F.col(DAY) > F.date_sub(F.lit(t.last), 300))
    panel = t.raw("supplier").filter(entered)
    return S.keep_series(panel, S.training_stats(panel, cut(t)).filter(S.long_enough(cut(t))))


@query("filter_intermittent", sql(
    "SELECT p.* FROM panel_type_region p WHERE unique_id IN (SELECT unique_id FROM stats WHERE zero_share <= 0.5)",
    stats=STATS % "panel_type_region"))
def _(t):
    panel = t.panel("type_region")
    return S.keep_series(panel, S.training_stats(panel, cut(t)).filter(S.rarely_zero()))


# nations with an even number of letters sell nothing
IDLE_SQL = "SELECT unique_id, ds, CASE WHEN length(unique_id) % 2 = 0 THEN 0.0 ELSE y END AS y FROM panel_nation"


@query("filter_positive_total", sql(
    "SELECT p.* FROM idle p WHERE unique_id IN (SELECT unique_id FROM stats WHERE total > 0)",
    stats=STATS % "idle", idle=IDLE_SQL.replace("0.0", "0.0::DOUBLE")))
def _(t):
    panel = t.panel("nation")
    panel = panel.withColumn(TARGET, F.when(F.length(KEY) % 2 == 0, 0.0).otherwise(F.col(TARGET)))
    return S.keep_series(panel, S.training_stats(panel, cut(t)).filter(S.sells()))


@query("subset_policy", sql(
    f"SELECT p.* FROM panel_type_region p WHERE unique_id IN (SELECT unique_id FROM stats WHERE zero_share <= 0.5 "
    f"AND total > 0 AND first_day <= {CUT} - 365 ORDER BY total DESC, unique_id LIMIT 10)",
    stats=STATS % "panel_type_region"))
def _(t):
    return S.subset_policy(t.panel("type_region"), n=10, last=t.last)


@query("top_n_series", sql(
    "SELECT p.* FROM panel_supplier p WHERE unique_id IN (SELECT unique_id FROM panel_supplier GROUP BY 1 "
    "ORDER BY sum(y) DESC, unique_id LIMIT 50)"))
def _(t):
    return S.top_n_panel(t.panel("supplier"), 50)


@query("filter_stage", sql("SELECT * FROM forecasts_nation WHERE stage = 'ml'", "y_hat"))
def _(t):
    return tidy(S.filter_stage(t.forecasts, "ml"))


@query("filter_has_interval", sql(
    "SELECT * FROM forecasts_nation WHERE lo_80 IS NOT NULL AND hi_80 IS NOT NULL", "y_hat lo_80 hi_80"))
def _(t):
    return tidy(S.with_interval(t.forecasts))


@query("models_with_full_intervals", sql(
    "SELECT model FROM forecasts_nation GROUP BY 1 HAVING bool_and(lo_80 IS NOT NULL AND hi_80 IS NOT NULL)"))
def _(t):
    return S.models_with_full_intervals(t.forecasts)


@query("filter_short_context", sql(
    "SELECT r.unique_id, c.cutoff, count(*) AS n_context FROM raw_supplier r JOIN cutoffs c ON r.ds <= c.cutoff "
    "GROUP BY 1, 2 HAVING count(*) >= 14"))
def _(t):
    return B.drop_short_context(t.raw("supplier"), t.folds())


GRID = ("SELECT k.unique_id, c.cutoff, c.cutoff + h.h AS ds, h.h FROM (SELECT DISTINCT unique_id FROM raw_supplier) k, "
        "cutoffs c, (SELECT CAST(h AS INTEGER) AS h FROM range(1, 29) t(h)) h")


def grid(t):
    return B.horizon_grid(t.raw("supplier").select(KEY).distinct(), t.folds())


@query("horizon_grid", sql(GRID))
def _(t):
    return grid(t)


@query("join_actuals_to_horizon", sql(
    "SELECT g.*, r.y FROM grid g LEFT JOIN raw_supplier r ON r.unique_id = g.unique_id AND r.ds = g.ds", grid=GRID))
def _(t):
    return B.attach_actuals(grid(t), t.raw("supplier"))


@query("drop_missing_actuals", sql(
    "SELECT g.*, r.y FROM grid g JOIN raw_supplier r ON r.unique_id = g.unique_id AND r.ds = g.ds", grid=GRID))
def _(t):
    return B.drop_missing_actuals(grid(t), t.raw("supplier"))


TOP1 = "SELECT unique_id FROM panel_nation GROUP BY 1 ORDER BY sum(y) DESC, unique_id LIMIT 1"


@query("latest_cutoff_slice", sql(
    f"SELECT * FROM forecasts_nation WHERE unique_id IN ({TOP1}) AND cutoff = (SELECT max(cutoff) FROM cutoffs) "
    "AND model IN ('Naive', 'LagBlend')", "y_hat lo_80 hi_80"))
def _(t):
    return tidy(S.latest_slice(t.forecasts, S.top_series(t.panel("nation"), 1), ["Naive", "LagBlend"]))


@query("lookback_slice", sql(
    f"SELECT * FROM panel_nation WHERE unique_id IN ({TOP1}) AND ds >= (SELECT max(cutoff) FROM cutoffs) - 42"))
def _(t):
    panel = t.panel("nation")
    return S.lookback_slice(panel, S.top_series(panel, 1), t.folds().cutoffs[-1], 42)


@query("sort_panel", sql("SELECT * FROM panel_nation ORDER BY unique_id, ds"))
def _(t):
    return P.sort_panel(t.panel("nation"))


@query("semi_join_series", sql(
    "SELECT p.* FROM panel_supplier p WHERE unique_id IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier "
    "WHERE s_acctbal > 0)"))
def _(t):
    ids = t["supplier"].filter("s_acctbal > 0").select(F.col("s_suppkey").cast("string").alias(KEY))
    return S.keep_series(t.panel("supplier"), ids)


@query("join_fold_range", sql("SELECT * FROM tests_nation"))
def _(t):
    return B.assign_test_window(t.panel("nation"), t.folds())


@query("join_static", sql(
    "SELECT p.unique_id, p.ds, p.y, n.n_name, n.n_regionkey FROM raw_supplier p LEFT JOIN supplier "
    "ON p.unique_id = CAST(s_suppkey AS VARCHAR) LEFT JOIN nation n ON s_nationkey = n_nationkey"))
def _(t):
    rows = t["supplier"].withColumn("l_suppkey", F.col("s_suppkey")).drop("s_suppkey", "s_nationkey")
    static = t.dims(rows, "supplier", "nation")
    static = static.select(F.col("l_suppkey").cast("string").alias(KEY), "n_name", "n_regionkey")
    return X.attach_static(t.raw("supplier"), static)


# --- profile --------------------------------------------------------------------------------------------
@query("series_totals", sql("SELECT unique_id, sum(y) AS total FROM panel_supplier GROUP BY 1"))
def _(t):
    return S.series_totals(t.panel("supplier")).orderBy(F.desc("total"), KEY)


ZERO = "SELECT unique_id, avg(CASE WHEN y = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS zero_fraction FROM %s GROUP BY 1"


@query("zero_fraction", sql(ZERO % "panel_supplier", "zero_fraction"))
def _(t):
    return tidy(R.zero_fraction(t.panel("supplier")))


@query("zero_fraction_summary", sql(
    "SELECT count(*) AS n_series, count(*) FILTER (zero_fraction > 0.3) AS n_above, max(zero_fraction) AS "
    "max_fraction, quantile_cont(zero_fraction, 0.5) AS median_fraction FROM zf", "max_fraction median_fraction",
    zf=ZERO % "panel_supplier"))
def _(t):
    return tidy(R.zero_fraction_summary(R.zero_fraction(t.panel("supplier"))))


@query("history_depth", sql(
    "SELECT unique_id, min(ds) AS start_date, any_value(hi) - 84 - 365 AS needed_start, "
    "min(ds) <= any_value(hi) - 84 - 365 AS sufficient FROM raw_supplier, span GROUP BY 1"))
def _(t):
    return R.history_depth(t.raw("supplier"), t.last)


GAPS = ("SELECT unique_id, min(ds) AS start_date, max(ds) AS end_date, count(ds) AS observed_rows, "
        "date_diff('day', min(ds), max(ds)) + 1 AS expected_rows, date_diff('day', min(ds), max(ds)) + 1 - count(ds) "
        "AS missing_rows, (date_diff('day', min(ds), max(ds)) + 1 - count(ds)) / "
        "(date_diff('day', min(ds), max(ds)) + 1) AS missing_pct FROM %s GROUP BY 1")


@query("gap_summary", sql(GAPS % "raw_supplier", "missing_pct"))
def _(t):
    return tidy(P.gap_summary(t.raw("supplier")))


@query("gap_percentiles", sql(
    'SELECT count(missing_pct) AS "count", round(avg(missing_pct), 3) AS mean, round(stddev_samp(missing_pct), 3) '
    "AS std, round(min(missing_pct), 3) AS min, round(quantile_cont(missing_pct, 0.25), 3) AS p25, "
    "round(quantile_cont(missing_pct, 0.5), 3) AS p50, round(quantile_cont(missing_pct, 0.75), 3) AS p75, "
    "round(quantile_cont(missing_pct, 0.9), 3) AS p90, round(max(missing_pct), 3) AS max FROM gaps",
    gaps=GAPS % "raw_supplier"))
def _(t):
    return R.describe(P.gap_summary(t.raw("supplier")), "missing_pct")


@query("gap_top10", sql("SELECT * FROM gaps ORDER BY missing_pct DESC, unique_id LIMIT 10", "missing_pct",
                        gaps=GAPS % "raw_supplier"))
def _(t):
    return tidy(R.gappiest(P.gap_summary(t.raw("supplier"))))


@query("gap_assert", sql(
    "SELECT 'filled' AS panel, CAST(0 AS BIGINT) AS missing, true AS passed UNION ALL SELECT 'raw', (SELECT CAST(sum(m) AS "
    "BIGINT) FROM (SELECT max(ds) - min(ds) + 1 - count(*) AS m FROM raw_supplier GROUP BY unique_id) x), false"))
def _(t):
    """The check passes a filled panel and stops at a raw one, naming the missing days."""
    rows = []
    for name, panel in (("filled", t.panel("supplier")), ("raw", t.raw("supplier"))):
        try:
            P.assert_no_gaps(panel)
            rows.append((name, 0, True))
        except P.GapError as error:
            rows.append((name, error.missing, False))
    return t.spark.createDataFrame(rows, "panel string, missing long, passed boolean")


DOW = "SELECT CAST(isodow(ds) - 1 AS INTEGER) AS dow, avg(y) AS mean_y FROM panel_nation GROUP BY 1"


@query("dow_profile", sql(DOW, "mean_y"))
def _(t):
    return tidy(R.dow_profile(t.panel("nation")))


@query("dow_peak_trough", sql("""SELECT ['Mon','Tue','Wed','Thu','Fri','Sat','Sun'][arg_max(dow, mean_y) + 1] AS
peak_day, max(mean_y) AS peak_mean, ['Mon','Tue','Wed','Thu','Fri','Sat','Sun'][arg_min(dow, mean_y) + 1] AS trough_day,
min(mean_y) AS trough_mean, max(mean_y) / min(mean_y) AS peak_trough_ratio, avg(mean_y) AS panel_mean FROM prof""",
                               "peak_mean trough_mean peak_trough_ratio panel_mean", prof=DOW))
def _(t):
    return tidy(R.dow_peak_trough(R.dow_profile(t.panel("nation"))))


@query("histogram_fixed", sql("""SELECT b.bin, lo + b.bin * (hi - lo) / 40 AS left_edge,
lo + (b.bin + 1) * (hi - lo) / 40 AS right_edge, count(z.zero_fraction) AS n FROM range(40) b(bin)
CROSS JOIN (SELECT min(zero_fraction) AS lo, max(zero_fraction) AS hi FROM zf) e LEFT JOIN zf z
ON b.bin = least(floor((z.zero_fraction - lo) / (hi - lo) * 40), 39) GROUP BY 1, 2, 3""", "left_edge right_edge",
                              zf=ZERO % "panel_supplier"))
def _(t):
    return tidy(R.histogram(R.zero_fraction(t.panel("supplier")), "zero_fraction", 40))


WIDTHS = "SELECT model, hi_80 - lo_80 AS width FROM forecasts_supplier WHERE lo_80 IS NOT NULL AND hi_80 IS NOT NULL"


@query("interval_width_hist", sql("""SELECT model, CAST(bin AS BIGINT) AS bin, lo + bin * (hi - lo) / 60 AS left_edge,
count(*) AS n, count(*) / any_value(total) / ((hi - lo) / 60) AS density FROM (SELECT w.model, e.lo, e.hi, e.total,
least(floor((least(w.width, e.hi) - e.lo) / (e.hi - e.lo) * 60), 59) AS bin FROM widths w JOIN ends e
ON e.model = w.model) x GROUP BY model, lo, hi, bin""", "left_edge density", widths=WIDTHS,
                                  ends="SELECT model, min(width) AS lo, quantile_cont(width, 0.99) AS hi, count(*) AS "
                                       "total FROM widths GROUP BY 1"))
def _(t):
    return tidy(R.interval_width_hist(settle(t.forecasts_on("supplier"))))


@query("interval_width_median", sql("SELECT model, quantile_cont(width, 0.5) AS median_width FROM widths GROUP BY 1",
                                    "median_width", widths=WIDTHS))
def _(t):
    return tidy(R.interval_width_median(settle(t.forecasts_on("supplier"))))


@query("exact_quantiles", " UNION ALL ".join(
    f"SELECT l_returnflag, {p}::DOUBLE AS prob, round(quantile_cont(l_extendedprice, {p}), 6) AS quantile FROM lineitem "
    "GROUP BY 1" for p in (0.1, 0.5, 0.99)))
def _(t):
    return tidy(exact_quantiles(t["lineitem"], "l_extendedprice", [0.1, 0.5, 0.99], ["l_returnflag"]))


@query("panel_profile", sql("SELECT count(DISTINCT unique_id) AS n_series, count(*) AS n_rows, min(ds) AS min_ds, "
                            "max(ds) AS max_ds FROM raw_supplier"))
def _(t):
    return R.panel_profile(t.raw("supplier"))


# --- repair ---------------------------------------------------------------------------------------------
OWN_GRID = ("SELECT s.unique_id, CAST(unnest(generate_series(s.a, %s, INTERVAL 1 DAY)) AS DATE) AS ds FROM "
            "(SELECT unique_id, min(ds) AS a, max(ds) AS b FROM raw_nation GROUP BY 1) s, "
            "(SELECT max(ds) AS z FROM raw_nation) g")
FILLED = ("SELECT g.unique_id, g.ds, r.y FROM grid g LEFT JOIN raw_nation r ON r.unique_id = g.unique_id "
          "AND r.ds = g.ds")


@query("fill_gaps", sql(FILLED, grid=OWN_GRID % "g.z"))
def _(t):
    return P.fill_gaps(t.raw("nation"))


@query("fill_gaps_own_range", sql(FILLED, grid=OWN_GRID % "s.b"))
def _(t):
    return P.fill_gaps(t.raw("nation"), end="series")


@query("zero_fill", sql("SELECT unique_id, ds, coalesce(y, 0.0) AS y FROM filled", grid=OWN_GRID % "g.z", filled=FILLED))
def _(t):
    return P.zero_fill(P.fill_gaps(t.raw("nation")))


@query("forward_fill", sql(
    "SELECT unique_id, ds, last_value(y IGNORE NULLS) OVER (PARTITION BY unique_id ORDER BY ds) AS y FROM filled",
    grid=OWN_GRID % "g.z", filled=FILLED))
def _(t):
    return P.forward_fill(P.fill_gaps(t.raw("nation")))


@query("longest_gap", sql(
    "SELECT unique_id, coalesce(max(run), 0) AS longest_gap FROM (SELECT unique_id, ds - lag(ds) OVER "
    "(PARTITION BY unique_id ORDER BY ds) - 1 AS run FROM raw_supplier) GROUP BY 1"))
def _(t):
    return P.longest_gap(t.raw("supplier"))


@query("drop_gappy_series", sql(
    "SELECT r.* FROM raw_nation r WHERE unique_id IN (SELECT unique_id FROM gaps WHERE missing_pct <= 0.30) "
    "AND unique_id IN (SELECT unique_id FROM (SELECT unique_id, ds - lag(ds) OVER (PARTITION BY unique_id ORDER BY ds) "
    "- 1 AS run FROM raw_nation) GROUP BY 1 HAVING coalesce(max(run), 0) < 7)", gaps=GAPS % "raw_nation"))
def _(t):
    return P.drop_gappy_series(t.raw("nation"), 0.30, 7)
