"""Registered queries: lags, rolling windows, dates, scalar functions, back-test frames."""

from pyspark.sql import functions as F

from tidepanel.config import DAY, KEY, TARGET
from tidepanel.functions import metrics as M
from tidepanel.functions import scalars as C
from tidepanel.operators import evaluate as E
from tidepanel.operators import features as X
from tidepanel.operators import folds as B
from tidepanel.plans.base import WINKLER_SQL, Tables, query, sql, tidy

SERIES = "(PARTITION BY unique_id ORDER BY ds%s)"


def _frame(lag: int, n: int) -> str:
    return SERIES % f" ROWS BETWEEN {lag + n - 1} PRECEDING AND {lag} PRECEDING"


def _full(value: str, lag: int, n: int) -> str:
    w = _frame(lag, n)
    return f"CASE WHEN count(y) OVER {w} = {n} THEN {value} OVER {w} END"


def _register(name: str, specs: list, columns: dict[str, str]) -> None:
    cells = ", ".join(f"{text} AS {column}" for column, text in columns.items())

    @query(name, sql(f"SELECT unique_id, ds, y, {cells} FROM panel_nation", " ".join(columns)))
    def _(t: Tables):
        out = X.add_features(t.panel("nation"), specs)
        return tidy(out.select(KEY, DAY, TARGET, *[F.col(c).cast("double").alias(c) for c in columns]))


def _lags(days: list[int]) -> dict[str, str]:
    return {f"lag{k}": f"lag(y, {k}) OVER {SERIES % ''}" for k in days}


def _weeks(n: int) -> str:
    total = " + ".join(f"lag(y, {7 * k}) OVER {SERIES % ''}" for k in range(1, n + 1))
    return f"({total}) / {n}"


_register("lag_base", X.BASE, _lags([7, 14, 28]))
_register("lag_rich", X.RICH, _lags([7, 14, 21, 28]))
_register("roll_mean_l7_w28", [X.Rolling("mean", 7, 28)], {"mean_l7_w28": _full("avg(y)", 7, 28)})
_register("roll_std_l7_w28", [X.Rolling("std", 7, 28)], {"std_l7_w28": _full("stddev_samp(y)", 7, 28)})
_register("roll_min_l7_w28", [X.Rolling("min", 7, 28)], {"min_l7_w28": _full("min(y)", 7, 28)})
_register("roll_max_l7_w28", [X.Rolling("max", 7, 28)], {"max_l7_w28": _full("max(y)", 7, 28)})
_register("roll_q25_l7_w28", [X.Rolling("quantile", 7, 28, 0.25)],
          {"q25_l7_w28": _full("quantile_cont(y, 0.25)", 7, 28)})
_register("roll_q75_l7_w28", [X.Rolling("quantile", 7, 28, 0.75)],
          {"q75_l7_w28": _full("quantile_cont(y, 0.75)", 7, 28)})
_register("seasonal_roll_mean_4", [X.SeasonalMean(4)], {"seasonal_mean_4": _weeks(4)})
_register("seasonal_roll_mean_8", [X.SeasonalMean(8)], {"seasonal_mean_8": _weeks(8)})
_register("roll_mean_l14_w28", [X.Rolling("mean", 14, 28)], {"mean_l14_w28": _full("avg(y)", 14, 28)})

_ANGLE = "2 * pi() * {k} * (isodow(ds) - 1) / 7"
_YEAR = "2 * pi() * dayofyear(ds) / 365.25::DOUBLE"
FOURIER = X.fourier_specs()
_register("fourier_weekly_k1", FOURIER, {f"week_{f}1": f"{f}({_ANGLE.format(k=1)})" for f in ("sin", "cos")})
_register("fourier_weekly_k2", FOURIER, {f"week_{f}2": f"{f}({_ANGLE.format(k=2)})" for f in ("sin", "cos")})
_register("fourier_annual_k1", FOURIER, {f"year_{f}1": f"{f}({_YEAR})" for f in ("sin", "cos")})
# a date feature that a user adds
_register("custom_date_feature", [X.Calendar("month_end", lambda d: (F.last_day(d) == d).cast("int"))],
          {"month_end": "CAST(last_day(ds) = ds AS INTEGER)::DOUBLE"})

RICH_SQL = {
    **_lags([7, 14, 21, 28]),
    "mean_l7_w28": _full("avg(y)", 7, 28), "std_l7_w28": _full("stddev_samp(y)", 7, 28),
    "min_l7_w28": _full("min(y)", 7, 28), "max_l7_w28": _full("max(y)", 7, 28),
    "q25_l7_w28": _full("quantile_cont(y, 0.25)", 7, 28), "q75_l7_w28": _full("quantile_cont(y, 0.75)", 7, 28),
    "seasonal_mean_4": _weeks(4), "seasonal_mean_8": _weeks(8), "mean_l14_w28": _full("avg(y)", 14, 28),
    **{f"week_{f}{k}": f"{f}({_ANGLE.format(k=k)})" for k in (1, 2) for f in ("sin", "cos")},
    **{f"year_{f}1": f"{f}({_YEAR})" for f in ("sin", "cos")},
    "month": "CAST(month(ds) AS DOUBLE)",
}


def rich_sql(source: str) -> str:
    return f"SELECT unique_id, ds, y, {', '.join(f'{v} AS {k}' for k, v in RICH_SQL.items())} FROM {source}"


@query("training_matrix", sql(
    "SELECT m.*, n_regionkey FROM m LEFT JOIN nation ON n_name = m.unique_id WHERE ds <= (SELECT min(cutoff) FROM "
    "cutoffs) AND " + " AND ".join(f"{c} IS NOT NULL" for c in RICH_SQL), " ".join(RICH_SQL),
    m=rich_sql("panel_nation")))
def _(t):
    static = t["nation"].select(F.col("n_name").alias(KEY), "n_regionkey")
    out = X.training_matrix(t.panel("nation"), X.RICH, t.folds().first, static)
    return tidy(out.withColumn("month", F.col("month").cast("double")))


# --- scalar functions -----------------------------------------------------------------------------------
@query("date_dayofweek", "SELECT o_orderkey, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS dow FROM orders")
def _(t):
    return t["orders"].select("o_orderkey", C.day_of_week(F.col("o_orderdate").cast("date")).alias("dow"))


@query("date_month", "SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders")
def _(t):
    return t["orders"].select("o_orderkey", F.month("o_orderdate").alias("month"))


HIER_SQL = """SELECT DISTINCT p_type || '_' || replace(p_brand, 'Brand#', '') || '_' || CAST(p_partkey AS VARCHAR)
|| '_' || r_name || '_' || CAST(s_nationkey AS VARCHAR) AS unique_id FROM lineitem JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
LEVELS_SQL = """SELECT unique_id, split_part(unique_id, '_', 1) AS cat_id,
split_part(unique_id, '_', 1) || '_' || split_part(unique_id, '_', 2) AS dept_id,
split_part(unique_id, '_', 4) AS state_id,
split_part(unique_id, '_', 4) || '_' || split_part(unique_id, '_', 5) AS store_id FROM hier"""


def hierarchy(t: Tables):
    """The CATEGORY_DEPT_ITEM_STATE_STORE ids that have sales."""
    rows = t.dims(t["lineitem"].select("l_partkey", "l_suppkey"), "part", "supplier", "nation", "region")
    key = F.concat_ws("_", "p_type", F.replace("p_brand", F.lit("Brand#"), F.lit("")), "p_partkey", "r_name",
                      "s_nationkey")
    return rows.select(key.alias(KEY)).distinct()


@query("hierarchy_split", sql(LEVELS_SQL, hier=HIER_SQL))
def _(t):
    return hierarchy(t).withColumns(C.hierarchy_parts(F.col(KEY)))


@query("category_codes", sql(
    "SELECT unique_id, store_id, CAST(dense_rank() OVER (ORDER BY store_id) - 1 AS INTEGER) AS store_code FROM levels",
    hier=HIER_SQL, levels=LEVELS_SQL))
def _(t):
    rows = hierarchy(t).withColumns(C.hierarchy_parts(F.col(KEY))).select(KEY, "store_id")
    return X.category_codes(rows, "store_id", "store_code")


@query("clip_lower", "SELECT s_suppkey, CASE WHEN s_acctbal < 5000 THEN greatest(s_acctbal - 100, 0.0) END AS clipped "
                     "FROM supplier")
def _(t):
    value = F.when(F.col("s_acctbal") < 5000, F.col("s_acctbal") - 100)
    return t["supplier"].select("s_suppkey", C.clip_lower(value).alias("clipped"))


@query("clip_upper_quantile", "SELECT l_orderkey, l_linenumber, round(least(l_extendedprice, (SELECT quantile_cont("
                              "l_extendedprice, 0.99) FROM lineitem)), 6) AS clipped FROM lineitem")
def _(t):
    from tidepanel.functions.ranks import exact_quantiles

    rows = t["lineitem"]
    top = exact_quantiles(rows, "l_extendedprice", [0.99]).select("quantile").scalar()
    return tidy(rows.select("l_orderkey", "l_linenumber", C.clip_upper(F.col("l_extendedprice"), top).alias("clipped")))


@query("date_shift", """SELECT o_orderkey, CAST(o_orderdate AS DATE) - 84 AS first_cutoff, CAST(o_orderdate AS DATE) +
28 AS horizon_end, date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS age_days FROM orders""")
def _(t):
    day = F.col("o_orderdate").cast("date")
    return t["orders"].select(
        "o_orderkey", F.date_sub(day, 84).alias("first_cutoff"), F.date_add(day, 28).alias("horizon_end"),
        F.datediff(day, F.lit("1995-01-01").cast("date")).cast("long").alias("age_days"),
    )


AT = "unique_id, ds, cutoff, model"


@query("abs_error", sql(f"SELECT {AT}, abs(y - y_hat) AS abs_error FROM forecasts_nation", "abs_error"))
def _(t):
    return tidy(t.forecasts.select(KEY, DAY, "cutoff", "model",
                                   M.abs_error(F.col(TARGET), F.col("y_hat")).alias("abs_error")))


@query("signed_error", sql(f"SELECT {AT}, y_hat - y AS signed_error FROM forecasts_nation", "signed_error"))
def _(t):
    return tidy(t.forecasts.select(KEY, DAY, "cutoff", "model",
                                   M.signed_error(F.col(TARGET), F.col("y_hat")).alias("signed_error")))


@query("winkler_row", sql(f"SELECT {AT}, {WINKLER_SQL} AS winkler FROM forecasts_nation", "winkler"))
def _(t):
    row = M.winkler(F.col(TARGET), F.col("lo_80"), F.col("hi_80"))
    return tidy(t.forecasts.select(KEY, DAY, "cutoff", "model", row.alias("winkler")))


@query("calibration_label", sql("""SELECT unique_id, model, cov, CASE WHEN abs(cov - 0.8) < 0.05 THEN 'green'
WHEN cov > 0.8 THEN 'orange' ELSE 'red' END AS label FROM (SELECT unique_id, model,
avg(CASE WHEN y >= lo_80 AND y <= hi_80 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS cov FROM forecasts_nation
GROUP BY 1, 2) x""", "cov"))
def _(t):
    cov = M.coverage_rate(F.col(TARGET), F.col("lo_80"), F.col("hi_80")).alias("cov")
    return tidy(t.forecasts.groupBy(KEY, "model").agg(cov).withColumn("label", M.calibration_label(F.col("cov"))))


@query("pct_improvement", sql("""SELECT unique_id, (l - s) / nullif(l, 0) * 100 AS pct FROM (SELECT unique_id,
sum(abs(y - y_hat)) FILTER (model = 'Naive') AS l, sum(abs(y - y_hat)) FILTER (model = 'LagBlend') AS s
FROM forecasts_nation GROUP BY 1) x""", "pct"))
def _(t):
    error = F.abs(F.col(TARGET) - F.col("y_hat"))
    per = t.forecasts.groupBy(KEY).agg(
        F.sum(F.when(F.col("model") == "Naive", error)).alias("l"),
        F.sum(F.when(F.col("model") == "LagBlend", error)).alias("s"))
    return tidy(per.select(KEY, C.pct_improvement(F.col("l"), F.col("s")).alias("pct")))


# --- back-test frames -----------------------------------------------------------------------------------
@query("cv_cutoffs", sql("SELECT CAST(i AS INTEGER) AS fold, hi - CAST((3 - i) * 28 AS INTEGER) AS cutoff FROM "
                         "(SELECT max(ds) AS hi FROM panel_nation) m, range(3) t(i)"))
def _(t):
    return B.cv_cutoffs(t.panel("nation"))


@query("cv_folds", sql("SELECT p.*, c.cutoff, CASE WHEN p.ds <= c.cutoff THEN 'train' ELSE 'test' END AS part "
                       "FROM panel_nation p JOIN cutoffs c ON p.ds <= c.cutoff + 28"))
def _(t):
    return B.cv_folds(t.panel("nation"), t.folds())


@query("refit_policy", sql(
    "SELECT 'once' AS policy, p.*, c.cutoff AS fit_cutoff FROM panel_nation p JOIN cutoffs c ON p.ds <= c.cutoff AND "
    "c.fold = 0 UNION ALL SELECT 'each', p.*, c.cutoff FROM panel_nation p JOIN cutoffs c ON p.ds <= c.cutoff"))
def _(t):
    panel, folds = t.panel("nation"), t.folds()
    return E.union_forecasts(
        B.refit_frames(panel, folds, False).withColumn("policy", F.lit("once")),
        B.refit_frames(panel, folds, True).withColumn("policy", F.lit("each")),
    )


@query("inner_validation_split", sql("SELECT p.*, c.cutoff, CASE WHEN p.ds > c.cutoff - 28 THEN 'valid' ELSE 'fit' END "
                                     "AS part FROM panel_nation p JOIN cutoffs c ON p.ds <= c.cutoff"))
def _(t):
    return B.inner_validation(t.panel("nation"), t.folds())


@query("multirate_pool", sql(
    "SELECT p.unique_id, c.cutoff, r.rate, CAST(floor((p.ds - (c.cutoff - 83)) / r.rate) AS INTEGER) AS block, "
    "avg(p.y) AS pooled FROM panel_nation p JOIN cutoffs c ON p.ds > c.cutoff - 84 AND p.ds <= c.cutoff "
    "CROSS JOIN (VALUES (1), (2), (7)) r(rate) GROUP BY ALL", "pooled"))
def _(t):
    return tidy(X.multirate_pool(B.fold_context(t.panel("nation"), t.folds(), 84)))
