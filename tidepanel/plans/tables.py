"""Registered queries: sources, sinks, reshapes, unions, contracts."""

from pyspark.sql import functions as F

from tidepanel import contracts as C
from tidepanel.config import DAY, KEY, TARGET
from tidepanel.functions.scalars import series_key
from tidepanel.operators import evaluate as E
from tidepanel.operators import panel as P
from tidepanel.operators import profile as R
from tidepanel.operators.features import static_of
from tidepanel.plans.base import Tables, query, sql, tidy
from tidepanel.session import fresh_path
from tidepanel.sources import readers, writers

MELTED_SQL = sql(
    "SELECT split_part(p.unique_id, '_', 1) AS item_id, split_part(p.unique_id, '_', 2) AS store_id, "
    "'d_' || CAST(p.ds - s.lo + 1 AS VARCHAR) AS d, CAST(p.y AS INTEGER) AS y FROM panel_type_region p, span s")


def wide_sales(t: Tables):
    """Sales with one column per day, as raw files have them."""
    lo, hi = t.span
    days = [f"d_{i + 1}" for i in range((hi - lo).days + 1)]
    parts = F.split(KEY, "_")
    at = F.datediff(DAY, F.lit(lo))
    rows = t.panel("type_region").select(
        parts[0].alias("item_id"), parts[1].alias("store_id"),
        F.struct(at.alias("at"), F.col(TARGET).cast("int").alias("v")).alias("c"),
    )
    packed = rows.groupBy("item_id", "store_id").agg(F.sort_array(F.collect_list("c"))["v"].alias("v"))
    wide = packed.selectExpr("item_id", "store_id", *[f"v[{i}] AS {d}" for i, d in enumerate(days)])
    ids = {"id": F.concat_ws("_", "item_id", "store_id"), "dept_id": F.col("item_id"), "cat_id": F.col("item_id"),
           "state_id": F.col("store_id")}
    return wide.withColumns(ids)


def calendar(t: Tables):
    """The label of each day that has orders."""
    day = F.col("o_orderdate").cast("date")
    label = F.concat(F.lit("d_"), (F.datediff(day, F.lit(t.span[0])) + 1).cast("string"))
    return t["orders"].select(label.alias("d"), day.alias(DAY)).distinct()


@query("scan_raw_csv", MELTED_SQL)
def _(t):
    folder = fresh_path(t.spark, "raw")
    wide_sales(t).write.option("header", True).csv(f"{folder}/sales.csv")
    calendar(t).withColumnRenamed(DAY, "date").write.option("header", True).csv(f"{folder}/calendar.csv")
    t["part"].select("p_type", "p_retailprice").write.option("header", True).csv(f"{folder}/prices.csv")
    return P.melt_wide(readers.read_raw(t.spark, folder)["sales"])


@query("melt_wide_sales", MELTED_SQL)
def _(t):
    return P.melt_wide(wide_sales(t))


@query("join_calendar", sql(
    "SELECT p.unique_id, c.ds, p.y FROM panel_type_region p LEFT JOIN calendar c ON c.ds = p.ds",
    calendar="SELECT DISTINCT CAST(o_orderdate AS DATE) AS ds FROM orders"))
def _(t):
    return P.join_calendar(P.key_sales(P.melt_wide(wide_sales(t))), calendar(t))


@query("scan_panel", sql("SELECT count(DISTINCT unique_id) AS n_series, count(*) AS n_rows, min(ds) AS min_ds, "
                         "max(ds) AS max_ds FROM panel_supplier"))
def _(t):
    path = fresh_path(t.spark, "panel") + ".parquet"
    t.panel("supplier").write.parquet(path)
    registry = {"panel": readers.Dataset(path, "panel", day=DAY)}
    out = R.panel_profile(readers.load_dataset(t.spark, registry, "panel"))
    return out.withColumn("n_rows", F.col("n_rows").cast("long"))


@query("sink_parquet", sql("SELECT * FROM panel_nation"))
def _(t):
    path = fresh_path(t.spark, "sink")
    writers.write_panel(t.panel("nation"), path)
    return t.spark.read.parquet(path)


@query("sink_csv_leaderboard", sql("SELECT * FROM board_nation", "wMAPE Bias IntervalScore_80 Coverage_80"))
def _(t):
    path = fresh_path(t.spark, "board")
    board = E.build_leaderboard([E.score_forecasts(t.forecasts, "nation")])
    writers.write_leaderboard(board, path)
    return tidy(t.spark.read.schema(board.schema).option("header", True).csv(path))


@query("load_dataset", sql(
    "SELECT 'csv' AS kind, * FROM board_nation UNION ALL SELECT 'json', * FROM board_nation",
    "wMAPE Bias IntervalScore_80 Coverage_80"))
def _(t):
    folder = fresh_path(t.spark, "sets")
    board = E.build_leaderboard([E.score_forecasts(t.forecasts, "nation")])
    writers.write_leaderboard(board, f"{folder}/board.csv")
    board.write.json(f"{folder}/board.json")
    ddl = board.schema.toDDL()
    registry = {k: readers.Dataset(f"{folder}/board.{k}", "leaderboard", ddl) for k in ("csv", "json")}
    parts = [readers.load_dataset(t.spark, registry, k).withColumn("kind", F.lit(k)) for k in registry]
    return tidy(E.union_forecasts(*parts))


@query("dataset_status", """
SELECT 'events' AS dataset, true AS present, count(*) AS n_rows, CAST(max(ts) AS DATE) AS max_day FROM events
UNION ALL SELECT 'lineitem', true, count(*), CAST(max(l_shipdate) AS DATE) FROM lineitem
UNION ALL SELECT 'nation', true, count(*), NULL FROM nation
UNION ALL SELECT 'orders', true, count(*), CAST(max(o_orderdate) AS DATE) FROM orders
UNION ALL SELECT 'returns', false, NULL, NULL""")
def _(t):
    days = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts", "nation": None, "returns": None}
    return readers.dataset_status(t.spark, {n: readers.Dataset(t.path(n), day=d) for n, d in days.items()})


# --- reshapes -------------------------------------------------------------------------------------------
@query("series_key", """
SELECT CASE WHEN p_size > 10 THEN p_type END || '_' || CAST(s_nationkey AS VARCHAR) AS unique_id, count(*) AS n
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1""")
def _(t):
    """Ids of which a part is NULL, as for small parts here, are NULL."""
    part = t["part"].select("p_partkey", F.when(F.col("p_size") > 10, F.col("p_type")).alias("p_type"))
    supplier = t["supplier"].select("s_suppkey", "s_nationkey")
    rows = t["lineitem"].join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    rows = rows.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    key = series_key(F.col("p_type"), F.col("s_nationkey").cast("string"))
    return rows.groupBy(key.alias(KEY)).agg(F.count(F.lit(1)).alias("n"))


@query("cast_target", "SELECT l_orderkey, l_linenumber, CAST(l_linenumber AS DOUBLE) AS y FROM lineitem")
def _(t):
    return t["lineitem"].select("l_orderkey", "l_linenumber", F.col("l_linenumber").cast("double").alias(TARGET))


@query("project_drop", sql("SELECT unique_id, ds, y, model, y_hat, cutoff, stage FROM forecasts_nation", "y_hat"))
def _(t):
    return tidy(t.forecasts.drop("lo_80", "hi_80", "index"))


@query("panel_daily", sql("SELECT * FROM raw_type_region"))
def _(t):
    return t.raw("type_region")


WIDE_SQL = ("SELECT n.unique_id, n.ds, n.cutoff, n.y, n.y_hat AS naive, n.lo_80 AS lo, n.hi_80 AS hi, "
            "b.y_hat AS blend FROM naive_band_nation n JOIN blend_nation b "
            "ON b.unique_id = n.unique_id AND b.ds = n.ds AND b.cutoff = n.cutoff")


def wide_cv(t: Tables):
    """One row per series, day and cutoff with a column per model, as back-test libraries return it."""
    f = t.forecasts
    at = [KEY, DAY, "cutoff", TARGET]

    def of(model, column):
        return F.max(F.when(F.col("model") == model, F.col(column)))

    return f.groupBy(*at).agg(
        of("Naive", "y_hat").alias("Naive"), of("Naive", "lo_80").alias("Naive-lo-80"),
        of("Naive", "hi_80").alias("Naive-hi-80"), of("LagBlend", "y_hat").alias("LagBlend"),
    )


LONG_SQL = sql(
    "SELECT unique_id, ds, y, model, y_hat, lo_80, hi_80, cutoff, 'baseline' AS stage FROM forecasts_nation "
    "WHERE model <> 'SeasonalNaive'", "y_hat lo_80 hi_80")


@query("cv_wide_to_long", LONG_SQL)
def _(t):
    return tidy(E.wide_to_long(wide_cv(t)))


def _renamed_sql(model: str, name: str, stage: str) -> str:
    return sql(f"SELECT unique_id, ds, y, '{name}' AS model, y_hat, lo_80, hi_80, cutoff, '{stage}' AS stage "
               f"FROM forecasts_nation WHERE model = '{model}'", "y_hat lo_80 hi_80")


@query("cv_rename_ml", _renamed_sql("Naive", "Trees", "ml"))
def _(t):
    return tidy(E.rename_model(wide_cv(t), "Naive", "Trees", "ml"))


@query("cv_rename_dl", _renamed_sql("LagBlend", "Direct", "dl"))
def _(t):
    return tidy(E.rename_model(wide_cv(t), "LagBlend", "Direct", "dl"))


@query("forecast_finalize", sql(
    "SELECT unique_id, ds, y, 'Naive' AS model, greatest(y_hat, 5.0) AS y_hat, greatest(lo_80, 5.0) AS lo_80, "
    "NULL::DOUBLE AS hi_80, cutoff, 'baseline' AS stage FROM naive_band_nation", "y_hat lo_80 hi_80"))
def _(t):
    from tidepanel.operators.forecast import naive_gaussian

    rows = naive_gaussian(t.panel("nation"), t.folds()).drop("hi_80")
    return tidy(E.named(rows, "Naive", "baseline", floor=5.0))


@query("fill_missing_forecast", sql(
    "SELECT t.unique_id, t.ds, t.cutoff, t.y, coalesce(r.y, 0.0) AS y_hat, coalesce(r.y, 0.0) AS lo_80, "
    "coalesce(r.y, 0.0) AS hi_80 FROM tests_nation t LEFT JOIN raw_nation r "
    "ON r.unique_id = t.unique_id AND r.ds = t.cutoff"))
def _(t):
    from tidepanel.operators.forecast import naive

    # without zero filling, a series that sold nothing on the cutoff day has no last value
    gappy = P.fill_gaps(t.raw("nation"), "global", "global", t.span)
    rows = naive(P.zero_fill(gappy), t.folds()).drop("y_hat")
    last = t.raw("nation").select(KEY, F.col(DAY).alias("cutoff"), F.col(TARGET).alias("y_hat"))
    rows = rows.join(last, [KEY, "cutoff"], "left")
    return E.fill_missing(rows, bounds_from_point=True).select(
        KEY, DAY, "cutoff", TARGET, "y_hat", "lo_80", "hi_80")


@query("union_forecasts", sql("SELECT * FROM forecasts_nation", "y_hat lo_80 hi_80"))
def _(t):
    return tidy(t.forecasts)


@query("distinct_static", """SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS unique_id, n_name, n_regionkey
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""")
def _(t):
    rows = t.dims(t["lineitem"].select("l_suppkey"), "supplier", "nation")
    return static_of(rows.withColumn(KEY, F.col("l_suppkey").cast("string")), ["n_name", "n_regionkey"])


# --- contracts ------------------------------------------------------------------------------------------
@query("contract_columns", """SELECT c.column_name, false AS present, n.n_rows
FROM (VALUES ('unique_id'), ('ds'), ('y')) c(column_name), (SELECT count(*) AS n_rows FROM orders) n""")
def _(t):
    orders = t["orders"]
    missing = C.missing_columns(orders, "panel")
    cells = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(c not in missing).alias("present"))
        for c in C.get_contract("panel").required
    ])
    return orders.agg(F.count(F.lit(1)).alias("n_rows")).select(F.inline(cells), "n_rows")


def _events_as_panel(t):
    return t["events"].select(F.col("event_type").alias(KEY), F.col("props").alias(DAY), F.col("value").alias(TARGET))


@query("contract_cast", """SELECT 'cast' AS "check", c.column_name, CASE c.column_name WHEN 'ds' THEN n.bad ELSE 0 END
AS bad_rows, n.n_rows FROM (VALUES ('unique_id'), ('ds'), ('y')) c(column_name),
(SELECT count(*) AS n_rows, count(*) FILTER (try_cast(props AS DATE) IS NULL) AS bad FROM events) n""")
def _(t):
    return C.contract_report(_events_as_panel(t), "panel").filter(F.col("check") == "cast")


@query("contract_optional", sql("""SELECT 'cast' AS "check", c.column_name,
CASE c.column_name WHEN 'lo_80' THEN n.bad ELSE 0 END AS bad_rows, n.n_rows
FROM (VALUES ('lo_80'), ('hi_80')) c(column_name),
(SELECT count(*) AS n_rows, count(*) FILTER (lo_80 IS NOT NULL) AS bad FROM forecasts_nation) n"""))
def _(t):
    rows = t.forecasts.withColumn("lo_80", F.concat(F.col("lo_80").cast("string"), F.lit(" units")))
    report = C.contract_report(rows, "forecast")
    return report.filter((F.col("check") == "cast") & F.col("column_name").isin("lo_80", "hi_80"))


@query("contract_scope_rule", """SELECT CASE WHEN o_orderstatus = 'F' THEN 'pooled_all_windows' ELSE o_orderpriority
END AS aggregation_scope, count(*) AS n_rows FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1""")
def _(t):
    scope = F.when(F.col("o_orderstatus") == "F", "pooled_all_windows").otherwise(F.col("o_orderpriority"))
    return C.disallowed_values(t["orders"].withColumn("aggregation_scope", scope), "score", "aggregation_scope")


@query("contract_nulls", sql("""SELECT 'null' AS "check", c.column_name,
CASE c.column_name WHEN 'y' THEN n.bad ELSE 0 END AS bad_rows, n.n_rows
FROM (VALUES ('unique_id'), ('ds'), ('y')) c(column_name), (SELECT count(*) AS n_rows, count(*) -
(SELECT count(*) FROM raw_nation) AS bad FROM panel_nation) n"""))
def _(t):
    gappy = P.fill_gaps(t.raw("nation"), "global", "global", t.span)
    return C.contract_report(gappy, "panel").filter(F.col("check") == "null")


@query("contract_panel", sql("SELECT * FROM panel_nation"))
def _(t):
    return C.validate(t.panel("nation"), "panel", "nation", unique=True)


@query("contract_forecast", sql("SELECT * FROM forecasts_nation", "y_hat lo_80 hi_80"))
def _(t):
    return tidy(C.validate(t.forecasts, "forecast", "nation", unique=True))


@query("contract_score", sql("""SELECT c."check", c.column_name, CASE WHEN c."check" = 'null' AND c.column_name = 'score'
THEN n.bad ELSE 0 END AS bad_rows, n.n_rows FROM (SELECT k."check", m.column_name FROM (VALUES ('cast'), ('null')) k("check"),
(VALUES ('model'), ('metric'), ('score'), ('stage'), ('aggregation_scope'), ('subset_name')) m(column_name) UNION ALL
SELECT 'rule', 'aggregation_scope') c, (SELECT count(*) AS n_rows, count(*) FILTER (score IS NULL) AS bad FROM
scores_nation) n"""))
def _(t):
    """A model without intervals has a NULL interval score, which the contract reports."""
    return C.contract_report(E.score_forecasts(t.forecasts, "nation"), "score")


@query("panel_readiness", sql("""SELECT 'series' AS "check", count(DISTINCT unique_id) AS value,
count(DISTINCT unique_id) >= 0.95 * 20 AS passed FROM panel_nation UNION ALL
SELECT 'span_days', date_diff('day', min(ds), max(ds)), date_diff('day', min(ds), max(ds)) >= 365 + 84 + 28
FROM panel_nation UNION ALL SELECT 'nulls', count(*) - count(y), count(*) = count(y) FROM panel_nation"""))
def _(t):
    return R.panel_readiness(t.panel("nation"), target_series=20)
