"""Registered queries: snapshots, corrections, late data, fallback, monitoring, streaming."""

from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from tidepanel.config import DAY, KEY, TARGET
from tidepanel.operators import features as X
from tidepanel.operators import forecast as N
from tidepanel.operators import glm as G
from tidepanel.operators import monitor as O
from tidepanel.operators import runs as U
from tidepanel.operators import trained as T
from tidepanel.operators.evaluate import named
from tidepanel.operators.folds import Folds
from tidepanel.operators.state import FeatureTable
from tidepanel.plans.base import BLEND, BLEND_SPECS, METRIC_SQL, Tables, query, sql, tidy
from tidepanel.plans.features import RICH_SQL, rich_sql
from tidepanel.session import fresh_path, settle
from tidepanel.sources import writers
from tidepanel.sources.batches import BatchTable
from tidepanel.streaming import daily
from tidepanel.streaming.upsert import DailyTables


@query("partitioned_append", sql("SELECT unique_id, ds, y, split_part(unique_id, '_', 2) AS region, CASE WHEN ds < DATE "
                                 "'1999-01-01' THEN 'old' ELSE 'new/2' END AS batch FROM raw_type_region"))
def _(t):
    """Two batches, of which one is sent twice, and a third that is staged but never committed."""
    table = BatchTable(t.spark, fresh_path(t.spark, "append"), f"{KEY} string, {DAY} date, {TARGET} double, region string",
                       ("region",), "panel")
    rows = settle(t.raw("type_region").withColumn("region", F.split(KEY, "_")[1]), "raw")
    border = F.lit("1999-01-01").cast("date")
    parts = {"old": rows.filter(F.col(DAY) < border), "new/2": rows.filter(F.col(DAY) >= border)}
    for name in ("old", "new/2", "old"):
        table.append(parts[name], name)
    table.stage(parts["old"], "stopped")
    return table.read()


@query("feature_snapshot_window", sql("SELECT *, ds AS snapshot_date FROM m WHERE ds = (SELECT max(ds) FROM panel_nation)",
                                      " ".join(RICH_SQL), m=rich_sql("panel_nation")))
def _(t):
    path = fresh_path(t.spark, "snapshots")
    panel = settle(t.panel("nation"), "panel")
    for day in (t.last - timedelta(days=1), t.last):  # the older partition stays as it is
        O.write_snapshot(panel, X.RICH, path, day)
    out = t.spark.read.parquet(path).filter(F.col("snapshot_date") == F.lit(t.last))
    return tidy(out.withColumn("month", F.col("month").cast("double")))


@query("feature_snapshot", sql("SELECT *, ds AS snapshot_date FROM m WHERE ds = (SELECT max(ds) FROM panel_nation)",
                               " ".join(RICH_SQL), m=rich_sql("panel_nation")))
def _(t):
    """The last three days are added one after the other, each from the state before it; the last one twice."""
    panel = settle(t.panel("nation"), "panel")
    table = FeatureTable(t.spark, fresh_path(t.spark, "snapshots"), X.RICH)
    table.begin(panel, t.last - timedelta(days=3))
    for back in (2, 1, 0, 0):
        table.add(panel, t.last - timedelta(days=back))
    return tidy(table.features(t.last).withColumn("month", F.col("month").cast("double")))


@query("feature_state", sql(
    "SELECT unique_id, count(*) AS n_days, sum(y) AS total, list(y ORDER BY ds)[-3:] AS recent, any_value(hi) AS "
    "state_date FROM panel_nation, span GROUP BY 1", "total"))
def _(t):
    """The state behind it after a week of days: counts, sums and the last three values."""
    panel = settle(t.panel("nation"), "panel")
    table = FeatureTable(t.spark, fresh_path(t.spark, "snapshots"), X.BASE)
    table.begin(panel, t.last - timedelta(days=7))
    for back in range(6, -1, -1):
        table.add(panel, t.last - timedelta(days=back))
    return tidy(table.state(t.last).select(KEY, "n_days", "total", F.slice("past", -3, 3).alias("recent"), "state_date"))


# corrections: returned quantities come off the day they were ordered
FIXES_SQL = """SELECT n_name AS unique_id, CAST(o_orderdate AS DATE) AS ds, sum(l_quantity) FILTER (l_returnflag <> 'R')
AS y FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON
s_nationkey = n_nationkey WHERE o_orderpriority = '1-URGENT' GROUP BY 1, 2"""


def corrections(t: Tables):
    lines = t["lineitem"].select("l_orderkey", "l_suppkey", "l_quantity", "l_returnflag")
    orders = t["orders"].filter("o_orderpriority = '1-URGENT'").select("o_orderkey", "o_orderdate")
    rows = t.dims(lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")), "supplier", "nation")
    kept = F.sum(F.when(F.col("l_returnflag") != "R", F.col("l_quantity")))
    return rows.groupBy(F.col("n_name").alias(KEY), F.col("o_orderdate").cast("date").alias(DAY)).agg(kept.alias(TARGET))


LATE_FIXES_SQL = f"SELECT f.* FROM ({FIXES_SQL}) f, span WHERE year(f.ds) = year(span.hi) - 1"
CORRECTED_SQL = ("SELECT p.unique_id, p.ds, coalesce(f.y, p.y) AS y FROM panel_nation p LEFT JOIN fixes f "
                 "ON f.unique_id = p.unique_id AND f.ds = p.ds")


@query("feature_backfill", sql(
    "SELECT * FROM m WHERE EXISTS (SELECT 1 FROM fixes f WHERE f.unique_id = m.unique_id AND f.ds BETWEEN m.ds - 56 "
    "AND m.ds - 7)", " ".join(RICH_SQL), fixes=FIXES_SQL, corrected=CORRECTED_SQL, m=rich_sql("corrected")))
def _(t):
    out = O.feature_backfill(t.panel("nation"), corrections(t), X.RICH)
    return tidy(out.withColumn("month", F.col("month").cast("double")))


@query("feature_backfill_table", sql(
    "SELECT * EXCLUDE (y), CAST(year(ds) AS INTEGER) AS year FROM m", " ".join(RICH_SQL), fixes=LATE_FIXES_SQL,
    corrected=CORRECTED_SQL, m=rich_sql("corrected")))
def _(t):
    """The feature table after a backfill that rewrites only the years it reaches."""
    path = fresh_path(t.spark, "features")
    panel = settle(t.panel("nation"), "panel")
    O.write_features(panel, X.RICH, path)
    O.backfill_features(panel, corrections(t).filter(F.year(DAY) == t.last.year - 1), X.RICH, path)
    return tidy(t.spark.read.parquet(path).withColumn("month", F.col("month").cast("double")))


@query("backfill_overwrite", sql(
    "SELECT unique_id, ds, coalesce(f.y, p.y) AS y, CAST(year(ds) AS INTEGER) AS year FROM panel_nation p LEFT JOIN "
    "fixes f USING (unique_id, ds)", fixes=LATE_FIXES_SQL))
def _(t):
    path = fresh_path(t.spark, "backfill")
    year = F.year(DAY).alias("year")
    panel = t.panel("nation").select(KEY, DAY, TARGET, year)
    panel.repartition("year", KEY).write.partitionBy("year").parquet(path)
    fixed = settle(corrections(t).filter(F.year(DAY) == t.last.year - 1), "corrections")
    years = [r[0] for r in fixed.select(F.year(DAY)).distinct().collect()]  # only these are read and written again
    fixed = fixed.select(KEY, DAY, F.col(TARGET).alias("_new"))
    out = panel.filter(F.col("year").isin(years)).join(fixed, [KEY, DAY], "left").select(KEY, DAY, F.coalesce("_new", TARGET).alias(TARGET), "year")
    writers.overwrite_partitions(out.repartition("year", KEY), path, ("year",))
    return t.spark.read.parquet(path)


def arrivals(t: Tables):
    """Order lines with the order's day and the day they were shipped and reported."""
    rows = t.dims(t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey")), "supplier", "nation")
    return rows.select("n_name", F.col("o_orderdate").cast("date").alias("day"),
                       F.col("l_shipdate").cast("date").alias("arrived"))


ARRIVALS_SQL = """SELECT n_name, CAST(o_orderdate AS DATE) AS day, CAST(l_shipdate AS DATE) AS arrived FROM lineitem JOIN
orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"""


@query("late_data_report", sql(
    "SELECT n_name AS unique_id, count(*) AS n_rows, count(*) FILTER (arrived - day > 30) AS n_late, CAST(max(arrived - "
    "day) AS BIGINT) AS max_delay_days, count(*) FILTER (arrived - day > 30) / count(*) AS late_share FROM arrivals "
    "GROUP BY 1", "late_share", arrivals=ARRIVALS_SQL))
def _(t):
    return tidy(O.late_data_report(arrivals(t), "n_name", "day", "arrived", 30))


@query("stale_lags", sql(
    "SELECT n_name AS unique_id, day + 28 AS ds, day AS lag_ds, count(*) AS n_missing FROM arrivals "
    "WHERE arrived - day > 28 GROUP BY n_name, day", arrivals=ARRIVALS_SQL))
def _(t):
    return O.stale_lags(arrivals(t), "n_name", "day", "arrived", 28)


# the last day whose end the watermark has passed closes the result
@query("stream_daily_panel", """SELECT event_type AS unique_id, CAST(ts AS DATE) AS ds, round(sum(value), 6) AS y FROM
events GROUP BY 1, 2 HAVING CAST(ts AS DATE) + 1 <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY""")
def _(t):
    schema = t["events"].schema
    out = daily.stream_daily_panel(t.spark, t.folder, "events.parquet", schema, F.col("event_type"), F.col("ts"),
                                   F.col("value"))
    return tidy(out)


def arriving(t: Tables) -> str:
    """The events as four files in order of arrival; some come with the last one, some once more."""
    folder = fresh_path(t.spark, "arriving")
    day = F.dayofmonth("ts")
    usual = F.when(day <= 8, 0).when(day <= 16, 1).when(day <= 24, 2).otherwise(3)
    place = F.when(F.col("event_id") % 97 == 0, 3).otherwise(usual)
    again = F.when((F.col("event_id") % 89 == 0), F.array(place, F.lit(3))).otherwise(F.array(place))
    rows = settle(t["events"].select("event_id", "ts", "event_type", "value", F.explode(again).alias("_file")), "events")
    for i in range(4):
        rows.filter(F.col("_file") == i).drop("_file").coalesce(1).write.mode("append").parquet(folder)
    return folder


@query("stream_late_rows", sql(
    "SELECT event_type AS unique_id, CAST(ts AS DATE) AS ds, late, sum(value) AS y, count(*) AS n FROM (SELECT *, (day(ts) > "
    "24 OR event_id % 97 = 0) AND ts < (SELECT max(ts) FROM events WHERE day(ts) <= 24 AND event_id % 97 <> 0) - INTERVAL 1 "
    "DAY AS late FROM events) x GROUP BY ALL", "y"))
def _(t):
    """A stream of four files, started twice; days and late rows together have every event once."""
    source = arriving(t)
    rows = t.spark.readStream.schema(t["events"].select("event_id", "ts", "event_type", "value").schema)
    rows = rows.option("maxFilesPerTrigger", 1).parquet(source)
    stream = rows.select(F.col("event_id").alias("id"), F.col("event_type").alias(KEY), "ts", "value")
    tables, state = DailyTables(fresh_path(t.spark, "daily")), fresh_path(t.spark, "stream-state")
    for _ in range(2):
        tables.run(stream, state)
    late = tables.late(t.spark).withColumn("late", F.lit(True))
    return tidy(tables.days(t.spark).withColumn("late", F.lit(False)).unionByName(late))


@query("segment_scores", sql(
    f"SELECT model, segment, {METRIC_SQL} FROM (SELECT *, split_part(unique_id, '_', 2) AS segment FROM "
    "forecasts_type_region) x GROUP BY 1, 2", "wMAPE Bias IntervalScore_80 Coverage_80"))
def _(t):
    series = t.raw("type_region").select(KEY).distinct()
    segments = series.withColumn("segment", F.split(KEY, "_")[1])
    return tidy(O.segment_scores(t.forecasts_on("type_region"), segments, ["segment"]))


ABC_SQL = """SELECT unique_id, total, cum / whole AS cum_share, CASE WHEN round(cum / whole, 9) <= 0.8 THEN 'A'
WHEN round(cum / whole, 9) <= 0.95 THEN 'B' ELSE 'C' END AS tier FROM (SELECT unique_id, sum(y) AS total,
sum(sum(y)) OVER (ORDER BY sum(y) DESC, unique_id ROWS UNBOUNDED PRECEDING) AS cum, sum(sum(y)) OVER () AS whole
FROM panel_supplier GROUP BY 1) x"""


@query("abc_tiers", sql(ABC_SQL, "cum_share"))
def _(t):
    return tidy(O.abc_tiers(t.panel("supplier")))


@query("stratified_sample", sql(
    "SELECT unique_id, n_name FROM (SELECT CAST(s_suppkey AS VARCHAR) AS unique_id, n_name FROM supplier JOIN nation ON "
    "s_nationkey = n_nationkey) x QUALIFY row_number() OVER (PARTITION BY n_name ORDER BY md5(unique_id || '|42'), "
    "unique_id) <= 3"))
def _(t):
    series = t["supplier"].join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey"))
    return O.stratified_sample(series.select(F.col("s_suppkey").cast("string").alias(KEY), "n_name"), "n_name", 3)


@query("batch_scoring_job")
def _(t):
    """Fit on all known days, forecast the 28 days after the last one, write by run date, read back."""
    panel = settle(t.panel("supplier"), "model-panel")
    return _scored(t, named(G.tweedie_glm(1.5)(panel, Folds.beyond(t.last)), "Tweedie", "ml"))


def _scored(t: Tables, rows):
    path = fresh_path(t.spark, "runs")
    ahead = O.stamp_run(rows.drop(TARGET), t.last)
    writers.write_table(ahead, path, "scoring", ("run_date",))
    return t.spark.read.parquet(path)


# the forecast blocks of the last cutoff, moved to the end of the panel
AHEAD_SQL = {
    "start": "SELECT p.unique_id, s.hi AS cutoff, p.ds, p.y FROM panel_nation p, span s WHERE p.ds > s.hi - 40",
    **{f"ahead{b}": (
        f"SELECT k.unique_id, k.cutoff, k.cutoff + h.h AS ds, 0.0::DOUBLE + sum(CASE WHEN k.ds = k.cutoff + h.h - 7 THEN "
        f"k.y ELSE 0 END) * 0.4::DOUBLE + sum(CASE WHEN k.ds = k.cutoff + h.h - 14 THEN k.y ELSE 0 END) * 0.2::DOUBLE "
        f"+ avg(k.y) * 0.35::DOUBLE AS y FROM {'start' if b == 0 else f'seen{b}'} k JOIN (SELECT CAST(h AS INTEGER) AS h "
        f"FROM range({7 * b + 1}, {7 * b + 8}) t(h)) h ON k.ds BETWEEN k.cutoff + h.h - 34 AND k.cutoff + h.h - 7 "
        f"GROUP BY 1, 2, 3") for b in range(4)},
    **{f"seen{b + 1}": f"SELECT * FROM {'start' if b == 0 else f'seen{b}'} UNION ALL SELECT * FROM ahead{b}"
       for b in range(4)},
}


@query("batch_scoring_ahead", sql(
    "SELECT unique_id, ds, 'LagBlend' AS model, greatest(y, 0.0) AS y_hat, NULL::DOUBLE AS lo_80, NULL::DOUBLE AS hi_80, "
    "cutoff, 'ml' AS stage, cutoff AS run_date FROM seen4 WHERE ds > cutoff", "y_hat", **AHEAD_SQL))
def _(t):
    """The same job with a fixed linear scorer."""
    rows = T.recursive_forecast(T.linear_scorer(BLEND), t.panel("nation"), Folds.beyond(t.last), BLEND_SPECS)
    return tidy(_scored(t, named(rows, "LagBlend", "ml")))


@query("batch_scoring_linear", sql(
    "SELECT unique_id, ds, y, model, y_hat, lo_80, hi_80, cutoff, stage, DATE '2001-08-02' AS run_date FROM "
    "forecasts_nation WHERE model = 'LagBlend'", "y_hat"))
def _(t):
    rows = T.recursive_forecast(T.linear_scorer(BLEND), t.panel("nation"), t.folds(), BLEND_SPECS)
    path = fresh_path(t.spark, "runs")
    writers.write_table(O.stamp_run(named(rows, "LagBlend", "ml"), date(2001, 8, 2)), path, "forecast", ("run_date",))
    return tidy(t.spark.read.parquet(path))


@query("freshness_monitor", """SELECT event_type AS dataset,
round((epoch(TIMESTAMP '2024-01-31 12:00:00') - floor(epoch(max(ts)))) / 3600, 6) AS age_hours,
(epoch(TIMESTAMP '2024-01-31 12:00:00') - floor(epoch(max(ts)))) / 3600 > 12.5 AS late FROM events GROUP BY 1""")
def _(t):
    runs = t["events"].select(F.col("event_type").alias("dataset"), F.col("ts").alias("run_ts"))
    out = O.freshness_monitor(runs, datetime(2024, 1, 31, 12), 12.5)
    return tidy(out.drop("last_run"))


@query("fallback_rows", sql(
    "SELECT t.unique_id, t.ds, coalesce(n.y_hat, s.y_hat) AS y_hat, n.y_hat IS NULL AND s.y_hat IS NOT NULL AS "
    "used_fallback FROM (SELECT DISTINCT unique_id, ds FROM tests_nation) t LEFT JOIN (SELECT * FROM naive_nation WHERE "
    "y_hat > 0) n ON n.unique_id = t.unique_id AND n.ds = t.ds LEFT JOIN snaive_nation s ON s.unique_id = t.unique_id "
    "AND s.ds = t.ds"))
def _(t):
    """The same policy row by row, between two tables of forecasts."""
    panel, folds = t.panel("nation"), t.folds()
    good = N.seasonal_naive(panel, folds)
    current = N.naive(panel, folds).filter(F.col("y_hat") > 0)
    return O.fallback_forecast(good.select(KEY, DAY).distinct(), current, good)


def served(t: Tables):
    """The runs of the last three days are stored, the newest one broken; what is served, and the table of events.

    The job of the second day runs twice, and so does the serving.
    """
    panel = settle(t.panel("nation"), "panel")
    runs = U.run_table(t.spark, fresh_path(t.spark, "runs"))
    events = U.event_table(t.spark, fresh_path(t.spark, "events"))
    for back in (2, 1, 1, 0):
        day = t.last - timedelta(days=back)
        rows = named(N.seasonal_naive(panel, Folds.beyond(day)), "SeasonalNaive", "baseline")
        if back == 0:
            rows = rows.withColumn("y_hat", F.when(F.col(KEY).contains("1"), F.col("y_hat") * 1000 + 1e6).otherwise(F.col("y_hat")))
        U.store_run(runs, rows, day)
    ahead = F.explode(F.sequence(F.lit(1), F.lit(28))).alias("h")
    expected = panel.select(KEY).distinct().select(KEY, ahead).select(KEY, F.date_add(F.lit(t.last), F.col("h")).alias(DAY))
    for _ in range(2):
        out = U.serve(runs, events, expected, U.largest_known(panel), t.last)
    return out, events


@query("fallback_forecast", sql(
    "SELECT s.hi AS as_of, k.unique_id, s.hi + h.h AS ds, n.y AS y_hat, s.hi - 1 AS run_date, true AS used_fallback "
    "FROM (SELECT DISTINCT unique_id FROM panel_nation) k CROSS JOIN span s CROSS JOIN (SELECT CAST(h AS INTEGER) AS h "
    "FROM range(1, 29) t(h)) h LEFT JOIN panel_nation n ON n.unique_id = k.unique_id AND h.h < 28 AND n.ds = s.hi - 7 + h.h "
    "% 7"))
def _(t):
    """Without its newest run, the run of the day before has 27 of the 28 days."""
    return served(t)[0]


@query("fallback_events", sql(
    "SELECT s.hi AS as_of, s.hi AS wanted_run, s.hi - 1 AS served_run, (SELECT 28 * count(DISTINCT unique_id) FROM "
    "panel_nation WHERE unique_id LIKE '%1%') AS n_bad, CAST(0 AS BIGINT) AS n_missing, CAST(s.hi AS VARCHAR) AS batch FROM span s"))
def _(t):
    return served(t)[1].read()


@query("input_drift", sql("""SELECT unique_id, avg(y) FILTER (ds > hi - 28) AS recent_mean, avg(y) FILTER (ds <= hi - 28)
AS prior_mean, stddev_samp(y) FILTER (ds <= hi - 28) AS prior_std, (avg(y) FILTER (ds > hi - 28) - avg(y) FILTER (ds <= hi
- 28)) / nullif(stddev_samp(y) FILTER (ds <= hi - 28), 0) AS z_score, coalesce(abs((avg(y) FILTER (ds > hi - 28) - avg(y)
FILTER (ds <= hi - 28)) / nullif(stddev_samp(y) FILTER (ds <= hi - 28), 0)) > 0.1, false) AS drifted FROM panel_supplier,
span GROUP BY 1""", "recent_mean prior_mean prior_std z_score"))
def _(t):
    return tidy(O.input_drift(t.panel("supplier"), limit=0.1, last=t.last))


@query("prediction_sanity", sql("""SELECT f.unique_id, f.model, f.max_y_hat, f.n_zero, h.max_y, h.recent_mean,
f.max_y_hat > 0.5 * h.max_y AS too_large, f.n_zero > 0 AND h.recent_mean > 0 AS zero_but_selling FROM (SELECT unique_id,
model, max(y_hat) AS max_y_hat, count(*) FILTER (y_hat = 0) AS n_zero FROM forecasts_nation GROUP BY 1, 2) f JOIN (SELECT
unique_id, max(y) AS max_y, avg(y) FILTER (ds > c - 28) AS recent_mean FROM panel_nation, (SELECT min(cutoff) AS c FROM
cutoffs) m WHERE ds <= c GROUP BY 1) h ON h.unique_id = f.unique_id""", "max_y_hat recent_mean"))
def _(t):
    return tidy(O.prediction_sanity(t.forecasts, t.panel("nation"), factor=0.5))


@query("rolling_accuracy", sql("""SELECT *, coalesce(change > 0.05, false) AS retrain FROM (SELECT model, week, "wMAPE",
"wMAPE" - lag("wMAPE") OVER (PARTITION BY model ORDER BY week) AS change FROM (SELECT model, CAST(date_trunc('week', ds) AS
DATE) AS week, sum(abs(y - y_hat)) / nullif(sum(abs(y)), 0) AS "wMAPE" FROM forecasts_nation GROUP BY 1, 2) x) z""",
                               "wMAPE change"))
def _(t):
    return tidy(O.rolling_accuracy(t.forecasts))


@query("coverage_drift", sql("""SELECT model, week, coverage, mean_width, coverage - lag(coverage) OVER (PARTITION BY model
ORDER BY week) AS change FROM (SELECT model, CAST(date_trunc('week', ds) AS DATE) AS week, avg(CASE WHEN y >= lo_80 AND y
<= hi_80 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS coverage, avg(hi_80 - lo_80) AS mean_width FROM forecasts_nation GROUP
BY 1, 2) x""", "coverage mean_width change"))
def _(t):
    return tidy(O.coverage_drift(t.forecasts))
