"""The panels that the registered queries run on, as Spark plans and as SQL, and the register itself."""

import re
from dataclasses import dataclass
from datetime import date
from functools import cached_property
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepanel.config import DAY, KEY, TARGET
from tidepanel.operators import panel as P
from tidepanel.operators.evaluate import named, union_forecasts
from tidepanel.operators.features import Lag, Rolling
from tidepanel.operators.folds import Folds, SparsePanel
from tidepanel.operators.forecast import naive_gaussian, seasonal_naive_gaussian
from tidepanel.operators.trained import linear_scorer, recursive_forecast

# the lags and weights of a fixed linear forecaster, for which SQL can give the same numbers
BLEND_SPECS = [Lag(7), Lag(14), Rolling("mean", 7, 28)]
BLEND = {"lag7": 0.4, "lag14": 0.2, "mean_l7_w28": 0.35}

FILLED_ROWS = 1_000_000  # rows of a filled panel in a task, on average

SERIES_SQL = {
    "type": ("p_type", "JOIN part ON l_partkey = p_partkey"),
    "nation": ("n_name", "JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"),
    "supplier": ("CAST(l_suppkey AS VARCHAR)", ""),
    "segment": ("c_mktsegment", "JOIN customer ON o_custkey = c_custkey"),
    "type_region": (
        "p_type || '_' || r_name",
        "JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey "
        "JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
    ),
}


_schemas: dict[str, T.StructType] = {}  # read from the files once


class Tables:
    """The given tables of one scale, and the panels built from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getitem__(self, name: str) -> DataFrame:
        path = self.path(name)
        if path not in _schemas:
            _schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_schemas[path]).parquet(path)

    def sales(self) -> DataFrame:
        orders = self["orders"].select("o_orderkey", "o_custkey", "o_orderdate")
        lines = self["lineitem"].select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))

    def dims(self, rows: DataFrame, *names: str) -> DataFrame:
        """Attach dimension tables; Spark broadcasts those whose files are small."""
        on = {
            "part": ("l_partkey", "p_partkey", ["p_partkey", "p_type", "p_brand"]),
            "supplier": ("l_suppkey", "s_suppkey", ["s_suppkey", "s_nationkey"]),
            "nation": ("s_nationkey", "n_nationkey", ["n_nationkey", "n_name", "n_regionkey"]),
            "region": ("n_regionkey", "r_regionkey", ["r_regionkey", "r_name"]),
            "customer": ("o_custkey", "c_custkey", ["c_custkey", "c_mktsegment"]),
        }
        for name in names:
            left, right, columns = on[name]
            rows = rows.join(self[name].select(*columns), F.col(left) == F.col(right))
        return rows

    def raw(self, kind: str) -> DataFrame:
        """The daily panel with its gaps."""
        keys: dict[str, tuple[Column, tuple[str, ...]]] = {
            "type": (F.col("p_type"), ("part",)),
            "nation": (F.col("n_name"), ("supplier", "nation")),
            "supplier": (F.col("l_suppkey").cast("string"), ()),
            "segment": (F.col("c_mktsegment"), ("customer",)),
            "type_region": (
                F.concat_ws("_", "p_type", "r_name"), ("part", "supplier", "nation", "region")
            ),
        }
        key, dims = keys[kind]
        return P.panel_daily(self.dims(self.sales(), *dims), key, F.col("o_orderdate"), F.col("l_quantity"))

    @cached_property
    def span(self) -> tuple[date, date]:
        return P.day_span(self["orders"].select(F.col("o_orderdate").cast("date").alias(DAY)))

    @property
    def last(self) -> date:
        return self.span[1]

    def panel(self, kind: str) -> DataFrame:
        """The panel without gaps: every day of the orders' date range, 0 where nothing was sold.

        Filled, a series is much larger than the rows that are shuffled, so the engine, which looks at these, would
        join far too much of the panel in a task. Series are dealt out by the days that they will have instead.
        """
        raw = self.raw(kind)
        if kind == "supplier":  # the other kinds have a bounded number of series
            days = (self.span[1] - self.span[0]).days + 1
            tasks = -(-self["supplier"].count() * days // FILLED_ROWS)
            raw = raw.repartition(tasks, KEY) if tasks > 1 else raw
        return P.zero_fill(P.fill_gaps(raw, "global", "global", self.span))

    def sparse(self, kind: str) -> SparsePanel:
        """The same panel, of which only the days that are asked for are filled."""
        raw = self.raw(kind)
        return SparsePanel(raw, raw.select(KEY).distinct(), self.span)

    def folds(self, **settings) -> Folds:
        return Folds(self.last, **settings)

    @cached_property
    def forecasts(self) -> DataFrame:
        """Three models on the nation panel: two baselines with intervals and one without."""
        return self.forecasts_on("nation")

    def forecasts_on(self, kind: str) -> DataFrame:
        panel, folds = self.panel(kind), self.folds()
        blend = recursive_forecast(linear_scorer(BLEND), panel, folds, BLEND_SPECS)
        return union_forecasts(
            named(naive_gaussian(panel, folds), "Naive", "baseline"),
            named(seasonal_naive_gaussian(panel, folds), "SeasonalNaive", "baseline"),
            named(blend, "LagBlend", "ml"),
        )


# ---------------------------------------------------------------------------------------------------------
# the same panels in SQL; a part may mention others by name
PARTS: dict[str, str] = {
    "span": "SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders",
    "days": "SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS ds FROM span",
    "cutoffs": (
        "SELECT CAST(i AS INTEGER) AS fold, hi - CAST((3 - i) * 28 AS INTEGER) AS cutoff "
        "FROM span, range(3) t(i)"
    ),
}


def _panel_parts(kind: str) -> None:
    key, joins = SERIES_SQL[kind]
    PARTS[f"raw_{kind}"] = (
        f"SELECT {key} AS unique_id, CAST(o_orderdate AS DATE) AS ds, CAST(sum(l_quantity) AS DOUBLE) AS y "
        f"FROM lineitem JOIN orders ON l_orderkey = o_orderkey {joins} GROUP BY 1, 2")
    PARTS[f"panel_{kind}"] = (
        f"SELECT k.unique_id, d.ds, coalesce(r.y, 0.0) AS y FROM (SELECT DISTINCT unique_id FROM raw_{kind}) k "
        f"CROSS JOIN days d LEFT JOIN raw_{kind} r ON r.unique_id = k.unique_id AND r.ds = d.ds")
    PARTS[f"tests_{kind}"] = (
        f"SELECT p.unique_id, p.ds, c.cutoff, CAST(p.ds - c.cutoff AS INTEGER) AS h, p.y FROM panel_{kind} p "
        f"JOIN cutoffs c ON p.ds > c.cutoff AND p.ds <= c.cutoff + 28")
    PARTS[f"naive_{kind}"] = (
        f"SELECT t.*, n.y AS y_hat FROM tests_{kind} t JOIN panel_{kind} n "
        f"ON n.unique_id = t.unique_id AND n.ds = t.cutoff")
    PARTS[f"snaive_{kind}"] = (
        f"SELECT t.*, n.y AS y_hat FROM tests_{kind} t JOIN panel_{kind} n "
        f"ON n.unique_id = t.unique_id AND n.ds = t.cutoff - 6 + (t.h - 1) % 7")
    for name, lag in (("naive", 1), ("snaive", 7)):
        growth = "sqrt(t.h)" if lag == 1 else "sqrt(floor((t.h - 1) / 7) + 1)"
        PARTS[f"sigma_{name}_{kind}"] = (
            f"SELECT e.unique_id, c.cutoff, sqrt(avg(e.e * e.e)) AS sigma FROM (SELECT unique_id, ds, "
            f"y - lag(y, {lag}) OVER (PARTITION BY unique_id ORDER BY ds) AS e FROM panel_{kind}) e "
            f"JOIN cutoffs c ON e.ds <= c.cutoff GROUP BY 1, 2")
        PARTS[f"{name}_band_{kind}"] = (
            f"SELECT t.*, y_hat - 1.2815515655446004::DOUBLE * sigma * {growth} AS lo_80, "
            f"y_hat + 1.2815515655446004::DOUBLE * sigma * {growth} AS hi_80 FROM {name}_{kind} t "
            f"JOIN sigma_{name}_{kind} s ON s.unique_id = t.unique_id AND s.cutoff = t.cutoff")
    # four blocks of seven steps, each on the values known or forecast before it
    PARTS[f"known0_{kind}"] = (
        f"SELECT p.unique_id, c.cutoff, p.ds, p.y FROM panel_{kind} p JOIN cutoffs c "
        f"ON p.ds <= c.cutoff AND p.ds > c.cutoff - 40")
    for b in range(4):
        PARTS[f"block{b}_{kind}"] = (
            f"SELECT k.unique_id, k.cutoff, k.cutoff + h.h AS ds, "
            f"0.0::DOUBLE + sum(CASE WHEN k.ds = k.cutoff + h.h - 7 THEN k.y ELSE 0 END) * 0.4::DOUBLE "
            f"+ sum(CASE WHEN k.ds = k.cutoff + h.h - 14 THEN k.y ELSE 0 END) * 0.2::DOUBLE "
            f"+ avg(k.y) * 0.35::DOUBLE AS y FROM known{b}_{kind} k "
            f"JOIN (SELECT CAST(h AS INTEGER) AS h FROM range({7 * b + 1}, {7 * b + 8}) t(h)) h "
            f"ON k.ds BETWEEN k.cutoff + h.h - 34 AND k.cutoff + h.h - 7 GROUP BY 1, 2, 3")
        PARTS[f"known{b + 1}_{kind}"] = (
            f"SELECT * FROM known{b}_{kind} UNION ALL SELECT * FROM block{b}_{kind}")
    PARTS[f"blend_{kind}"] = (
        f"SELECT t.*, k.y AS y_hat FROM tests_{kind} t JOIN known4_{kind} k "
        f"ON k.unique_id = t.unique_id AND k.cutoff = t.cutoff AND k.ds = t.ds")
    floor = "greatest(y_hat, 0.0) AS y_hat, greatest(lo_80, 0.0) AS lo_80, greatest(hi_80, 0.0) AS hi_80"
    PARTS[f"forecasts_{kind}"] = (
        f"SELECT unique_id, ds, y, 'Naive' AS model, {floor}, cutoff, 'baseline' AS stage FROM naive_band_{kind} "
        f"UNION ALL SELECT unique_id, ds, y, 'SeasonalNaive', {floor}, cutoff, 'baseline' FROM snaive_band_{kind} "
        f"UNION ALL SELECT unique_id, ds, y, 'LagBlend', greatest(y_hat, 0.0), NULL::DOUBLE, NULL::DOUBLE, cutoff, "
        f"'ml' FROM blend_{kind}")
    PARTS[f"wide_scores_{kind}"] = (
        f"SELECT model, min(stage) AS stage, {METRIC_SQL} FROM forecasts_{kind} GROUP BY model")
    PARTS[f"scores_{kind}"] = " UNION ALL ".join(
        f"SELECT model, '{m}' AS metric, \"{m}\" AS score, stage, 'pooled_all_windows' AS aggregation_scope, "
        f"'{kind}' AS subset_name FROM wide_scores_{kind}"
        for m in ("wMAPE", "Bias", "IntervalScore_80", "Coverage_80"))
    PARTS[f"board_{kind}"] = (
        f"SELECT model, stage, '{kind}' AS subset_name, \"wMAPE\", \"Bias\", \"IntervalScore_80\", \"Coverage_80\" "
        f"FROM wide_scores_{kind}")


WINKLER_SQL = ("(hi_80 - lo_80) + 2 / (1 - 0.8::DOUBLE) * greatest(lo_80 - y, 0.0) "
               "+ 2 / (1 - 0.8::DOUBLE) * greatest(y - hi_80, 0.0)")
METRIC_SQL = (
    'sum(abs(y - y_hat)) / nullif(sum(abs(y)), 0) AS "wMAPE", sum(y_hat - y) / nullif(sum(y), 0) AS "Bias", '
    f"CASE WHEN count(lo_80) = count(*) AND count(hi_80) = count(*) THEN avg({WINKLER_SQL}) END "
    'AS "IntervalScore_80", '
    'avg(CASE WHEN y >= lo_80 AND y <= hi_80 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS "Coverage_80"'
)
for _kind in SERIES_SQL:
    _panel_parts(_kind)


def sql(body: str, doubles: str = "", **parts: str) -> str:
    """``body`` with the parts it mentions as CTEs, and the named columns rounded as the Spark side is.

    Extra keyword arguments are further CTEs.
    """
    known = {**PARTS, **parts}
    placed: dict[str, str] = {}
    opened: set[str] = set()  # a recursive part mentions itself

    def place(text: str) -> None:
        for name in known:
            if name not in opened and _mentions(text, name):
                opened.add(name)
                place(known[name])
                placed[name] = known[name]

    place(body)
    head = ", ".join(f"{n} AS ({t})" for n, t in placed.items())
    if doubles:
        rounded = ", ".join(f'round("{c}", 6) + 0.0 AS "{c}"' for c in doubles.split())
        body = f"SELECT * REPLACE ({rounded}) FROM ({body})"
    return f"WITH {head} {body}" if head else body


def _mentions(text: str, name: str) -> bool:
    return re.search(rf"(?<![\w.]){name}(?!\w)", text) is not None


# ---------------------------------------------------------------------------------------------------------
@dataclass(frozen=True)
class Query:
    run: Callable[[Tables], DataFrame]
    sql: str | None


REGISTER: dict[str, Query] = {}


def query(name: str, oracle: str | None = None):
    def add(run: Callable[[Tables], DataFrame]):
        REGISTER[name] = Query(run, oracle)
        return run

    return add


def tidy(df: DataFrame) -> DataFrame:
    """Doubles rounded to 6 digits, since engines add in different orders."""
    return df.select(*[
        F.round(F.col(f"`{f.name}`"), 6).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
        for f in df.schema
    ])


__all__ = ["BLEND", "BLEND_SPECS", "DAY", "KEY", "METRIC_SQL", "PARTS", "Query", "REGISTER", "TARGET", "Tables",
           "WINKLER_SQL", "query", "sql", "tidy"]
