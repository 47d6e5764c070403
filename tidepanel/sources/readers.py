"""Reading raw sales files and registered tables."""

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepanel.config import DAY
from tidepanel.contracts import enforce, validate

# Id columns of a wide sales file.
SALES_IDS = ("id", "item_id", "dept_id", "cat_id", "store_id", "state_id")
DAY_PREFIX = "d_"


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        return bool(spark.read.text(path).schema)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def _need(spark: SparkSession, path: str) -> str:
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    return path


def read_wide_sales(spark: SparkSession, path: str) -> DataFrame:
    """Wide sales CSV: ids as strings, day columns (found by prefix in the header) as ints."""
    header = spark.read.option("header", True).csv(_need(spark, path)).columns
    schema = T.StructType(
        [T.StructField(c, T.IntegerType() if c.startswith(DAY_PREFIX) else T.StringType()) for c in header]
    )
    return spark.read.schema(schema).option("header", True).csv(path)


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("header", True).csv(_need(spark, path))
    return raw.select("d", F.col("date").cast("date").alias(DAY))


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).csv(_need(spark, path))


def read_raw(spark: SparkSession, folder: str, sales: str = "sales.csv", calendar: str = "calendar.csv",
             prices: str = "prices.csv") -> dict[str, DataFrame]:
    """The raw tables by name; a missing file raises FileNotFoundError naming it."""
    return {
        "sales": read_wide_sales(spark, f"{folder}/{sales}"),
        "calendar": read_calendar(spark, f"{folder}/{calendar}"),
        "prices": read_prices(spark, f"{folder}/{prices}"),
    }


@dataclass(frozen=True)
class Dataset:
    path: str
    contract: str | None = None
    schema: str | None = None  # DDL; needed for csv and json so that no inference pass runs
    day: str | None = None  # column that dates a row, for the status table

    @property
    def format(self) -> str:
        suffix = self.path.rstrip("/").rsplit(".", 1)[-1]
        if suffix not in ("parquet", "csv", "json"):
            raise ValueError(f"no reader for {self.path!r}")
        return suffix


Registry = dict[str, Dataset]


def _open(spark: SparkSession, entry: Dataset) -> DataFrame:
    reader = spark.read
    if entry.schema:
        reader = reader.schema(entry.schema)
    if entry.format == "csv":
        reader = reader.option("header", True)
    return reader.format(entry.format).load(entry.path)


def load_dataset(spark: SparkSession, registry: Registry, name: str, eager: bool = False) -> DataFrame:
    """Read a registered table with the reader its suffix asks for, and check its contract.

    Missing columns fail at once. Values are checked as they are read, or with ``eager`` in a pass of their own.
    """
    if name not in registry:
        raise KeyError(f"{name!r} is not registered; known: {sorted(registry)}")
    entry = registry[name]
    fmt = entry.format
    _need(spark, entry.path)
    df = _open(spark, entry)
    if entry.contract is None:
        return df
    return (validate if eager else enforce)(df, entry.contract, f"{name} ({fmt})")


def dataset_status(spark: SparkSession, registry: Registry) -> DataFrame:
    """One row per registered name: present or not, rows, newest day."""
    parts = []
    for name, entry in sorted(registry.items()):
        label = F.lit(name).alias("dataset")
        if path_exists(spark, entry.path):
            newest = F.max(F.col(entry.day).cast("date")) if entry.day else F.lit(None).cast("date")
            part = _open(spark, entry).agg(F.count(F.lit(1)).alias("n_rows"), newest.alias("max_day"))
            part = part.select(label, F.lit(True).alias("present"), "n_rows", "max_day")
        else:
            part = spark.range(1).select(label, F.lit(False).alias("present"), F.lit(None).cast("long").alias("n_rows"),
                                         F.lit(None).cast("date").alias("max_day"))
        parts.append(part)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
