"""Daily features from a stored state: a day needs the state of the day before and its own rows, no history."""

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.config import DAY, KEY, TARGET
from tidepanel.operators.features import Calendar, Spec, reach
from tidepanel.sources.writers import overwrite_partitions

STATE = f"{KEY} string, past array<double>, n_days long, total double, state_date date"


def _unknown(n: int):
    return F.array_repeat(F.lit(None).cast("double"), n)


def state_of(panel: DataFrame, day: date, size: int) -> DataFrame:
    """The state of all series after ``day``, from their whole history: for the first day of a table.

    ``past`` has the values of the last ``size`` days, oldest first, unknown ones NULL; n_days and total count and add
    all known values up to the day. A series without rows yet is absent.
    """
    known = panel.filter(F.col(DAY) <= F.lit(day))
    at = F.datediff(DAY, F.lit(day)) + size  # 1 to size within the last days
    cell = F.when(at >= 1, F.struct(at.alias("at"), F.col(TARGET).alias("v")))
    packed = known.groupBy(KEY).agg(
        F.map_from_entries(F.collect_list(cell)).alias("_m"), F.count(TARGET).alias("n_days"),
        F.coalesce(F.sum(TARGET), F.lit(0.0)).alias("total"),
    )
    past = F.transform(F.sequence(F.lit(1), F.lit(size)), lambda i: F.try_element_at("_m", i))
    return packed.select(KEY, past.alias("past"), "n_days", "total", F.lit(day).alias("state_date"))


def advanced(state: DataFrame, rows: DataFrame, day: date, size: int) -> DataFrame:
    """The state after ``day`` from the one before it and the day's rows (unique_id, y).

    A series without a row that day gets an unknown value, a new one begins with this day.
    """
    now = rows.select(KEY, F.col(TARGET).alias("_y"))
    both = state.join(now, KEY, "full")
    longer = F.concat(F.coalesce("past", _unknown(size)), F.array("_y"))
    return both.select(
        KEY, F.slice(longer, 2, size).alias("past"),
        (F.coalesce("n_days", F.lit(0).cast("long")) + F.col("_y").isNotNull().cast("long")).alias("n_days"),
        (F.coalesce("total", F.lit(0.0)) + F.coalesce("_y", F.lit(0.0))).alias("total"), F.lit(day).alias("state_date"),
    )


def day_features(state: DataFrame, rows: DataFrame, specs: list[Spec], day: date) -> DataFrame:
    """(unique_id, ds, y, features…, snapshot_date) of the day's rows, from the state before the day."""
    size = reach(specs)
    both = rows.select(KEY, TARGET).join(state.select(KEY, "past"), KEY, "left")
    both = both.withColumn("past", F.coalesce("past", _unknown(size)))
    at = F.lit(day)
    features = [
        (s.of(at) if isinstance(s, Calendar) else s.at(F.col("past"), F.lit(0))).alias(s.name) for s in specs
    ]
    return both.select(KEY, at.alias(DAY), TARGET, *features, at.alias("snapshot_date"))


class FeatureTable:
    """Features by day below ``path``/features and states by day below ``path``/states."""

    def __init__(self, spark: SparkSession, path: str, specs: list[Spec]):
        self.spark, self.path, self.specs, self.size = spark, path, specs, reach(specs)

    def begin(self, panel: DataFrame, day: date) -> None:
        """The state after ``day`` from the history."""
        overwrite_partitions(state_of(panel, day, self.size), f"{self.path}/states", ("state_date",))

    def state(self, day: date) -> DataFrame:
        return self.spark.read.schema(STATE).parquet(f"{self.path}/states").filter(F.col("state_date") == F.lit(day))

    def add(self, panel: DataFrame, day: date) -> None:
        """The features and the state of ``day``; each replaces its partition, so a repeated run changes nothing.

        Reads one partition of states and one day of ``panel``.
        """
        before, rows = self.state(day - timedelta(days=1)).drop("state_date"), panel.filter(F.col(DAY) == F.lit(day))
        features = day_features(before, rows, self.specs, day)
        overwrite_partitions(features, f"{self.path}/features", ("snapshot_date",))
        overwrite_partitions(advanced(before, rows, day, self.size), f"{self.path}/states", ("state_date",))

    def features(self, day: date) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/features").filter(F.col("snapshot_date") == F.lit(day))
