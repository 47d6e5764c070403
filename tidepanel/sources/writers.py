"""Writing tables."""

from pyspark.sql import DataFrame

from tidepanel.config import DAY, KEY
from tidepanel.contracts import enforce


def write_table(df: DataFrame, path: str, contract: str | None = None, partition_by: tuple[str, ...] = (),
                mode: str = "overwrite") -> None:
    """Parquet; a row that breaks the named contract fails the job, which then publishes nothing."""
    checked = enforce(df, contract, path) if contract else df
    checked.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_panel(panel: DataFrame, path: str) -> None:
    """A panel with each series' rows together and in day order, so readers can skip row groups by key."""
    ready = enforce(panel, "panel", path).repartitionByRange(KEY, DAY).sortWithinPartitions(KEY, DAY)
    ready.write.mode("overwrite").parquet(path)


def write_leaderboard(board: DataFrame, path: str) -> None:
    """One CSV file; a leaderboard has one row per model."""
    board.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def append_partitions(df: DataFrame, path: str, contract: str, partition_by: tuple[str, ...]) -> None:
    """Add new rows to a partitioned table, checking them on the way.

    The rows are shuffled by partition value and day, so one busy partition value is written by many tasks.
    """
    ready = enforce(df, contract, path).repartition(*partition_by, DAY)
    ready.write.mode("append").partitionBy(*partition_by).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: tuple[str, ...]) -> None:
    """Replace only the partitions that ``df`` has rows for."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)
