"""Sessions and the shared folder that intermediate tables are written to."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_local_root: str | None = None
_settled: list[tuple[str, StructType]] = []  # what scratch() may empty


def local_session(cores: str | int = "*", app: str = "tidepanel", **extra: str) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # small inputs keep all cores busy; a cluster leaves this at its default
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64kb")
    )
    for name, value in extra.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir.

    Only a local session may go without one, because every task then sees the same disk.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="tidepanel-")
    return _local_root


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str = "settled") -> DataFrame:
    """Write ``df`` once as a parquet table and read it back.

    For results that several later jobs read. The files outlive a lost executor, so nothing upstream is
    computed twice and the lineage ends here.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    _settled.append((path, df.schema))
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Empties the tables that were settled inside the block when it ends, also after an error.

    Write or collect what is needed of the results inside it: they read these tables.
    """
    begin = len(_settled)
    try:
        yield
    finally:
        for path, schema in _settled[begin:]:
            spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
        del _settled[begin:]
