"""Tables that grow by named batches. A batch is there whole or not at all, and at most once."""

import uuid
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.config import DAY
from tidepanel.contracts import enforce
from tidepanel.sources.readers import path_exists

LOG = "batch string, attempt string, n_rows long, committed timestamp"


@dataclass(frozen=True)
class BatchTable:
    """Rows are staged below ``path``/data in a folder of their own; a row of the log ``path``/commits makes them part
    of the table, and readers open only folders that the log names.

    So a run that stops between stage and commit changes nothing, and one that is repeated finds its batch in the
    log. If two runs commit the same batch at once, readers follow the first of the two. The driver holds the names
    of the batches, a row each.

    ``schema`` is the DDL of the rows, ``partition_by`` columns of it.
    """

    spark: SparkSession
    path: str
    schema: str
    partition_by: tuple[str, ...] = ()
    contract: str | None = None

    def _folder(self, batch: str, attempt: str) -> str:
        return f"{self.path}/data/batch={quote(batch, safe='')}/attempt={attempt}"

    def commits(self) -> DataFrame:
        """(batch, attempt, n_rows, committed) of the batches that are part of the table."""
        if not path_exists(self.spark, f"{self.path}/commits"):
            return self.spark.createDataFrame([], LOG)
        log = self.spark.read.schema(LOG).parquet(f"{self.path}/commits")
        first = F.min(F.struct("committed", "attempt", "n_rows")).alias("f")
        return log.groupBy("batch").agg(first).select("batch", "f.attempt", "f.n_rows", "f.committed")

    def stage(self, rows: DataFrame, batch: str) -> str:
        """Write the rows where no reader looks, checking the contract on the way; returns the attempt's name."""
        attempt = uuid.uuid4().hex
        names = [f.name for f in self.spark.createDataFrame([], self.schema).schema]
        ready = rows.select(*names)
        if self.contract:
            ready = enforce(ready, self.contract, self.path)
        # dealt out by day too, so that one busy partition value is written by many tasks
        by = [*self.partition_by, *([DAY] if DAY in names else [])]
        ready = ready.repartition(*by) if by else ready
        ready.write.partitionBy(*self.partition_by).parquet(self._folder(batch, attempt))
        return attempt

    def commit(self, batch: str, attempt: str) -> None:
        """One row of the log, which Spark publishes by moving one file."""
        staged = self.spark.read.schema(self.schema).parquet(self._folder(batch, attempt))
        row = staged.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(batch).alias("batch"), F.lit(attempt).alias("attempt"), "n_rows",
            F.current_timestamp().alias("committed"),
        )
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/commits")

    def append(self, rows: DataFrame, batch: str) -> bool:
        """Stage and commit, unless the batch is in the table already; says whether it was added."""
        if not self.commits().filter(F.col("batch") == batch).isEmpty():
            return False
        self.commit(batch, self.stage(rows, batch))
        return True

    def read(self, *batches: str) -> DataFrame:
        """The rows of all batches, or of those named, with the column batch."""
        log = self.commits()
        if batches:
            log = log.filter(F.col("batch").isin(list(batches)))
        folders = [self._folder(r["batch"], r["attempt"]) for r in log.orderBy("batch").collect()]
        schema = f"{self.schema}, batch string"
        if not folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/data")
        return reader.parquet(*folders).drop("attempt")
