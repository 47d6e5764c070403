"""The daily panel as a stream that keeps late rows: sums by day are merged, what comes behind the mark is set aside."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.config import DAY, KEY, TARGET
from tidepanel.session import settle
from tidepanel.sources.batches import BatchTable

CELL = f"{KEY} string, {DAY} date, {TARGET} double, n long"


@dataclass(frozen=True)
class DailyTables:
    """Four tables below ``path`` that each micro-batch of a stream adds one batch to.

    ``totals`` has sums and counts by series and day of rows on time, ``late`` those of rows behind the mark, ``seen``
    the ids by day, and ``marks`` the largest event time. Sums are merged when they are read, so a micro-batch writes
    its own days only. A batch carries the number of the micro-batch: one that is repeated after a restart, also after
    it stopped between two tables, finds what is there and adds the rest.
    """

    path: str
    delay: str = "1 day"

    def _table(self, spark: SparkSession, name: str) -> BatchTable:
        schema = {"totals": CELL, "late": CELL, "seen": f"id long, {DAY} date", "marks": "high timestamp"}[name]
        return BatchTable(spark, f"{self.path}/{name}", schema, (DAY,) if name == "seen" else ())

    def take(self, rows: DataFrame, number: int) -> None:
        """A micro-batch (id, unique_id, ts, value). Rows whose id was there before, in it or in an earlier one of the
        same day, are left out. The mark is the largest time of the earlier micro-batches less the delay."""
        spark, name = rows.sparkSession, f"{number:012d}"
        tables = {n: self._table(spark, n) for n in ("totals", "late", "seen", "marks")}
        if not tables["marks"].commits().filter(F.col("batch") == name).isEmpty():
            return
        fresh = rows.dropDuplicates(["id"]).withColumn(DAY, F.col("ts").cast("date"))
        fresh = settle(fresh, "micro-batch")
        first, last = fresh.agg(F.min(DAY), F.max(DAY)).first()
        if first is None:
            tables["marks"].append(spark.createDataFrame([], "high timestamp"), name)
            return
        # only the ids of these days are read; those of this micro-batch may be there from a run that stopped
        before = tables["seen"].read().filter(F.col(DAY).between(F.lit(first), F.lit(last)) & (F.col("batch") < name))
        fresh = fresh.join(before.select("id", DAY), ["id", DAY], "left_anti")
        high = tables["marks"].read().filter(F.col("batch") < name).agg(F.max("high").alias("h")).scalar()
        late = F.coalesce(F.col("ts").cast("timestamp") < high - F.expr(f"INTERVAL {self.delay}"), F.lit(False))
        fresh = settle(fresh.withColumn("_late", late), "fresh")

        def cells(own: DataFrame) -> DataFrame:
            return own.groupBy(KEY, DAY).agg(F.sum("value").alias(TARGET), F.count(F.lit(1)).alias("n"))

        tables["totals"].append(cells(fresh.filter(~F.col("_late"))), name)
        tables["late"].append(cells(fresh.filter("_late")), name)
        tables["seen"].append(fresh.select("id", DAY), name)
        # last: it closes the micro-batch
        tables["marks"].append(settle(fresh.agg(F.max(F.col("ts").cast("timestamp")).alias("high")), "mark"), name)

    def run(self, stream: DataFrame, checkpoint: str) -> None:
        """Take all files that are there and stop. A restart goes on after the last micro-batch."""
        query = (
            stream.writeStream.foreachBatch(lambda rows, number: self.take(rows, number))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        if query.exception():
            raise query.exception()

    def _merged(self, spark: SparkSession, name: str) -> DataFrame:
        cells = self._table(spark, name).read()
        return cells.groupBy(KEY, DAY).agg(F.sum(TARGET).alias(TARGET), F.sum("n").alias("n"))

    def days(self, spark: SparkSession) -> DataFrame:
        """(unique_id, ds, y, n) of the rows on time."""
        return self._merged(spark, "totals")

    def late(self, spark: SparkSession) -> DataFrame:
        """(unique_id, ds, y, n) of the rows behind the mark, which a correction of the panel can add."""
        return self._merged(spark, "late")
