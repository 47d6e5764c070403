"""The daily panel as a stream."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.config import DAY, KEY, TARGET
from tidepanel.session import fresh_path


def read_stream(spark: SparkSession, folder: str, schema, pattern: str) -> DataFrame:
    """Parquet files of a folder as a stream; ``pattern`` picks them when tables share the folder."""
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)


def daily_totals(events: DataFrame, key: Column, ts: Column, value: Column, delay: str = "1 day") -> DataFrame:
    """Sum per series and day; a day is final once the watermark passes its end.

    State is one number per series and open day. Windows start at midnight UTC, so the clock time of an event is
    read as UTC whatever the session's zone is.
    """
    zone = F.current_timezone()
    clock = F.from_utc_timestamp(ts.cast("timestamp"), zone)
    keyed = events.select(key.alias(KEY), clock.alias("ts"), value.alias("_v"))
    days = keyed.withWatermark("ts", delay).groupBy(KEY, F.window("ts", "1 day")).agg(F.sum("_v").alias(TARGET))
    return days.select(KEY, F.to_utc_timestamp("window.start", zone).cast("date").alias(DAY), TARGET)


def append_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process all files that are there, append the finished days to ``path`` and stop.

    The checkpoint makes a restart continue where the last run ended, without writing a day twice.
    """
    query = (
        stream.writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def stream_daily_panel(spark: SparkSession, folder: str, pattern: str, schema, key: Column, ts: Column, value: Column
                       ) -> DataFrame:
    """Run the stream once over the files that are there and return the finished days."""
    out, state = fresh_path(spark, "stream"), fresh_path(spark, "stream-state")
    days = daily_totals(read_stream(spark, folder, schema, pattern), key, ts, value)
    append_available(days, out, state)
    return spark.read.schema(days.schema).parquet(out)
