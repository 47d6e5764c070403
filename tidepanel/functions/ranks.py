"""Exact quantiles and running sums over a whole table, without sorting it in one task."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.session import settle

ACCURACY = 100_000  # percentile_approx is off by at most n / ACCURACY ranks
MARGIN = 5.0 / ACCURACY


def exact_quantiles(df: DataFrame, value: str, probs: list[float], by: list[str] | None = None) -> DataFrame:
    """Linear-interpolated quantiles as rows (by…, prob, quantile).

    percentile() keeps every distinct value of a group in one task. Here approximate quantiles only choose a
    band of values around each target. Rows below and above the band are counted, with the largest below and the
    smallest above, which a target in a short column may fall on; only the band, collapsed to distinct values, is
    ordered, in ranges over all groups together. The approximation cannot change the result: the counts are exact,
    and the band with its two neighbours is wider than the error bound at every size.
    """
    by = by or []
    data = df.select(*by, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    cuts = [min(max(p + side * MARGIN, 0.0), 1.0) for p in probs for side in (-1, 1)]
    stats = data.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"),
        F.percentile_approx("_v", cuts, ACCURACY).alias("_cuts"),
    )

    def band(i: int, p: float) -> Column:
        return F.struct(
            F.lit(p).alias("prob"), F.col("_cuts")[2 * i].alias("low"), F.col("_cuts")[2 * i + 1].alias("high")
        )

    bands = stats.select(*by, "_n", F.array(*[band(i, p) for i, p in enumerate(probs)]).alias("_bands"))
    if by:
        # stored first, so that its true size decides between a broadcast and a shuffle
        joined = data.join(settle(bands, "bands"), by)
    else:
        one = bands.select(F.struct("_n", "_bands")).scalar()
        joined = data.select("_v", one.getField("_n").alias("_n"), one.getField("_bands").alias("_bands"))
    side = F.when(F.col("_v") < F.col("low"), -1).when(F.col("_v") > F.col("high"), 1).otherwise(0)
    spot = F.when(side == 0, F.col("_v"))
    counts = settle(
        joined.select(*by, "_v", "_n", F.inline("_bands"))
        .groupBy(*by, "prob", "_n", side.alias("_side"), spot.alias("_spot"))
        .agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_least"), F.max("_v").alias("_most")),
        "band-counts",
    )
    group = [*by, "prob"]
    order = [*[F.col(c) for c in group], F.col("_side"), F.col("_spot")]
    walked = settle(running_total(counts, "_c", order, "_walk"), "walked")
    # the sum runs over all groups; what stands before a group comes off
    begin = walked.groupBy(*group).agg(F.min(F.col("_walk") - F.col("_c")).alias("_begin"))
    keys = [F.col(c).eqNullSafe(F.col(f"_{c}_key")) for c in group]
    begin = begin.select("_begin", *[F.col(c).alias(f"_{c}_key") for c in group])
    on = keys[0]
    for key in keys[1:]:
        on = on & key
    walked = walked.join(begin, on).withColumn("_seen", F.col("_walk") - F.col("_begin"))
    place = F.col("prob") * (F.col("_n") - 1)
    low, high = F.floor(place), F.ceil(place)
    here = F.when(F.col("_side") < 0, F.col("_most")).when(F.col("_side") > 0, F.col("_least")).otherwise(F.col("_spot"))

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_seen") - F.col("_c") <= rank) & (rank < F.col("_seen")), here))

    ends = walked.groupBy(*group, "_n").agg(at(low).alias("_lo"), at(high).alias("_hi"))
    share = place - low
    return ends.select(*group, (F.col("_lo") * (1 - share) + F.col("_hi") * share).alias("quantile"))


def running_total(df: DataFrame, value: str, order: list[Column], into: str = "running", rank: str | None = None
                  ) -> DataFrame:
    """Running sum (and position) over the whole table in the given total order.

    The table is range-partitioned by the order and stored, which fixes the ranges; the totals of the ranges
    before each one are then added to a running sum inside it. No task sees more than one range, and equal
    values spread over ranges because the order also has the key.
    """
    ordered = settle(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    totals = ordered.groupBy("_range").agg(F.sum(value).alias("_s"), F.count(F.lit(1)).alias("_c"))
    offsets = totals.select(
        "_range",
        F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_s0"),
        F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_c0"),
    )
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = ordered.join(F.broadcast(offsets), "_range")  # as many rows as shuffle partitions
    out = out.withColumn(into, F.col("_s0") + F.sum(value).over(inside))
    if rank:
        out = out.withColumn(rank, F.col("_c0") + F.count(F.lit(1)).over(inside))
    return out.drop("_range", "_s0", "_c0")
