"""Connected components of a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.session import settle


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that links (x, y) reach; nodes without a link are absent.

    Large-star and small-star steps in turn until the links no longer change. Each step is a minimum per node and
    a join back to its links, so no node's neighbours are ever gathered; only two numbers reach the driver.
    """
    edges = settle(
        links.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).filter("u <> v").distinct(), "edges"
    )
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # large star: larger neighbours of a node link to its smallest one
        large = both.join(least, "u").filter("v > u and v <> m")
        large = settle(large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-star")
        # small star: a node and its smaller neighbours link to the smallest of them
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = settle(small.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
