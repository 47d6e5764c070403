"""URL filter: dated list entries, and captures judged by the entries in force when they were fetched."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPAN = 32  # days in a block; an interval that has an end is listed under each block that it touches
OPEN = -(2**40)  # the block of intervals without an end, which every capture asks too
FOREVER = 2**31 - 1


def host(url: Column) -> Column:
    """The lower-case host of a URL without port and user; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def domains(name: Column) -> Column:
    """The host and each parent domain of two labels or more: a.b.example.net, b.example.net, example.net."""
    parts = F.split(name, r"\.")
    count = F.greatest(F.size(parts) - 1, F.lit(1))
    return F.transform(
        F.sequence(F.lit(1), count),
        lambda i: F.concat_ws(".", F.slice(parts, i, F.size(parts) - i + 1)),
    )


def intervals(entries: DataFrame) -> DataFrame:
    """Entries (domain, day, action) as (domain, action, since, until): each holds until the domain's next day.

    Entries of the same domain and day are one: a block wins over an allow.
    """
    known = entries.filter(F.col("domain").isNotNull() & F.col("day").isNotNull() & F.col("action").isNotNull())
    daily = known.groupBy("domain", F.col("day").cast("int").alias("since")).agg(
        F.max(F.when(F.col("action") == "block", 1).otherwise(0)).alias("blocks")
    )
    order = Window.partitionBy("domain").orderBy("since")  # a row per domain and day at most
    until = F.coalesce(F.lead("since").over(order), F.lit(FOREVER))
    return daily.withColumn("until", until)


def judged(captures: DataFrame, entries: DataFrame, url: str = "url", day: str = "day") -> DataFrame:
    """``captures`` with the list's verdict at the time of each fetch: blocked, entry_domain, entry_since.

    Entries become validity intervals [since, until). Each is listed under the blocks of SPAN days that it
    touches, so the as-of join is an equality on domain and block that leaves few intervals for each host and day,
    which are judged once however many captures they have. The last interval of a domain has no end; it is listed once
    and holds for captures of any later day. An entry covers its domain and all below it. Of the entries in force the
    one of the longest domain decides.

    A capture without host or day, or with no entry in force: not blocked, null entry. Repeated captures: each
    gives its own row. Entries with a null are ignored. Empty tables: no rows, or nothing blocked. All columns of
    ``captures`` stay; ones named like the new columns are replaced.
    """
    touched = F.sequence(F.floor(F.col("since") / SPAN), F.floor((F.col("until") - 1) / SPAN))
    blocks = F.when(F.col("until") == FOREVER, F.array(F.lit(OPEN))).otherwise(touched)
    spans = intervals(entries).withColumn("block", F.explode(blocks))
    own = captures.withColumns({"__host": host(F.col(url)), "__day": F.col(day).cast("int")})
    # captures of one host and day are judged once
    asked = own.select("__host", "__day").filter((F.col("__host") != "") & F.col("__day").isNotNull()).distinct()
    asked = asked.select("__host", "__day", F.explode(domains(F.col("__host"))).alias("domain"))
    own_block = F.floor(F.col("__day") / SPAN)
    asked = asked.select("*", F.explode(F.array(own_block, F.lit(OPEN))).alias("block"))
    found = (
        asked.join(spans, ["domain", "block"])
        .filter((F.col("since") <= F.col("__day")) & (F.col("__day") < F.col("until")))
        .groupBy("__host", "__day")
        .agg(F.max(F.struct(F.length("domain").alias("n"), "domain", "since", "blocks")).alias("_e"))
        .select(
            "__host", "__day",
            (F.col("_e.blocks") == 1).alias("blocked"),
            F.col("_e.domain").alias("entry_domain"),
            F.col("_e.since").cast("long").alias("entry_since"),
        )
    )
    new = ["blocked", "entry_domain", "entry_since"]
    out = own.drop(*new).join(found, ["__host", "__day"], "left").drop("__host", "__day")
    return out.withColumn("blocked", F.coalesce("blocked", F.lit(False)))
