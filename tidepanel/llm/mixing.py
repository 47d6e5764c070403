"""Mixing sources to target weights by capped water-filling."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.functions.ranks import running_total
from tidepanel.llm.words import WORD, whole
from tidepanel.session import settle

WEIGHTS = (5, 2, 1)  # fixed values: they repeat over the sources by code point, null last


def sized(docs: DataFrame, seed: str, source: str = "source") -> DataFrame:
    """A stored row per document: size in words, and a seeded key that orders the documents of a source.

    The text is read once; all later steps read this table.
    """
    return settle(
        docs.select(
            F.monotonically_increasing_id().alias("_row"),
            "doc_id",
            F.col(source).cast("string").alias("_source"),
            F.regexp_count(whole(), F.lit(WORD)).cast("long").alias("size"),
            F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
            .alias("_key"),
            F.xxhash64(whole()).alias("_text"),
        ),
        "sizes",
    )


def water_filled(sources: DataFrame, total: float) -> DataFrame:
    """``sources`` (weight, cap) with target: shares of ``total`` by weight, none above its cap.

    Sources whose share exceeds the cap are clamped and the rest is shared anew by weight, until no more is
    clamped. Only the level, one number, passes between the rounds; every round but the last clamps more.
    """
    level, clamped = 0.0, -1
    while True:
        over = F.col("cap") <= F.lit(level) * F.col("weight")
        row = sources.agg(
            F.count(F.when(over, 1)).alias("n"),
            F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0)).alias("full"),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)).alias("open"),
        ).first()
        if row["n"] == clamped or row["open"] == 0:
            break
        clamped = row["n"]
        level = max(level, (total - float(row["full"])) / float(row["open"]))
    target = F.least(F.col("cap").cast("double"), F.lit(level) * F.col("weight"))
    if row["open"] == 0:
        target = F.col("cap").cast("double")
    return sources.withColumn("target", target)


def targets(sizes: DataFrame, share: float, epochs: int, weights: tuple[int, ...]) -> DataFrame:
    """A stored row per source: source_size, weight and target, in words."""
    per = settle(sizes.groupBy("_source").agg(F.sum("size").alias("source_size")), "sources")
    order = [F.col("_source").isNull(), F.col("_source")]
    ranked = running_total(per, "source_size", order, rank="_rank")
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = ranked.select(
        "_source", "source_size",
        F.get(cycle, ((F.col("_rank") - 1) % len(weights)).cast("int")).alias("weight"),
        (F.col("source_size") * epochs).alias("cap"),
    )
    ranked = settle(ranked, "weighted")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    return water_filled(ranked, share * total)


def _bucket(key: Column) -> Column:
    return F.substring(key, 1, 4)


def mixed(
    docs: DataFrame, share: float = 1.5, epochs: int = 2, weights: tuple[int, ...] = WEIGHTS, seed: str = "mix",
    source: str = "source",
) -> DataFrame:
    """How often the mix takes each row of ``docs`` (doc_id, text, and ``source``), without its text.

    Targets come from capped water-filling. A source with a target of e times its size gives every document
    floor(e) times, and once more the documents that come first by seeded hash, up to the words still missing
    (the last one is taken if that comes nearer). The hash splits a source into 65,536 buckets whose sums are
    added up first, so the running sum never needs a whole source in one task.

    Null source: a source of its own, last in order. Null or empty text: size 0, nothing taken. Repeated rows:
    each counts; ties of the key go by size, then by a hash of the text. Empty table: no rows. Other columns are ignored.
    """
    sizes = sized(docs, seed, source)
    goal = targets(sizes, share, epochs, weights)
    known = F.coalesce(F.concat(F.lit("="), F.col("_source")), F.lit(""))
    whole_times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goal = goal.select(
        known.alias("_s"), "source_size", "target", whole_times.alias("_times"),
        (F.col("target") - whole_times * F.col("source_size")).alias("_missing"),
    )
    rows = sizes.withColumns({"_s": known, "_b": _bucket(F.col("_key"))})
    sums = rows.groupBy("_s", "_b").agg(F.sum("size").alias("_sum"))
    before = Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_s", "_b", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    sums = sums.join(goal, "_s")
    inside = Window.partitionBy("_s", "_b").orderBy("_key", "size", "_text").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(sums, ["_s", "_b"])
    start = F.col("_before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    rows = rows.withColumn("_start", start)
    once_more = (2 * F.col("_start") + F.col("size") < 2 * F.col("_missing")).cast("long")
    return rows.select(
        "doc_id", "size", "source_size", "target",
        ((F.col("_times") + once_more) * F.col("size")).cast("long").alias("taken"),
        (F.col("_times") + once_more).cast("long").alias("times"),
        "_source", "_text",
    )


def mixture(docs: DataFrame, source: str = "source", **settings) -> DataFrame:
    """The mix itself: the rows of ``docs``, repeated or left out as :func:`mixed` says, with the same columns.

    Rows are matched by doc_id, source, size and a hash of the text. All that agree in these are taken equally often,
    but for one group per source at most, in which its running sum passes the missing words: there the first rows by a
    hash of all columns are taken once more, so reruns differ in nothing that a reader can see.

    Null source, null or empty text, repeated rows: as in :func:`mixed`; rows without words are
    repeated like their neighbours in the order. Empty
    table: no rows. Columns whose names begin with ``_mix_`` are reserved.
    """
    keys = ["_mix_id", "_mix_source", "_mix_size", "_mix_text"]

    def keyed(rows: DataFrame, own: str, size: Column, text: Column) -> DataFrame:
        return rows.withColumns({
            "_mix_id": F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
            "_mix_source": F.coalesce(F.concat(F.lit("="), F.col(own).cast("string")), F.lit("")),
            "_mix_size": size,
            "_mix_text": text,
        })

    def copies(rows: DataFrame, times: Column) -> DataFrame:
        rows = rows.withColumn("_mix_times", times.cast("int")).filter("_mix_times > 0")
        return rows.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_times")))).select(*docs.columns)

    chosen = keyed(mixed(docs, source=source, **settings), "_source", F.col("size"), F.col("_text"))
    chosen = chosen.groupBy(*keys).agg(
        F.min("times").alias("_mix_least"), F.max("times").alias("_mix_most"),
        F.sum(F.col("times")).alias("_mix_sum"), F.count(F.lit(1)).alias("_mix_rows"),
    )
    chosen = settle(chosen.filter("_mix_most > 0"), "mix-times")
    size = F.regexp_count(whole(), F.lit(WORD)).cast("long")
    rows = keyed(docs, source, size, F.xxhash64(whole()))
    alike = rows.join(chosen.filter("_mix_least = _mix_most"), keys)
    passed = rows.join(chosen.filter("_mix_least < _mix_most"), keys)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64(F.to_json(F.struct(*docs.columns)))))
    more = (place <= F.col("_mix_sum") - F.col("_mix_rows") * F.col("_mix_least")).cast("long")
    return copies(alike, F.col("_mix_least")).unionByName(copies(passed, F.col("_mix_least") + more))
