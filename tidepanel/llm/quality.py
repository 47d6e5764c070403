"""Quality rules: rule counts for each document, and lines that too many documents of a host repeat."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.words import whole, words
from tidepanel.session import settle

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 3


@dataclass(frozen=True)
class Rules:
    """Limits of the rules.

    A line goes when it stands in more than ``least`` of its host's n different texts, and in more than the square
    root of n of them: that grows far slower than the host, so a line's verdict does not vanish in a large one. A
    document is depleted when less than ``left`` of its words remain.
    """

    min_words: int = 50
    max_repeat: float = 0.5
    least: int = 10
    left: float = 0.3


def _repeats(grams: str, sorted_grams: str, places: str, rows: DataFrame) -> DataFrame:
    """n_repeat_words: the words covered by windows that the text has twice or more.

    The windows are sorted by hash, so equal ones become neighbours; the sorted places of those with an equal
    neighbour cover up to WINDOW words each. Texts without a repeated window skip the sort.
    """
    none = F.expr("cast(array() as array<struct<h: bigint, p: int>>)")
    pairs = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    rows = rows.withColumn(
        sorted_grams, F.when(F.size(F.array_distinct(grams)) < F.size(grams), pairs).otherwise(none)
    )

    def at(i: Column) -> Column:
        return F.get(F.col(sorted_grams), i)["h"]

    twice = F.filter(sorted_grams, lambda x, i: (at(i - 1) == x["h"]) | (at(i + 1) == x["h"]))
    rows = rows.withColumn(places, F.sort_array(F.transform(twice, lambda x: x["p"])))
    step = F.transform(
        places, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col(places), i + 1) - p, F.lit(WINDOW)))
    )
    return rows.withColumn("n_repeat_words", F.aggregate(step, F.lit(0), lambda a, x: a + x).cast("long"))


def measured(docs: DataFrame, host: str = "source") -> DataFrame:
    """One stored row per document: its counts, and the hash and length of each line that has a word.

    The text is read once; all later steps read this table. ``_row`` tells repeated rows apart.
    """
    text = whole()
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col(host).cast("string")), F.lit("")).alias("_host"),
        F.xxhash64(text).alias("_text"),
        F.split(text, "\n").alias("_lines"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
    )
    rows = rows.withColumn("_split", F.transform("_lines", lambda x: words(x)))
    rows = rows.withColumn("_words", F.flatten("_split"))
    full = F.filter("_lines", lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    gram = F.transform(
        "_words", lambda w, i: F.xxhash64(w, F.get(F.col("_words"), i + 1), F.get(F.col("_words"), i + 2))
    )
    rows = rows.select(
        "_row", "doc_id", "_host", "_text", "n_symbols",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.concat_ws("", "_words")).cast("long").alias("word_chars"),
        full.alias("_full"),
        F.when(F.size("_words") >= WINDOW, F.slice(gram, F.lit(1), F.size("_words") - (WINDOW - 1)))
        .otherwise(F.expr("cast(array() as array<bigint>)")).alias("_grams"),
        F.transform(
            F.filter("_split", lambda w: F.size(w) > 0),
            lambda w: F.struct(F.xxhash64(F.lower(F.concat_ws(" ", w))).alias("h"), F.size(w).alias("n")),
        ).alias("_parts"),
    )
    rows = rows.withColumn("n_dup_lines", (F.size("_full") - F.size(F.array_distinct("_full"))).cast("long"))
    rows = _repeats("_grams", "_sorted", "_places", rows)
    return settle(rows.drop("_full", "_grams", "_sorted", "_places"), "quality")


def frequent_lines(rows: DataFrame, rules: Rules) -> DataFrame:
    """(_host, h): normalised lines in too many different texts of their host.

    Copies of one text count once. Each document gives a line once, and both counts combine before their
    shuffle, so a line in a third of all rows stays cheap.
    """
    texts = rows.select("_host", "_text").distinct().groupBy("_host").agg(F.count(F.lit(1)).alias("_texts"))
    lines = (
        rows.select("_host", "_text", F.explode(F.array_distinct(F.transform("_parts", lambda p: p["h"]))).alias("h"))
        .distinct()
        .groupBy("_host", "h")
        .agg(F.count(F.lit(1)).alias("_in"))
        .filter(F.col("_in") > rules.least)
    )
    return lines.join(texts, "_host").filter(F.col("_in") * F.col("_in") > F.col("_texts")).select("_host", "h")


def judged(docs: DataFrame, rules: Rules = Rules(), host: str = "source") -> DataFrame:
    """The rules' counts and verdict for each row of ``docs`` (doc_id, text, and ``host``).

    Normalised lines (white space collapsed, lower case) are hashed, their different texts are counted per
    host, lines above the limits count as removed, and documents that lose too much are rejected.

    Null or empty text: no words, base_failed, rejected. Null host: a host of its own. Repeated rows: each
    gives its own row, and equal texts count once per line. Empty table: no rows. Other columns are ignored.
    """
    rows = measured(docs, host)
    return _verdicts(rows, frequent_lines(rows, rules), rules)


def _verdicts(rows: DataFrame, often: DataFrame, rules: Rules) -> DataFrame:
    lines = rows.select("_row", "_host", F.inline("_parts"))
    removed = (
        lines.join(often, ["_host", "h"])
        .groupBy("_row")
        .agg(F.sum("n").alias("_removed"))
    )
    out = rows.drop("_parts").join(removed, "_row", "left")
    words_left = F.col("n_words") - F.coalesce(F.col("_removed"), F.lit(0))
    failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > F.lit(int(100 * rules.max_repeat)) * F.col("n_words")
    )
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (words_left >= F.lit(rules.left) * F.col("n_words"))).alias("kept"),
        words_left.alias("n_words_left"),
        "_host", "_text",
    )


def cleaned(docs: DataFrame, rules: Rules = Rules(), host: str = "source") -> DataFrame:
    """The rows of ``docs`` that the rules keep, without the frequent lines of their host. Columns stay; n_chars, if
    there, is counted anew.

    Lines are counted once, on ``docs``, for the verdict and for the removal. Both follow from the text and the
    host, so they are looked up by both; a null doc_id does not matter.

    Null or empty text: rejected. Null host: a host of its own. Repeated rows: all are kept or none. Empty table: no
    rows. Other columns stay as they are; names that begin with ``__quality_`` are reserved.
    """
    rows = measured(docs, host)
    often = settle(frequent_lines(rows, rules), "frequent-lines")
    kept = _verdicts(rows, often, rules).filter("kept").select("_host", "_text").distinct()
    lines = rows.select("_host", "_text", F.explode(F.array_distinct(F.transform("_parts", lambda p: p["h"]))).alias("h"))
    gone = lines.join(often, ["_host", "h"]).groupBy("_host", "_text").agg(F.collect_set("h").alias("__quality_gone"))
    kept = kept.join(gone, ["_host", "_text"], "left").withColumnsRenamed({"_host": "__quality_host", "_text": "__quality_text"})
    marked = docs.withColumn("__quality_host", F.coalesce(F.concat(F.lit("="), F.col(host).cast("string")), F.lit("")))
    found = marked.withColumn("__quality_text", F.xxhash64(whole())).join(kept, ["__quality_host", "__quality_text"])
    left = F.filter(
        F.split("text", "\n"),
        lambda x: ~F.array_contains("__quality_gone", F.xxhash64(F.lower(F.concat_ws(" ", words(x))))),
    )
    found = found.withColumn("text", F.when(F.col("__quality_gone").isNull(), F.col("text")).otherwise(F.concat_ws("\n", left)))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return found.select(*docs.columns)
