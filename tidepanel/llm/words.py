"""Expressions on text that several operators share."""

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"  # what stands between white space
TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # letters, digits and everything beyond ASCII, after lower-casing


def whole(column: str = "text") -> Column:
    """The text; a null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A to Z in lower case, and nothing else: full case mapping would also turn a Kelvin sign into a k."""
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def words(text: Column, pattern: str = WORD) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def embeddings(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")
