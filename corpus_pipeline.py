"""The corpus pipeline: from raw documents to token ids, one operator of the subpackage after the other."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidepanel.llm import mixing, ngram_join, pieces, quality, suffixes
from tidepanel.session import settle


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go, and frequent lines of the others; n_chars is counted anew."""
    return quality.cleaned(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of alike ones stays: the one with the smallest doc_id. Alike: 80 % of the runs of
    five words."""
    return ngram_join.one_of_each(docs, size=5, percent=80)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings that an earlier document has go from the text; n_chars is counted anew."""
    return suffixes.without_repeats(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that each source has its share of words."""
    return mixing.mixture(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, byte spans and decoded text of each document of the mix."""
    return pieces.encoded(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_strings),
    ("source mix", source_mix),
    ("SentencePiece", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; each writes Parquet to the shared folder, which the next one reads."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


# byte strings that cut characters, and a tokenizer, are beyond SQL: tests hold the pipeline against brute force
ORACLE_SQL = None
