"""From raw documents to token ids: the training-data operators in sequence.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the docs of
the next. ``run`` applies them to the documents table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmix.llm import bpe, jaccard_join, line_dedup, mixing, quality_rules
from gridmix.llm.common import table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.filter_documents(docs.select(COLUMNS))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the lines that too many documents of a source share."""
    cleaned = line_dedup.clean(docs.select(COLUMNS))
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity of 0.8 or more."""
    return jaccard_join.representatives(docs.select(COLUMNS), n=5, percent=80).select(COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources repeated to their target weights, in global random order."""
    return mixing.mix(docs.select(COLUMNS)).select(COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every copy, and the digests of ids and decoded text."""
    encoded = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"))
    return bpe.digests(encoded.withColumn("tokens", encoded.ids))


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("jaccard_join", near_duplicates),
    ("poisson_mixing", mixture),
    ("byte_bpe", tokens),
]

# the quality rules iterate to a fixed point, which SQL can't express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
