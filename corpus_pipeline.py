"""A corpus from raw documents to shards, as five stages over written tables.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are written as
Parquet and read back as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickcohort.llm import decontaminate, mixing, ngram_join, quality, ring
from clickcohort.llm.common import stored, table

SHARDS = 40


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return ngram_join.without_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"), short_items=True)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed_copies(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with size, text_crc32, law, shard and slot."""
    placed = ring.assign(docs, SHARDS)
    return placed.withColumn("law", F.lit("bytes")).select(
        *[c for c in docs.columns if c not in ("size", "text_crc32", "law", "shard", "slot")],
        "size", "text_crc32", "law", "shard", "slot")


STAGES = [
    ("quality classifier", quality_filter),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources", mixture),
    ("sharding", shards),
]

#: Trained scores, near-copy groups and seeded hits are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
