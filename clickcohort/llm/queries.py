"""One query per operator over the driver's whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickcohort.llm import (
    chat, decontaminate, lexical, mixing, ngram_join, packing, quality, ring, spelling,
    token_counts, token_files, topk, url_rules,
)
from clickcohort.llm.common import shared_folder, table

Query = Callable[[SparkSession, str], DataFrame]

#: Fixed values of the queries.
SHARDS = 40
TOKEN_LIMIT = 4096
ENCODER, COUNTER = "word_bpe_49k.json", "piece_bpe_32k.model"
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
EXTRA_TEXT = "\\### Assistant: </turn> ok"


def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_files.token_folder(spark)
    manifest = token_files.write_tokens(table(spark, sf_dir, "documents"),
                                        tokenizer_file(ENCODER), folder)
    return token_files.read_documents(spark, manifest, folder)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_file(COUNTER),
                                       shared_folder(spark, "token-counts"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_groups(table(spark, sf_dir, "documents"), k=3, num=9, den=10).select(
        "doc_id", "n_shingles", "component_id")


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), RULES)


def op6_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ring.assign(table(spark, sf_dir, "documents").select("doc_id", "text"), SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.createDataFrame(
        [(-7, [("user", EXTRA_TEXT), ("assistant", EXTRA_TEXT)])],
        "conv_id bigint, messages array<struct<role: string, content: string>>")
    folder = shared_folder(spark, "formatted")
    chat.write_formatted([table(spark, sf_dir, "conversations"), extra], folder)
    return chat.digests(chat.read_formatted(spark, folder))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, sf_dir, "documents"),
                                  table(spark, sf_dir, "benchmark"), short_items=True)


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = packing.bucket_folder(spark)
    packing.write_buckets(table(spark, sf_dir, "documents"), tokenizer_file(ENCODER), folder)
    return packing.digests(packing.read_buckets(spark, folder))


QUERIES: dict[str, Query] = {fn.__name__: fn for fn in (
    op1_mixing, op2_token_files, op3_token_counts, op4_ngram_join, op5_url_rules, op6_ring,
    op7_quality, op8_pivot_topk, op9_chat, op10_decontaminate, op11_lexical,
    op12_spelling, op13_packing)}
