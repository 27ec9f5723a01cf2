"""Token counts through a cache keyed by content and tokenizer digests.

A row's content is normalised (null becomes the empty text; nothing else, as every byte
may change a count) and hashed. Digests that the cache holds for this tokenizer version
are looked up; each other distinct content is encoded once, and its count is appended to
the cache. The version is the hash of the tokenizer's file, so another file never sees
these counts. The cache is a Parquet folder `version=<hash>` on shared storage; appending
is Spark's committed write, so a lost executor leaves nothing half-written.

Copies are dropped while texts are shuffled, by partial aggregation, so a text that holds a
third of all rows is encoded once and reaches a task only a few times. Empty texts have 0
bytes and 0 tokens. Null ids and rows that repeat are kept. Only id and text are read. An
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_BATCH_BYTES = 1 << 20
_CACHE = "digest binary, n_tokens bigint"


def normalised(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def version(path: str) -> str:
    """Digest of a tokenizer file."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def load(path: str):
    """A function from texts to token counts: sentencepiece for .model, tokenizers for .json."""
    if path.endswith(".model"):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(x.ids) for x in
                          tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def by_bytes(texts: list[str], limit: int = _BATCH_BYTES) -> Iterator[list[str]]:
    """Runs of texts of about `limit` characters; a longer text is a run of its own."""
    run, size = [], 0
    for text in texts:
        if run and size + len(text) > limit:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text)
    if run:
        yield run


def _encoder(path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = None
        for batch in batches:
            if not len(batch):
                continue
            count = count or load(path)
            counts = [n for run in by_bytes(batch.column("content").to_pylist())
                      for n in count(run)]
            yield pa.record_batch([batch.column("digest"), pa.array(counts, pa.int64())],
                                  names=["digest", "n_tokens"])
    return encode


def read_cache(spark: SparkSession, cache: str, stamp: str) -> DataFrame:
    try:
        # Two writers that met the same text at one time leave two equal rows.
        return spark.read.schema(_CACHE).parquet(f"{cache}/version={stamp}").dropDuplicates(
            ["digest"])
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], _CACHE)


def count_tokens(docs: DataFrame, path: str, cache: str) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every row; counts missing in the cache are added."""
    spark = docs.sparkSession
    stamp = version(path)
    rows = docs.select("doc_id", normalised(F.col("text")).alias("content")).select(
        "doc_id", F.octet_length("content").cast("long").alias("n_bytes"),
        F.unhex(F.sha2("content", 256)).alias("digest"), "content")
    known = read_cache(spark, cache, stamp)
    misses = (rows.groupBy("digest").agg(F.first("content").alias("content"))
              .join(known.select("digest"), "digest", "left_anti"))
    (misses.mapInArrow(_encoder(path), _CACHE)
     .write.mode("append").parquet(f"{cache}/version={stamp}"))
    return rows.drop("content").join(read_cache(spark, cache, stamp), "digest", "left").select(
        "doc_id", "n_bytes", "n_tokens")
