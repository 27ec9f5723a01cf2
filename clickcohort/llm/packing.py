"""Sequences of at most `length` ids, none of which crosses a document.

The number of a document's ids is written in binary: as many pieces of the full length as fit,
then one piece for each set bit of the rest, longest first. Every piece has a power of two of
ids and is a sequence of its own, so nothing is padded; sequences of one length form a bucket,
from which batches of equal length are read. `write_buckets` writes one folder a length.

Documents are encoded where they are read and never shuffled; a hot source or a group of copies
is rows like any others. Sequence numbers run from 0 without a gap, longest bucket first; within
a bucket they follow the writing tasks. A task counts its own sequences of each length, and only
these counts (one row for a task and a length) are summed up over tasks. Pieces and counts come
from one committed write, so a task that runs twice or an executor that is lost changes nothing.

A null text is the empty text and has one id, the end. Repeated rows are packed once each, under
their own sequences; a null doc_id stays null. A document of any length is cut whole. An empty
table gives no pieces. Only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from clickcohort.llm.common import shared_folder, small
from clickcohort.llm.token_counts import by_bytes
from clickcohort.llm.token_files import Encoder

LENGTH = 4096
_RUN_BYTES = 2 << 20

#: `ids` holds little-endian unsigned numbers of `width` bytes; `task` and `place` give the
#: sequence its number.
PIECES = ("doc_id bigint, start bigint, doc_tokens bigint, width int, ids binary, task int, "
          "place bigint, length int")


def binary_lengths(n: int, longest: int) -> list[int]:
    """Powers of two that add up to n, longest first, none above `longest`."""
    whole, rest = divmod(n, longest)
    return [longest] * whole + [1 << bit for bit in range(rest.bit_length() - 1, -1, -1)
                                if rest >> bit & 1]


def _cut(counts: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, start in it and length of every piece, in document order."""
    lengths = [binary_lengths(n, longest) for n in counts.tolist()]
    doc = np.repeat(np.arange(len(counts)), [len(x) for x in lengths])
    flat = np.array([n for x in lengths for n in x], dtype=np.int64)
    start = np.cumsum(flat) - flat - (np.cumsum(counts) - counts)[doc]
    return doc, start, flat


def _packer(path: str, end_id: int, longest: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = None, TaskContext.get().partitionId()
        used: dict[int, int] = {}
        for found in batches:
            if not len(found):
                continue
            encoder = encoder or Encoder(path, end_id)
            width, at = encoder.kind.itemsize, 0
            for run in by_bytes(found.column("text").to_pylist(), _RUN_BYTES):
                ids, counts = encoder(run)
                doc, start, length = _cut(counts, longest)
                place = np.empty_like(length)
                for n in np.unique(length).tolist():
                    here = length == n
                    first = used.get(n, 0)
                    place[here] = np.arange(first, first + here.sum())
                    used[n] = first + int(here.sum())
                # Pieces lie end to end as the ids do.
                bounds = np.concatenate([[0], np.cumsum(length)]) * width
                raw = pa.py_buffer(ids.astype(f"<u{width}", copy=False).tobytes())
                blob = pa.Array.from_buffers(pa.large_binary(), len(length), [
                    None, pa.py_buffer(bounds.astype(np.int64).tobytes()), raw]).cast(pa.binary())
                yield pa.record_batch([
                    found.column("doc_id").slice(at, len(run)).take(pa.array(doc)),
                    pa.array(start), pa.array(counts[doc]),
                    pa.array(np.full(len(length), width, np.int32)), blob,
                    pa.array(np.full(len(length), task, np.int32)), pa.array(place),
                    pa.array(length.astype(np.int32)),
                ], names=["doc_id", "start", "doc_tokens", "width", "ids", "task", "place",
                          "length"])
                at += len(run)
    return pack


def write_buckets(docs: DataFrame, path: str, folder: str, end_id: int = 2,
                  length: int = LENGTH) -> None:
    """Encode, cut and write all documents, one Parquet folder `length=<n>` a bucket.

    `length` must be a power of two, or the longest sequences would need padding.
    """
    if length < 1 or length & (length - 1):
        raise ValueError(f"not a power of two: {length}")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    (rows.mapInArrow(_packer(path, end_id, length), PIECES)
     .write.partitionBy("length").parquet(folder))


def read_buckets(spark: SparkSession, folder: str, length: int | None = None) -> DataFrame:
    """Sequences of all buckets, or of one: PIECES, sequence_id and offset (always 0).

    Only the one bucket's files are read for its sequences; numbers stay those of all buckets.
    """
    pieces = spark.read.schema(PIECES).parquet(folder)
    sizes = pieces.groupBy("length", "task").agg(F.count("*").alias("_n"))
    # A row for a task and a length, and then one for a length.
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("task")) - F.col("_n")
    longer = sizes.groupBy("length").agg(F.sum("_n").alias("_all")).select(
        F.col("length").alias("_length"), (F.sum("_all").over(Window.orderBy(
            F.col("length").desc())) - F.col("_all")).alias("_longer"))
    base = sizes.select(F.col("length").alias("_length"), F.col("task").alias("_task"),
                        before.alias("_before")).join(F.broadcast(longer), "_length")
    base = small(base)
    wanted = pieces if length is None else pieces.where(F.col("length") == length)
    return wanted.join(base, (F.col("length") == F.col("_length"))
                       & (F.col("task") == F.col("_task"))).select(
        *pieces.columns, (F.col("_longer") + F.col("_before") + F.col("place")).alias(
            "sequence_id"), F.lit(0).cast("long").alias("offset"))


def digests(sequences: DataFrame) -> DataFrame:
    """Rows of `read_buckets` with the checksum of their ids in place of the ids."""
    kept = ("doc_id", "start", "doc_tokens", "length", "sequence_id", "offset")

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in batches:
            sums = [zlib.crc32(np.frombuffer(x, f"<u{w}").astype("<u4").tobytes())
                    for x, w in zip(found.column("ids").to_pylist(),
                                    found.column("width").to_pylist())]
            yield pa.record_batch([*(found.column(c) for c in kept), pa.array(sums, pa.int64())],
                                  names=[*kept, "ids_crc32"])
    return sequences.select(*kept[:3], F.col("length").cast("long").alias("length"), *kept[4:],
                            "ids", "width").mapInArrow(
        crc, "doc_id bigint, start bigint, doc_tokens bigint, length bigint, "
             "sequence_id bigint, offset bigint, ids_crc32 bigint")


def bucket_folder(spark: SparkSession) -> str:
    return shared_folder(spark, "token-buckets")
