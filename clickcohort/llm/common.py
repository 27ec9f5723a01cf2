"""Shared column expressions and tables in the shared folder."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from clickcohort.session import ensure_checkpoint_dir

#: Six ASCII white-space characters; a word is a longest run of anything else.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
_GAP = r"[\x20\x09-\x0D]+"
#: Tables of at most so many rows and bytes are broadcast after being measured.
BROADCAST_ROWS = 400_000
BROADCAST_BYTES = 32 << 20
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def words(text: Column) -> Column:
    """Words of a text as an array; empty for null or blank texts."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, _GAP))


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def bounded_batches(spark: SparkSession, size: int = 4 << 20) -> None:
    """Hand texts to Python by bytes, not by 10,000 rows, whatever their length.

    A limit that was set with a unit, such as 64m, is left as it is.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    known = spark.conf.get(name).rstrip("bB")
    if known.isdigit() and int(known) > size:
        spark.conf.set(name, str(size))


def row_key(doc_id: Column, text: Column) -> Column:
    """128 bits that name a row by its doc_id and text; null and empty texts have one name."""
    owner = F.coalesce(F.concat(F.lit("+"), doc_id.cast("string")), F.lit("-"))
    return F.unhex(F.md5(F.concat(F.length(owner).cast("string"), F.lit(":"), owner,
                                  F.coalesce(text, F.lit("")))))


def unused(frame: DataFrame, name: str) -> str:
    """The name, with underscores before it until no column of the frame has it."""
    known = {c.lower() for c in frame.columns}
    while name.lower() in known:
        name = f"_{name}"
    return name


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new path under the shared checkpoint folder; it is not created."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{label}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The frame, written to the shared folder and read back, which cuts its lineage."""
    spark = frame.sparkSession
    path = shared_folder(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def _width(field: T.StructField) -> Column:
    """Bytes of a column's values in a row, about: 16, and what strings and lists hold."""
    value, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        held = F.octet_length(value)
    elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
        held = F.aggregate(value, F.lit(0), lambda s, x: s + F.octet_length(
            F.coalesce(x, F.lit(""))) + F.lit(16))
    elif isinstance(kind, T.ArrayType):
        held = F.size(value) * 16
    else:
        held = F.lit(0)
    return F.coalesce(held, F.lit(0)).cast("long") + F.lit(16)


def small(frame: DataFrame) -> DataFrame:
    """Marked for broadcast if its rows and bytes are measured to be few, else left to a
    shuffled join.

    For frames that are cheap to compute or already written.
    """
    width = reduce(lambda x, y: x + y, [_width(f) for f in frame.schema.fields])
    rows, held = frame.agg(F.count("*"), F.sum(width)).first()
    few = rows <= BROADCAST_ROWS and (held or 0) <= BROADCAST_BYTES
    return F.broadcast(frame) if few else frame


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
