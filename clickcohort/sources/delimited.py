"""CSV sources: everything is read as text, and typed later in one place."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickcohort.functions.cleaning import NULL_TOKENS, null_tokens_to_null
from clickcohort.sources.records import parse_records, read_records

# File names of the two exports.
BOOKING_GLOBS = ("booking_*.csv", "*entry_clicks*.csv")
IP_GLOBS = ("On_demand_report_*.csv",)

_ID = re.compile(r"^ID[.\d]*$", re.IGNORECASE)


def list_files(spark: SparkSession, folder: str, globs: Sequence[str]) -> list[str]:
    """Paths matching any of the globs, each once, on any Hadoop file system."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found: set[str] = set()
    for glob in globs:
        pattern = jvm.org.apache.hadoop.fs.Path(folder.rstrip("/") + "/" + glob)
        for status in pattern.getFileSystem(conf).globStatus(pattern) or []:
            if status.isFile():
                found.add(status.getPath().toString())
    return sorted(found)


def header_line(spark: SparkSession, path: str) -> str:
    """First line of a file; a metadata read on the driver, like a Parquet footer."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(conf).open(target)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return reader.readLine() or ""
    finally:
        stream.close()


def read_csv(spark: SparkSession, paths: str | Sequence[str], multi_line: bool = False,
             null_tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Files with one common header; null spellings become null.

    Adds ``source_file``. Two equal headers come out as name plus position, as Spark
    names them. ``multi_line`` accepts line breaks inside quotes; files are still read in
    pieces (records.py), at the price of reading the text twice.
    """
    frame = (
        spark.read.option("header", True).option("inferSchema", False)
        .option("escape", '"').option("encoding", "UTF-8").option("multiLine", multi_line)
        .csv(paths)
    )
    names = frame.columns
    if multi_line:
        listed = [paths] if isinstance(paths, str) else list(paths)
        frame = parse_records(read_records(spark, listed), names)
    else:
        frame = frame.select(*[_raw(frame, n) for n in names],
                             F.col("_metadata.file_path").alias("source_file"))
    return frame.select(*[null_tokens_to_null(_raw(frame, n), null_tokens).alias(n)
                          for n in names], "source_file")


def read_many(spark: SparkSession, paths: Sequence[str], multi_line: bool = False) -> DataFrame:
    """Union by column name over files whose headers may differ; missing cells are null.

    One scan per distinct header, not per file.
    """
    return _union([read_csv(spark, group, multi_line) for group in _groups(spark, paths)])


def read_exports(spark: SparkSession, folder: str, multi_line: bool = False
                 ) -> tuple[DataFrame, DataFrame]:
    """(bookings, addresses) of a folder; an error when either kind is missing."""
    bookings = list_files(spark, folder, BOOKING_GLOBS)
    addresses = list_files(spark, folder, IP_GLOBS)
    if not bookings:
        raise ValueError(f"no booking files in {folder}")
    if not addresses:
        raise ValueError(f"no IP files in {folder}")
    return (_with_ids_each(spark, bookings, multi_line),
            _addresses_each(spark, addresses, multi_line))


def _groups(spark: SparkSession, paths: Sequence[str]) -> list[list[str]]:
    by_header: dict[str, list[str]] = {}
    for path in paths:
        by_header.setdefault(header_line(spark, path), []).append(path)
    return list(by_header.values())


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def _with_ids_each(spark: SparkSession, paths: Sequence[str], multi_line: bool) -> DataFrame:
    # Id columns are named by position, so they are resolved before the union.
    return _union([resolve_ids(read_csv(spark, group, multi_line), strict=True)
                   for group in _groups(spark, paths)])


def _addresses_each(spark: SparkSession, paths: Sequence[str], multi_line: bool) -> DataFrame:
    return _union([address_table(read_csv(spark, group, multi_line))
                   for group in _groups(spark, paths)])


def _raw(frame: DataFrame, name: str):
    return frame["`" + name.replace("`", "``") + "`"]


def id_columns(frame: DataFrame) -> list[str]:
    return [c for c in frame.columns if _ID.match(c.strip())]


def resolve_ids(frame: DataFrame, strict: bool = False) -> DataFrame:
    """Name the id columns: the first ``ID`` is user_agent_id, the last click_id.

    A single ``ID`` serves as both. Without any, the last data column is the click
    id, or, when ``strict``, it is an error.
    """
    ids = id_columns(frame)
    if not ids:
        if strict:
            raise ValueError("no ID column in booking data")
        data = [c for c in frame.columns if c != "source_file"]
        return frame.withColumn("click_id", _raw(frame, data[-1]))
    out = [_raw(frame, c).alias(c) for c in frame.columns if c not in (ids[0], ids[-1])]
    return frame.select(*out, _raw(frame, ids[0]).alias("user_agent_id"),
                        _raw(frame, ids[-1]).alias("click_id"))


def address_table(frame: DataFrame) -> DataFrame:
    """(click, addr) of an IP export, whatever prefix its headers carry."""
    cleaned = {c: c.replace("mdc.", "").strip() for c in frame.columns}

    def find(word: str) -> str:
        exact = [c for c, name in cleaned.items() if name == word]
        alike = [c for c, name in cleaned.items() if word in name.lower() and c != "source_file"]
        if not exact and not alike:
            raise ValueError(f"no {word} column in IP data: {list(cleaned)}")
        return exact[0] if exact else alike[-1]

    return frame.select(_raw(frame, find("click")).alias("click"),
                        _raw(frame, find("addr")).alias("addr"))
