"""Parquet datasets partitioned by date, and report sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def write_day(frame: DataFrame, path: str, compression: str = "snappy",
              date: str | None = None) -> None:
    """Replace dates and leave the other dates alone.

    With ``date`` the folder of that day is replaced, also by no rows; without, the dates
    present in ``frame``.
    """
    if date is not None:
        (frame.drop("date").write.mode("overwrite").option("compression", compression)
         .parquet(f"{path}/date={date}"))
        return
    (frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("compression", compression).partitionBy("date").parquet(path))


def read_day(spark: SparkSession, path: str, date: str | None = None) -> DataFrame:
    """One date with the columns it was written with, or all dates with merged
    columns; ``date`` is text."""
    if date is None:
        frame = spark.read.option("mergeSchema", True).parquet(path)
    else:
        frame = spark.read.option("basePath", path).parquet(f"{path}/date={date}")
    return frame.withColumn("date", F.col("date").cast("string"))


def write_csv(frame: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header. The sort order of ``frame`` runs through the part files; a
    single file is for frames known to be small."""
    out = frame.coalesce(1) if single_file else frame
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_json(frame: DataFrame, path: str) -> None:
    frame.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_model(forest, path: str) -> None:
    forest.to_table().write.mode("overwrite").parquet(path)
