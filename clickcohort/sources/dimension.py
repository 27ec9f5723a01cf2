"""User-agent dimension: id, name, userAgentType, browserModel, majorVersion, osType, device."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.errors import AnalysisException

# Columns of the dimension.
SCHEMA = ("id long, name string, userAgentType string, browserModel string, "
          "majorVersion int, osType string, device string")


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    """Read CSV (by extension) or Parquet, one row per id.

    A missing file or missing columns give an empty dimension, so that every user
    agent is Unknown.
    """
    try:
        if path.lower().rstrip("/").endswith((".csv", ".txt")):
            raw = spark.read.option("header", True).option("escape", '"').csv(path)
        else:
            raw = spark.read.parquet(path)
        typed = raw.select(*[
            F.col(name).cast("string").try_cast(kind).alias(name) if kind in ("long", "int")
            else F.col(name).cast(kind).alias(name)
            for name, kind in (part.split() for part in SCHEMA.split(", "))
        ])
    except AnalysisException:
        return spark.createDataFrame([], SCHEMA)
    # Duplicate ids would multiply events; the largest entry is kept.
    rest = [c for c in typed.columns if c != "id"]
    return (typed.where(F.col("id").isNotNull()).groupBy("id")
            .agg(F.max(F.struct(*rest)).alias("_r")).select("id", "_r.*"))
