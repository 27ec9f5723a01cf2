"""Sorting, top-N and repeatable samples.

``row_number() <= n`` is pushed below the shuffle by Spark (window group limit), so a
band or cohort with any share of the rows sends at most n rows per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from clickcohort.operators.tallies import KEY


def by_botness(scored: DataFrame, key: str = KEY) -> DataFrame:
    return scored.orderBy(F.desc("botness"), key)


def top_of_band(scored: DataFrame, band: str = "High", n: int = 50, key: str = KEY) -> DataFrame:
    return by_botness(scored.where(F.col("risk_band") == band), key).limit(n)


def top_per_band(scored: DataFrame, n: int = 50, key: str = KEY) -> DataFrame:
    """The ``n`` highest scores of each band, with their rank."""
    order = Window.partitionBy("risk_band").orderBy(F.desc("botness"), key)
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def top_ua_by_ip_diversity(features: DataFrame, n: int = 10) -> DataFrame:
    columns = ["ua_full", "ua_full_ip_diversity", "ua_full_ip_diversity_ratio"]
    return (features.select(*columns).na.drop(subset=columns).distinct()
            .orderBy(F.desc("ua_full_ip_diversity"), "ua_full",
                     F.desc("ua_full_ip_diversity_ratio")).limit(n))


def sample_rows(events: DataFrame, k: int = 3, seed: int = 42, key: str = KEY) -> DataFrame:
    """min(k, n) rows of each cohort: those whose SHA-1 of ``seed:row_id`` is smallest.

    The order is the same on every run, in any partitioning and in any engine that has SHA-1, as
    long as ids differ; rows of one id, or without one, rank in any order. Spark keeps k rows a
    cohort in each task before the shuffle, so a cohort of any size sends few.
    """
    draw = F.sha1(F.concat(F.lit(f"{seed}:"), F.col("row_id").cast("string")))
    order = Window.partitionBy(key).orderBy(draw, "row_id")
    return (events.withColumn("sample_no", F.row_number().over(order))
            .where(F.col("sample_no") <= k))
