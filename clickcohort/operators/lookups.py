"""Day-wide measures looked up for each cohort, and the joins that do it.

Distinct counts are written as two group-bys. A single ``countDistinct`` shuffles
all distinct values of a key to one task; the two steps spread them by value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def distinct_count(frame: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Number of different non-null ``value`` per ``keys``; keys without any are absent."""
    return (
        frame.where(F.col(value).isNotNull()).select(*keys, value).distinct()
        .groupBy(*keys).agg(F.count("*").alias(name))
    )


def ua_ip_diversity(events: DataFrame) -> DataFrame:
    """Distinct addresses per (date, full user agent), over all events of the day."""
    return distinct_count(events, ["date", "user_agent_full"], "ip", "ip_diversity")


def add_ua_ip_diversity(cohorts: DataFrame, events: DataFrame) -> DataFrame:
    """Look up the modal full user agent of each cohort.

    ``cohorts`` needs date, ua_full and ua_full_mode_share. Its rows are shuffled by
    user agent, so pass narrow ones; a user agent common to many cohorts is left to
    the skew join of adaptive execution.
    """
    per_agent = ua_ip_diversity(events).withColumnRenamed("user_agent_full", "ua_full")
    per_day = distinct_count(events, ["date"], "ip", "_day_ips")
    # A cohort without any full user agent (share 0) counts as one address.
    known = F.col("ua_full_mode_share") > 0
    found = F.when(known, F.coalesce("ip_diversity", F.lit(1))).otherwise(F.lit(1)).cast("long")
    return (
        cohorts.join(per_agent, ["date", "ua_full"], "left")
        .join(F.broadcast(per_day), "date", "left")  # one row per calendar day
        .withColumns({
            "ua_full_ip_diversity": found,
            "ua_full_ip_diversity_ratio": F.when(
                known, F.coalesce(F.try_divide(found, F.col("_day_ips")), F.lit(0.0))
            ).otherwise(F.lit(0.0)),
        })
        .drop("ip_diversity", "_day_ips")
    )


def ua_churn(events: DataFrame) -> DataFrame:
    """Distinct user agents per (date, address)."""
    return distinct_count(events, ["date", "ip"], "user_agent", "ua_churn_per_ip_day")


def add_ua_churn(cohorts: DataFrame, events: DataFrame) -> DataFrame:
    joined = cohorts.join(ua_churn(events), ["date", "ip"], "left")
    return joined.withColumn(
        "ua_churn_per_ip_day", F.coalesce("ua_churn_per_ip_day", F.lit(1)).cast("long"))
