"""Comparison of a day's cohorts with earlier days.

A cohort is followed across days by its dateless identity. One identity has at most
one row per day, so the history collected for it is at most ``lookback_days`` rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from clickcohort.functions.distribution import ewma_last
from clickcohort.functions.signature import jaccard_from_sizes
from clickcohort.params import Params

IDENTITY = ("site", "partner", "ip", "user_agent")

# The features that are averaged over days.
EWMA_FEATURES = (
    "night_share", "top_signature_share", "gap_p50", "gap_p95",
    "hourly_entropy", "repeat_ratio", "cookie_rate", "referrer_rate",
)


def read_history(spark: SparkSession, path: str, date: str,
                 lookback_days: int = 30) -> DataFrame | None:
    """Stored features of the days before ``date``; None when there are none.

    Days may have been written with different columns.
    """
    last = dt.date.fromisoformat(date)
    days = [f"{path}/date={last - dt.timedelta(days=k)}" for k in range(lookback_days, 0, -1)]
    # Only these folders are opened, however many days the lake holds.
    there = [day for day in days if _exists(spark, day)]
    if not there:
        return None
    frame = spark.read.option("mergeSchema", True).option("basePath", path).parquet(*there)
    frame = frame.withColumn("date", F.col("date").cast("string"))
    return None if frame.isEmpty() else frame


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def _part(name: str) -> Column:
    """An identity part as the cohort key has it: null is ``unknown``."""
    return F.coalesce(F.col(name).cast("string"), F.lit("unknown"))


_PARTS = {c: f"_id_{c}" for c in IDENTITY}


def _with_parts(frame: DataFrame) -> DataFrame:
    return frame.withColumns({out: _part(c) for c, out in _PARTS.items()})


def ewma_series(frame: DataFrame, keys: Sequence[str], order: str, value: str, alpha: float,
                lookback: int, name: str) -> DataFrame:
    """Running adjusted EWMA over the last ``lookback`` non-null rows of each key.

    ``frame`` holds one row per key and day.
    """
    recent = (Window.partitionBy(*keys).orderBy(order)
              .rowsBetween(1 - lookback, Window.currentRow))
    return (
        frame.where(F.col(value).isNotNull())
        .withColumn(name, ewma_last(F.collect_list(F.col(value).cast("double")).over(recent), alpha))
    )


def add_ewma(features: DataFrame, history: DataFrame | None,
             params: Params = Params()) -> DataFrame:
    """ewma_{feature}_7d and _30d from earlier days, oldest first.

    A cohort or feature without history keeps today's value; null becomes 0. With no
    history at all no column is added.
    """
    if history is None:
        return features
    names = [f for f in EWMA_FEATURES if f in features.columns]
    stored = [f for f in names if f in history.columns]
    past = _with_parts(history).groupBy(*_PARTS.values()).agg(F.sort_array(F.collect_list(
        F.struct("date", *[F.col(f).cast("double").alias(f) for f in stored]))).alias("_past"))

    def average(feature: str, alpha: float) -> Column:
        today = F.col(feature).cast("double")
        if feature not in stored:
            return F.coalesce(today, F.lit(0.0))
        values = F.filter(F.transform("_past", lambda r: r[feature]), lambda v: v.isNotNull())
        return F.coalesce(ewma_last(values, alpha), today, F.lit(0.0))

    joined = _with_parts(features).join(past, list(_PARTS.values()), "left")
    return joined.withColumns({
        f"ewma_{f}_{label}": average(f, alpha)
        for f in names
        for label, alpha in (("7d", params.ewma_alpha_7d), ("30d", params.ewma_alpha_30d))
    }).drop("_past", *_PARTS.values())


def ewma_over_days(features: DataFrame, params: Params = Params(),
                   names: Sequence[str] = EWMA_FEATURES) -> DataFrame:
    """The same averages for every day of a multi-day feature table at once.

    The frame of a day is the ``lookback_days`` calendar days before it, today
    excluded. Unlike ``add_ewma`` this joins nothing: it is one window per identity.
    """
    day = F.datediff(F.col("date").cast("date"), F.lit("1970-01-01").cast("date"))
    frame = (Window.partitionBy(*[_part(c) for c in IDENTITY]).orderBy("_day")
             .rangeBetween(-params.lookback_days, -1))
    out = features.withColumn("_day", day)
    columns = {}
    for f in names:
        past = F.collect_list(F.col(f).cast("double")).over(frame)
        for label, alpha in (("7d", params.ewma_alpha_7d), ("30d", params.ewma_alpha_30d)):
            columns[f"ewma_{f}_{label}"] = F.coalesce(
                ewma_last(past, alpha), F.col(f).cast("double"), F.lit(0.0))
    return out.withColumns(columns).drop("_day")


def signature_table(events: DataFrame) -> DataFrame:
    """The distinct signatures of each identity and day, to be stored by date."""
    return (events.where(F.col("payload_signature").isNotNull())
            .select("date", *IDENTITY, "payload_signature").distinct())


def latest_day(history: DataFrame, date_col: str = "date") -> DataFrame:
    """Rows of the last day there is, which need not be yesterday."""
    last = history.agg(F.max(date_col)).scalar()
    return history.where(F.col(date_col) == last)


def jaccard_vs_previous_day(cohorts: DataFrame, signatures: DataFrame) -> DataFrame:
    """jaccard_signatures_vs_prev_day for each cohort row (needs date and identity).

    The previous day is the latest earlier day in ``signatures``; cohorts of the
    first day get null. Sets are compared by counting matched rows, so a cohort with
    any number of signatures stays spread over tasks.
    """
    days = signatures.select("date").distinct()
    # One row per calendar day, so one window and a broadcast are safe.
    previous = F.broadcast(days.select(
        "date", F.lag("date").over(Window.partitionBy(F.lit(0)).orderBy("date"))
        .alias("prev_date")))
    parts = list(_PARTS.values())
    keys = ["date", *parts]
    signatures = _with_parts(signatures).select(*keys, "payload_signature").distinct()
    dated = signatures.join(previous, "date")
    earlier = signatures.select(
        F.col("date").alias("prev_date"), *parts, "payload_signature",
        F.lit(True).alias("_seen"))
    today = (
        dated.join(earlier, ["prev_date", *parts, "payload_signature"], "left")
        .groupBy(*keys)
        .agg(F.count("*").alias("_today"), F.count("_seen").alias("_common"))
    )
    before = signatures.groupBy(F.col("date").alias("prev_date"), *parts).agg(
        F.count("*").alias("_before"))
    zero = F.lit(0)
    return (
        _with_parts(cohorts).join(previous, "date", "left")
        .join(today, keys, "left")
        .join(before, ["prev_date", *parts], "left")
        .withColumn(
            "jaccard_signatures_vs_prev_day",
            F.when(F.col("prev_date").isNotNull(), jaccard_from_sizes(
                F.coalesce("_common", zero), F.coalesce("_today", zero),
                F.coalesce("_before", zero))))
        .drop("_today", "_common", "_before", "prev_date", *parts)
    )
