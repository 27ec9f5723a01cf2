"""The four stages of a day, chained through Parquet datasets partitioned by date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickcohort.operators.history import (
    IDENTITY, add_ewma, jaccard_vs_previous_day, read_history, signature_table,
)
from clickcohort.operators.iforest import Forest, fit_forest, iso_scores
from clickcohort.operators.ingest import ingest
from clickcohort.operators.scoring import add_scores
from clickcohort.params import Params
from clickcohort.plans.features import cohort_features
from clickcohort.plans.reports import write_reports
from clickcohort.sources.delimited import (
    address_table, id_columns, read_csv, read_exports, resolve_ids,
)
from clickcohort.sources.lake import read_day, write_day, write_model


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def ingest_file(spark: SparkSession, csv: str, date: str, root: str, ip_csv: str | None = None,
                dimension: DataFrame | None = None, params: Params = Params(),
                multi_line: bool = True) -> DataFrame:
    """One CSV, optionally with addresses; every row is kept."""
    raw = read_csv(spark, csv, multi_line)
    addresses = None
    if ip_csv is not None and _exists(spark, ip_csv):
        raw, addresses = resolve_ids(raw), address_table(read_csv(spark, ip_csv, multi_line))
    elif len(id_columns(raw)) > 1:
        # A booking export without addresses still has the agent's id in its first ID column.
        raw = resolve_ids(raw)
    events = ingest(raw, date, addresses, dimension, "left", params)
    write_day(events, f"{root}/events", date=date)
    return read_day(spark, f"{root}/events", date)


def ingest_folder(spark: SparkSession, folder: str, date: str, root: str,
                  dimension: DataFrame | None = None, params: Params = Params(),
                  multi_line: bool = True) -> DataFrame:
    """All exports of a folder; only rows with a known address are kept."""
    bookings, addresses = read_exports(spark, folder, multi_line)
    events = ingest(bookings, date, addresses, dimension, "inner", params)
    write_day(events, f"{root}/events", date=date)
    return read_day(spark, f"{root}/events", date)


def build_features(spark: SparkSession, date: str, root: str,
                   params: Params = Params()) -> DataFrame:
    """Features of a stored day, compared with the days stored before it."""
    events = read_day(spark, f"{root}/events", date)
    write_day(signature_table(events), f"{root}/signatures", date=date)
    features = cohort_features(events, params)
    history = None
    if _exists(spark, f"{root}/features"):
        history = read_history(spark, f"{root}/features", date, params.lookback_days)
    if history is not None:
        features = add_ewma(features, history, params)
        # The previous day is the last one with features.
        last = history.agg(F.max("date")).first()[0]
        both = [d for d in (last, date) if _exists(spark, f"{root}/signatures/date={d}")]
        signatures = spark.read.option("basePath", f"{root}/signatures").parquet(
            *[f"{root}/signatures/date={d}" for d in both]).withColumn(
            "date", F.col("date").cast("string"))
        features = jaccard_vs_previous_day(features, signatures.select(
            "date", *IDENTITY, "payload_signature"))
    write_day(features, f"{root}/features", date=date)
    return read_day(spark, f"{root}/features", date)


def score_day(spark: SparkSession, date: str, root: str, params: Params = Params(),
              orientation: str = "normality") -> DataFrame:
    """Scores of a stored day. They go to their own dataset, so features stay as
    they are for later days and a rerun gives the same result."""
    features = read_day(spark, f"{root}/features", date)
    forest = fit_forest(features, params=params)
    if forest is not None:
        write_model(forest, f"{root}/models/date={date}")
    scored = add_scores(features, iso_scores(features, forest, orientation), params)
    write_day(scored, f"{root}/scores", date=date)
    return read_day(spark, f"{root}/scores", date)


def load_model(spark: SparkSession, root: str, date: str) -> Forest:
    return Forest.from_table(spark.read.parquet(f"{root}/models/date={date}"))


def run_day(spark: SparkSession, date: str, root: str, folder: str | None = None,
            csv: str | None = None, ip_csv: str | None = None,
            dimension: DataFrame | None = None, params: Params = Params(),
            multi_line: bool = True) -> str:
    """ingest, features, scores, reports; returns the report folder."""
    if (folder is None) == (csv is None):
        raise ValueError("give either a folder of exports or one csv")
    if folder is not None:
        events = ingest_folder(spark, folder, date, root, dimension, params, multi_line)
    else:
        events = ingest_file(spark, csv, date, root, ip_csv, dimension, params, multi_line)
    build_features(spark, date, root, params)
    scored = score_day(spark, date, root, params)
    return write_reports(scored, date, f"{root}/reports", events, params)
