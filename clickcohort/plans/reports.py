"""Report tables over scored cohorts, and their sinks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from clickcohort.operators.ranking import (
    by_botness, sample_rows, top_of_band, top_per_band, top_ua_by_ip_diversity,
)
from clickcohort.operators.scoring import BANDS, SCORES, band_counts, score_statistics
from clickcohort.operators.tallies import KEY
from clickcohort.params import Params
from clickcohort.sources.lake import write_csv, write_json

# Columns of the CSV report, in order.
EXTRACT_COLUMNS = (
    "cohort_key", "date", "site", "partner", "ip", "user_agent",
    "ua_full", "ua_full_mode_share", "ua_full_ip_diversity", "ua_full_ip_diversity_ratio",
    "rule_score", "iso_score", "botness", "risk_band",
    "n_events", "night_share", "top_signature_share", "repeat_ratio",
    "gap_p50", "max_run_lt_1s", "cookie_rate", "referrer_rate",
    "http11_share", "http2_share", "ladder_sweep", "hourly_entropy",
)

# The JSON records leave these out.
NOT_IN_RECORDS = ("date", "http11_share", "http2_share")

# Columns of the display tables.
DISPLAY_COLUMNS = ("site", "partner", "ip", "botness", "risk_band", "n_events",
                   "night_share", "top_signature_share", "ladder_sweep")

DISPLAY_ROWS = 10
EVIDENCE_COHORTS = 10


def cohort_extract(scored: DataFrame) -> DataFrame:
    """The listed columns that exist, highest botness first."""
    return by_botness(scored).select(*[c for c in EXTRACT_COLUMNS if c in scored.columns])


def cohort_records(scored: DataFrame) -> DataFrame:
    """One ``record`` struct per cohort, as the JSON report holds it."""
    fields = [c for c in EXTRACT_COLUMNS if c in scored.columns and c not in NOT_IN_RECORDS]
    return scored.select(F.col(KEY), F.struct(*fields).alias("record"))


def display_table(scored: DataFrame, band: str, n: int = DISPLAY_ROWS) -> DataFrame:
    """Top cohorts of a band with rounded values; halves round to even."""
    shown = top_of_band(scored, band, n)
    rounded = {"botness": lambda c: F.bround(c, 3),
               "night_share": lambda c: F.bround(c * 100, 1),
               "top_signature_share": lambda c: F.bround(c * 100, 1)}
    return shown.select(*[
        rounded[c](F.col(c)).alias(c) if c in rounded else F.col(c)
        for c in DISPLAY_COLUMNS if c in scored.columns
    ])


def risk_distribution(scored: DataFrame) -> DataFrame:
    """(risk_band, cohorts, pct) over all cohorts; 0 percent of nothing is 0."""
    total = scored.agg(F.count("*")).scalar()
    return band_counts(scored).withColumn(
        "pct", F.coalesce(F.try_divide(F.col("cohorts") * 100.0, total), F.lit(0.0)))


def evidence_rows(scored: DataFrame, events: DataFrame, params: Params = Params(),
                  cohorts: int = EVIDENCE_COHORTS) -> DataFrame:
    """A few raw rows of each of the top High cohorts, one row each.

    (cohort_key, botness_score, risk_band, sample_no, row); ``row`` holds all event columns.
    """
    top = top_of_band(scored, "High", cohorts).select(
        KEY, F.col("botness").alias("botness_score"), "risk_band")
    rows = events.join(F.broadcast(top.select(KEY)), KEY, "left_semi")
    sampled = sample_rows(rows, params.sample_rows, params.seed).select(
        KEY, "sample_no", F.struct(*events.columns).alias("row"))
    return sampled.join(F.broadcast(top), KEY).select(
        KEY, "botness_score", "risk_band", "sample_no", "row")


def evidence_samples(scored: DataFrame, events: DataFrame, params: Params = Params(),
                     cohorts: int = EVIDENCE_COHORTS) -> DataFrame:
    """The rows of ``evidence_rows`` nested by cohort; at most ``cohorts`` rows."""
    return evidence_rows(scored, events, params, cohorts).groupBy(
        KEY, "botness_score", "risk_band").agg(
        F.sort_array(F.collect_list(F.struct("sample_no", "row"))).alias("_rows")).select(
        KEY, "botness_score", "risk_band",
        F.transform("_rows", lambda r: r["row"]).alias("sample_rows"))


def report_rows(scored: DataFrame, params: Params = Params()) -> DataFrame:
    """What the JSON report says, one row a value: (section, rank, cohort_key, field, text, number).

    Sections are ``high_risk_cohorts`` and ``medium_risk_cohorts`` (at most ``top_n`` ranks each),
    ``statistics`` (fields like ``botness_mean``) and ``summary``, the last two without rank and
    key. Strings are in ``text``; numbers, and flags as 0 or 1, in ``number``. No cohorts:
    counts of 0 and null statistics. Reads the cohorts once whole, cut to ``top_n`` a band
    before any shuffle, and once for the four columns that are counted.
    """
    fields = [c for c in EXTRACT_COLUMNS if c in scored.columns and c not in NOT_IN_RECORDS]
    kinds = dict(scored.dtypes)

    def value(field: str, column: Column, string: bool) -> Column:
        return F.struct(
            F.lit(field).alias("field"),
            (column if string else F.lit(None)).cast("string").alias("text"),
            (F.lit(None) if string else column).cast("double").alias("number"))

    listed = top_per_band(scored.where(F.col("risk_band").isin("High", "Medium")), params.top_n)
    records = listed.select(
        F.concat(F.lower("risk_band"), F.lit("_risk_cohorts")).alias("section"),
        F.col("rank").cast("int").alias("rank"), F.col(KEY),
        F.inline(F.array(*[value(c, F.col(c), kinds[c] == "string") for c in fields])))

    measures = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    wide = {("summary", "total_cohorts"): F.count("*")}
    wide |= {("summary", f"{b.lower()}_risk_count"): F.count_if(F.col("risk_band") == b)
             for b in BANDS}
    wide |= {("statistics", f"{score}_{name}"): measure(score)
             for score in SCORES for name, measure in measures.items()}
    totals = scored.agg(*[c.alias(f"{section}_{field}") for (section, field), c in wide.items()])
    cells = totals.select(F.inline(F.array(*[
        F.struct(F.lit(section).alias("section"), F.lit(None).cast("int").alias("rank"),
                 F.lit(None).cast("string").alias(KEY),
                 value(field, F.col(f"{section}_{field}"), False).alias("_v"))
        for section, field in wide])))
    return records.unionByName(cells.select("section", "rank", KEY, "_v.*"))


def report_document(scored: DataFrame, date: str, params: Params = Params()) -> DataFrame:
    """The JSON report as one row: metadata, statistics, top cohorts, summary counts.

    Cohort lists hold at most ``top_n`` records; the counts are of all cohorts.
    """
    counts = scored.agg(F.count("*").alias("total"), *[
        F.count_if(F.col("risk_band") == b).alias(b.lower()) for b in BANDS])

    def top_records(band: str):
        records = cohort_records(top_of_band(scored, band, params.top_n))
        ordered = F.sort_array(F.collect_list(F.struct(
            (-F.col("record.botness")).alias("b"), F.col(KEY).alias("k"),
            F.col("record"))))
        return records.agg(F.transform(ordered, lambda r: r["record"])).scalar()

    stats = score_statistics(scored).agg(F.sort_array(F.collect_list(F.struct("*")))).scalar()
    config = F.struct(
        F.struct(*[F.lit(v).alias(k) for k, v in params.weights.items()]).alias("scoring_weights"),
        F.struct(*[F.lit(v).alias(k) for k, v in params.thresholds.items()])
        .alias("risk_thresholds"),
        F.lit(params.alpha_blend_iso).alias("alpha_blend"))
    return counts.select(
        F.struct(F.lit(date).alias("date"),
                 F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("generated_at"),
                 F.col("total").alias("total_cohorts"), config.alias("config")).alias("metadata"),
        stats.alias("statistics"),
        top_records("High").alias("high_risk_cohorts"),
        top_records("Medium").alias("medium_risk_cohorts"),
        F.struct(*[F.col(b.lower()).alias(f"{b.lower()}_risk_count") for b in BANDS])
        .alias("summary"),
    )


def write_reports(scored: DataFrame, date: str, folder: str, events: DataFrame | None = None,
                  params: Params = Params(), stamp: str | None = None) -> str:
    """All report tables of a day into a new folder ``{date}_{stamp}``; returns it."""
    stamp = stamp or dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d_%H%M%S")
    out = f"{folder.rstrip('/')}/{date}_{stamp}"
    write_csv(cohort_extract(scored), f"{out}/cohorts")
    write_json(report_document(scored, date, params), f"{out}/report")
    write_csv(risk_distribution(scored), f"{out}/risk_distribution", single_file=True)
    write_csv(score_statistics(scored), f"{out}/score_statistics", single_file=True)
    for band in ("High", "Medium"):
        write_csv(display_table(scored, band), f"{out}/top_{band.lower()}", single_file=True)
    if "ua_full_ip_diversity" in scored.columns:
        write_csv(top_ua_by_ip_diversity(scored), f"{out}/ua_ip_diversity", single_file=True)
    if events is not None:
        write_json(evidence_samples(scored, events, params), f"{out}/evidence_samples")
    return out


__all__ = [
    "cohort_extract", "cohort_records", "display_table", "evidence_rows", "evidence_samples",
    "report_document", "report_rows", "risk_distribution", "top_per_band", "write_reports",
]
