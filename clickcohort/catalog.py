"""Named queries over the driver's tables: one per operator or group of operators.

Each takes (spark, sf_dir) and returns a DataFrame over whole tables. Doubles are
rounded to six places so that two engines can be compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickcohort import adapters
from clickcohort.adapters import address_log, click_events, raw_bookings, robot_events, table
from clickcohort.functions.signature import jaccard_arrays, payload_signature
from clickcohort.operators import (
    frequency, history, iforest, ingest as ingest_ops, ladder, lookups, profile, ranking, scoring,
    sequence,
)
from clickcohort.operators.tallies import KEY, min_size_filter, tallies
from clickcohort.params import Params
from clickcohort.plans import reports
from clickcohort.plans.features import cohort_features
from clickcohort.session import ensure_checkpoint_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

JOB_DATE = "2024-01-31"
COOKIE_TEXTS = ("true", " TRUE ", "1", "t", "Yes", "no", "0", "false", "", "nan", "2", None)
STATS_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def comparable(frame: DataFrame) -> DataFrame:
    """Rounded doubles; instants as microseconds."""
    def cell(name: str, kind: str):
        if kind in ("double", "float"):
            # The nudge makes exact halves come out alike on both engines, and adding
            # zero turns -0.0 into 0.0.
            return (F.round(F.col(name) + F.lit(1e-9), 6) + F.lit(0.0)).alias(name)
        if kind == "timestamp":
            return F.unix_micros(name).alias(name)
        return F.col(name)
    return frame.select(*[cell(name, kind) for name, kind in frame.dtypes])


def few_cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events in fewer and longer cohorts."""
    return click_events(spark, sf_dir, ips=5, agents=2)


# -- ingest --------------------------------------------------------------------

@query
def ingest_normalize(spark, sf_dir):
    events = ingest_ops.ingest(raw_bookings(spark, sf_dir), JOB_DATE,
                               dimension=adapters.agents(spark))
    return comparable(events.select(
        "row_id", "timestamp", "site", "partner", "origin", "journey_type", "dep_date", "ret_date",
        "pax_config", "cabin", "stops", "ip", "user_agent", "num_orders", "status_code",
        "cookie_present", "http_version", "hour", "minute", "day_of_week", "has_order", KEY,
        "payload_signature"))


@query
def ingest_matched(spark, sf_dir):
    events = ingest_ops.ingest(raw_bookings(spark, sf_dir), JOB_DATE, address_log(spark, sf_dir),
                               adapters.agents(spark), ip_join="inner")
    return comparable(events.select(
        "row_id", "ip", "partner", "num_adults", "num_infants", "stops", "num_orders",
        "has_order", KEY))


@query
def ip_join_left(spark, sf_dir):
    return ingest_ops.join_addresses(
        raw_bookings(spark, sf_dir), address_log(spark, sf_dir), "left").select("row_id", "ip")


@query
def ip_join_inner(spark, sf_dir):
    return ingest_ops.join_addresses(
        raw_bookings(spark, sf_dir), address_log(spark, sf_dir), "inner").select("row_id", "ip")


@query
def ip_join_grid(spark, sf_dir):
    """Every click with two addresses goes over a grid of tasks."""
    return ingest_ops.join_addresses(
        raw_bookings(spark, sf_dir), address_log(spark, sf_dir), "left",
        hot_click_rows=1).select("row_id", "ip")


@query
def ip_match_rate(spark, sf_dir):
    raw = raw_bookings(spark, sf_dir)
    joined = ingest_ops.join_addresses(raw, address_log(spark, sf_dir), "inner")
    return comparable(ingest_ops.match_statistics(raw, joined))


@query
def ua_enrich(spark, sf_dir):
    events = ingest_ops.enrich_user_agents(raw_bookings(spark, sf_dir), adapters.agents(spark))
    return events.select("row_id", "user_agent", "user_agent_type", "device_type", "os_type",
                         "user_agent_full")


@query
def payload_signatures(spark, sf_dir):
    events = click_events(spark, sf_dir).drop("payload_signature")
    return events.select("row_id", payload_signature(events.columns).alias("payload_signature"))


@query
def dq_ingest(spark, sf_dir):
    events = ingest_ops.ingest(raw_bookings(spark, sf_dir), JOB_DATE, address_log(spark, sf_dir),
                               adapters.agents(spark))
    return comparable(ingest_ops.ingest_quality(
        events, columns=["timestamp", "ret_date", "referrer", "session_id"]))


@query
def dq_issues(spark, sf_dir):
    events = ingest_ops.ingest(raw_bookings(spark, sf_dir), JOB_DATE, address_log(spark, sf_dir),
                               adapters.agents(spark))
    params = Params(min_events=2000)
    return ingest_ops.quality_issues(
        ingest_ops.ingest_quality(events, params, columns=["timestamp"]), params)


@query
def cookie_texts(spark, sf_dir):
    """Spellings of yes and no, blanks and nulls in the cookie column of an export."""
    raw = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("row_id"),
        F.element_at(F.array(*[F.lit(v) for v in COOKIE_TEXTS]),
                     (F.col("event_id") % len(COOKIE_TEXTS) + 1).cast("int"))
        .alias("cookie_present"))
    return ingest_ops.normalize_columns(raw).select("row_id", "cookie_present")


@query
def ingest_totals(spark, sf_dir):
    return ingest_ops.ingest_statistics(click_events(spark, sf_dir))


# -- cohort features -------------------------------------------------------------

@query
def cohort_min_size(spark, sf_dir):
    return min_size_filter(click_events(spark, sf_dir), 10).select("row_id", KEY)


@query
def hourly_hist(spark, sf_dir):
    frame = tallies(click_events(spark, sf_dir), ["time"])
    return comparable(frame.select(KEY, *[c for c in frame.columns if c.startswith("hourly_hist")]))


@query
def hourly_entropy_gini(spark, sf_dir):
    return comparable(tallies(click_events(spark, sf_dir), ["time"])
                      .select(KEY, "hourly_entropy", "hourly_gini"))


@query
def night_share(spark, sf_dir):
    return comparable(tallies(click_events(spark, sf_dir), ["time"])
                      .select(KEY, "n_events", "night_share"))


@query
def active_span(spark, sf_dir):
    return comparable(tallies(click_events(spark, sf_dir), ["time"])
                      .select(KEY, "first_timestamp", "last_timestamp", "duration_hours"))


@query
def schedule_regularity(spark, sf_dir):
    return comparable(tallies(click_events(spark, sf_dir), ["time"])
                      .select(KEY, "schedule_regular_times", "schedule_regularity_strength"))


@query
def gap_stats(spark, sf_dir):
    return comparable(sequence.sequence_features(click_events(spark, sf_dir))
                      .select(KEY, "gap_p50", "gap_p95", "gap_p95_over_p50", "share_lt_2s"))


@query
def gap_stats_in_pieces(spark, sf_dir):
    """Cohorts of more than 30 events are cut into pieces."""
    return comparable(sequence.sequence_features(
        few_cohorts(spark, sf_dir), Params(hot_cohort_rows=30))
        .select(KEY, "gap_p50", "gap_p95", "gap_p95_over_p50", "share_lt_2s"))


@query
def runs_in_pieces(spark, sf_dir):
    return sequence.sequence_features(
        few_cohorts(spark, sf_dir), Params(hot_cohort_rows=30)).select(
        KEY, "max_run_lt_1s", "error_bursts")


@query
def max_run_lt(spark, sf_dir):
    return sequence.sequence_features(few_cohorts(spark, sf_dir)).select(KEY, "max_run_lt_1s")


@query
def error_bursts(spark, sf_dir):
    return sequence.sequence_features(few_cohorts(spark, sf_dir)).select(KEY, "error_bursts")


@query
def ladder_sweep(spark, sf_dir):
    return ladder.ladder_sweep(click_events(spark, sf_dir))


@query
def ladder_sweep_distinct(spark, sf_dir):
    return ladder.ladder_sweep(click_events(spark, sf_dir), distinct_dates=True)


@query
def orders_ladder(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn(
        "day", F.to_date("o_orderdate").cast("string"))
    return ladder.ladder_sweep(orders, "day", key="o_custkey")


@query
def signature_stats(spark, sf_dir):
    return comparable(frequency.frequency_features(click_events(spark, sf_dir), ["signature"])
                      .select(KEY, "num_signatures", "top_signature_share",
                              "num_exact_repeats_ge_10", "repeat_ratio"))


@query
def pattern_flags(spark, sf_dir):
    frame = frequency.frequency_features(few_cohorts(spark, sf_dir), ["signature"], patterns=True)
    return comparable(frame.select(KEY, *[c for c in frame.columns if c.startswith("anomaly")]))


@query
def top_signatures(spark, sf_dir):
    frame = frequency.frequency_features(few_cohorts(spark, sf_dir), ["signature"])
    return comparable(frame.select(KEY, *[c for c in frame.columns if c.startswith("top_sig_")]))


@query
def route_diversity(spark, sf_dir):
    return frequency.frequency_features(click_events(spark, sf_dir), ["route", "dep_date"])


@query
def session_volume(spark, sf_dir):
    return comparable(frequency.frequency_features(click_events(spark, sf_dir), ["session"]))


@query
def client_diversity(spark, sf_dir):
    events = click_events(spark, sf_dir)
    return tallies(events, ["client_flags"]).drop("n_events").join(
        frequency.frequency_features(events, ["ua_type", "device"]), KEY)


@query
def http_shares(spark, sf_dir):
    return comparable(tallies(click_events(spark, sf_dir), ["http"]).drop("n_events"))


@query
def hygiene(spark, sf_dir):
    return comparable(tallies(click_events(spark, sf_dir), ["hygiene"]).drop("n_events"))


@query
def status_rates(spark, sf_dir):
    return comparable(tallies(click_events(spark, sf_dir), ["status"]).drop("n_events"))


@query
def order_features(spark, sf_dir):
    events = click_events(spark, sf_dir)
    joined = tallies(events, ["orders"]).drop("n_events").join(
        frequency.frequency_features(events, ["orders"]), KEY)
    return comparable(frequency.order_value_outputs(joined))


@query
def ua_churn(spark, sf_dir):
    return lookups.ua_churn(click_events(spark, sf_dir, ips=50))


@query
def ua_full_diversity(spark, sf_dir):
    events = click_events(spark, sf_dir)
    return comparable(lookups.add_ua_ip_diversity(frequency.leading_values(events), events).select(
        KEY, "ua_full", "ua_full_mode_share", "ua_full_ip_diversity",
        "ua_full_ip_diversity_ratio"))


@query
def cohort_identity(spark, sf_dir):
    return frequency.leading_values(click_events(spark, sf_dir)).select(KEY, *frequency.IDENTITY)


@query
def all_cohort_features(spark, sf_dir):
    return comparable(cohort_features(click_events(spark, sf_dir)))


@query
def features_of_large_cohorts(spark, sf_dir):
    """The same in the layout for cohorts too large for a task."""
    events = click_events(spark, sf_dir, spread=True)
    return comparable(cohort_features(events, Params(hot_cohort_rows=20)))


# -- ad-hoc analysis ---------------------------------------------------------------

@query
def order_audit(spark, sf_dir):
    return comparable(profile.order_audit(click_events(spark, sf_dir)))


@query
def order_audit_summary(spark, sf_dir):
    return profile.order_audit_summary(profile.order_audit(few_cohorts(spark, sf_dir)))


@query
def order_audit_examples(spark, sf_dir):
    audit = profile.order_audit(click_events(spark, sf_dir))
    return comparable(profile.order_audit_examples(audit, "only_zero_one"))


@query
def order_totals(spark, sf_dir):
    return comparable(profile.order_totals(click_events(spark, sf_dir)))


@query
def order_distribution(spark, sf_dir):
    return comparable(profile.order_distribution(click_events(spark, sf_dir)))


@query
def orders_by_ua_type(spark, sf_dir):
    return comparable(profile.orders_by(click_events(spark, sf_dir), "user_agent_type"))


@query
def orders_by_browser(spark, sf_dir):
    return comparable(profile.orders_by(click_events(spark, sf_dir), "user_agent"))


@query
def value_counts_ua(spark, sf_dir):
    return comparable(profile.value_counts(click_events(spark, sf_dir), "user_agent_type"))


@query
def value_counts_priority(spark, sf_dir):
    return comparable(profile.value_counts(table(spark, sf_dir, "orders"), "o_orderpriority", 10))


@query
def client_totals(spark, sf_dir):
    return comparable(profile.client_totals(click_events(spark, sf_dir)))


@query
def top_ua_ids(spark, sf_dir):
    return comparable(profile.top_user_agent_ids(click_events(spark, sf_dir)))


@query
def ua_distribution(spark, sf_dir):
    return profile.user_agent_distribution(
        raw_bookings(spark, sf_dir), adapters.agents(spark))


# -- whole-column statistics ----------------------------------------------------------

@query
def robust_stats(spark, sf_dir):
    return comparable(profile.robust_stats(table(spark, sf_dir, "lineitem"), STATS_COLUMNS))


def _normalized(method: str) -> Query:
    def run(spark, sf_dir):
        items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *STATS_COLUMNS)
        return comparable(profile.normalize(items, method, STATS_COLUMNS))
    return run


for _method in ("robust", "standard", "minmax"):
    QUERIES[f"normalize_{_method}"] = _normalized(_method)


@query
def correlation_pairs(spark, sf_dir):
    return comparable(profile.correlation_pairs(table(spark, sf_dir, "lineitem"), STATS_COLUMNS))


@query
def correlation_matrix(spark, sf_dir):
    return comparable(profile.correlation_matrix(
        table(spark, sf_dir, "lineitem"), STATS_COLUMNS))


@query
def high_correlation(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select(
        "l_quantity", "l_extendedprice", (F.col("l_quantity") * 2 + 1).alias("doubled"))
    return comparable(profile.correlation_pairs(items, threshold=0.85))


# -- history ------------------------------------------------------------------------

@query
def ewma_history(spark, sf_dir):
    events = click_events(spark, sf_dir)
    features = tallies(events, ["time", "hygiene"]).join(
        frequency.leading_values(events), KEY).join(
        frequency.frequency_features(events, ["signature"]), KEY)
    names = ["night_share", "top_signature_share", "hourly_entropy", "cookie_rate"]
    out = history.ewma_over_days(features, names=names)
    return comparable(out.select(KEY, *[c for c in out.columns if c.startswith("ewma_")]))


@query
def ewma_last_day(spark, sf_dir):
    """The averages as the daily run adds them: one day against the stored days before it."""
    events = click_events(spark, sf_dir)
    ensure_checkpoint_dir(spark)
    features = tallies(events, ["time", "hygiene"]).join(
        frequency.leading_values(events), KEY).join(
        frequency.frequency_features(events, ["signature"]), KEY).checkpoint()
    last = features.agg(F.max("date")).first()[0]
    past = features.where((F.col("date") < F.lit(last)) & (
        F.datediff(F.lit(last).cast("date"), F.col("date").cast("date")) <= Params().lookback_days))
    out = history.add_ewma(features.where(F.col("date") == F.lit(last)), past)
    return comparable(out.select(KEY, *[c for c in out.columns if c.startswith("ewma_")]))


@query
def ewma_first_day(spark, sf_dir):
    """A day without any earlier one keeps its own values."""
    events = click_events(spark, sf_dir)
    ensure_checkpoint_dir(spark)
    features = tallies(events, ["time", "hygiene"]).join(
        frequency.leading_values(events), KEY).join(
        frequency.frequency_features(events, ["signature"]), KEY).checkpoint()
    first = F.lit(features.agg(F.min("date")).first()[0])
    out = history.add_ewma(features.where(F.col("date") == first),
                           features.where(F.col("date") < first))
    return comparable(out.select(KEY, *[c for c in out.columns if c.startswith("ewma_")]))


@query
def ewma_nation_daily(spark, sf_dir):
    daily = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", F.to_date("o_orderdate").cast("string").alias("day"))
        .agg(F.sum("o_totalprice").alias("revenue"))
    )
    averaged = history.ewma_series(daily, ["c_nationkey"], "day", "revenue", 0.3, 30, "ewma")
    return averaged.select("c_nationkey", "day", F.round("ewma", 3).alias("ewma"))


@query
def jaccard_prev_day(spark, sf_dir):
    events = click_events(spark, sf_dir)
    cohorts = events.select(KEY, "date", *history.IDENTITY).distinct()
    return comparable(history.jaccard_vs_previous_day(
        cohorts, history.signature_table(events)).select(KEY, "jaccard_signatures_vs_prev_day"))


@query
def jaccard_sets(spark, sf_dir):
    """User agents seen on a day against those that bought: two short sets in one row."""
    daily = click_events(spark, sf_dir).groupBy("date").agg(
        F.collect_set("user_agent_full").alias("agents"),
        F.collect_set(F.when(F.col("has_order") == 1, F.col("user_agent_full"))).alias("buyers"))
    return comparable(daily.select("date", jaccard_arrays(F.col("agents"), F.col("buyers"))
                                   .alias("similarity")))


@query
def latest_day(spark, sf_dir):
    return history.latest_day(click_events(spark, sf_dir)).select("row_id", "date")


# -- scores and reports ----------------------------------------------------------------

#: A small forest of set splits (tree, node, feature, threshold, left, right, path length), which
#: the SQL equivalents spell out as CASE. Grown forests split at random.
SET_FEATURES = ["hourly_entropy", "n_events", "night_share", "top_signature_share"]
SET_ROWS = 16
SET_NODES = [
    (0, 0, 1, 10.5, 1, 2, 0.0), (0, 1, 2, 0.4505, 3, 4, 0.0), (0, 2, 0, 3.2005, 5, 6, 0.0),
    (0, 3, -1, 0.0, -1, -1, 5.5), (0, 4, -1, 0.0, -1, -1, 3.5), (0, 5, -1, 0.0, -1, -1, 4.0),
    (0, 6, -1, 0.0, -1, -1, 6.0),
    (1, 0, 2, 0.2105, 1, 2, 0.0), (1, 1, -1, 0.0, -1, -1, 2.5), (1, 2, 3, 0.1505, 3, 4, 0.0),
    (1, 3, -1, 0.0, -1, -1, 6.5), (1, 4, -1, 0.0, -1, -1, 4.5),
    (2, 0, 0, 2.4505, 1, 2, 0.0), (2, 1, -1, 0.0, -1, -1, 3.0), (2, 2, 1, 6.5, 3, 4, 0.0),
    (2, 3, -1, 0.0, -1, -1, 4.75), (2, 4, -1, 0.0, -1, -1, 5.25),
]


def set_forest(spark: SparkSession) -> iforest.Forest:
    return iforest.forest_of_nodes(spark, SET_NODES, SET_FEATURES, SET_ROWS)


def stored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features written once: scores and reports read them several times."""
    ensure_checkpoint_dir(spark)
    return cohort_features(click_events(spark, sf_dir)).checkpoint()


#: Under the default thresholds no cohort of the smallest tables is High.
LOW_THRESHOLDS = Params(thresholds={"high": 0.6, "medium": 0.4, "low": 0.25})


def scored_cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All features, rule scores, scores of the set forest, blend and bands."""
    features = stored_features(spark, sf_dir)
    scored = scoring.add_scores(features, iforest.iso_scores(features, set_forest(spark)),
                                LOW_THRESHOLDS)
    # Equal scores must rank as equal whatever the order of their additions.
    return scored.withColumn("botness", F.round("botness", 9))


def grown_scores(spark: SparkSession, sf_dir: str, params: Params = Params()) -> DataFrame:
    """All features, rule scores, scores of a grown forest, blend and bands."""
    features = stored_features(spark, sf_dir)
    forest = iforest.fit_forest(features, params=params)
    return scoring.add_scores(features, iforest.iso_scores(features, forest), params)


@query
def forest_extract(spark, sf_dir):
    """Features, rules, a grown forest, blend and bands by default parameters; no oracle, since
    the random splits are this library's own."""
    return comparable(reports.cohort_extract(grown_scores(spark, sf_dir)))


@query
def rule_score(spark, sf_dir):
    return comparable(scored_cohorts(spark, sf_dir).select(KEY, "rule_score"))


@query
def risk_bands(spark, sf_dir):
    return comparable(scored_cohorts(spark, sf_dir).select(KEY, "botness", "risk_band"))


@query
def band_counts(spark, sf_dir):
    return scoring.band_counts(scored_cohorts(spark, sf_dir))


@query
def risk_distribution(spark, sf_dir):
    return comparable(reports.risk_distribution(scored_cohorts(spark, sf_dir)))


@query
def score_statistics(spark, sf_dir):
    return comparable(scoring.score_statistics(scored_cohorts(spark, sf_dir)))


@query
def top_n_per_band(spark, sf_dir):
    return comparable(ranking.top_per_band(scored_cohorts(spark, sf_dir), 20)
                      .select("risk_band", "rank", KEY, "botness"))


@query
def top_high_cohorts(spark, sf_dir):
    return comparable(reports.display_table(scored_cohorts(spark, sf_dir), "High"))


@query
def top_medium_cohorts(spark, sf_dir):
    return comparable(reports.display_table(scored_cohorts(spark, sf_dir), "Medium"))


@query
def cohort_extract(spark, sf_dir):
    return comparable(reports.cohort_extract(scored_cohorts(spark, sf_dir)))


@query
def top_ua_ip_diversity(spark, sf_dir):
    events = click_events(spark, sf_dir)
    return comparable(ranking.top_ua_by_ip_diversity(
        lookups.add_ua_ip_diversity(frequency.leading_values(events), events)))


@query
def dq_scoring(spark, sf_dir):
    scored = scored_cohorts(spark, sf_dir)
    broken = scored.withColumn("iso_score", F.when(F.col("is_mobile_device"), F.lit(None))
                               .otherwise(F.col("iso_score") * 2))
    return scoring.scoring_issues(broken)


@query
def iforest_score(spark, sf_dir):
    """Forest scores; no oracle, since the random splits are this library's own."""
    features = stored_features(spark, sf_dir)
    return comparable(iforest.iso_scores(features, iforest.fit_forest(features)))


@query
def evidence_samples(spark, sf_dir):
    """Sampled raw rows of the top cohorts by the grown forest, High from 0.6; no oracle, since
    the sample order is a hash."""
    samples = reports.evidence_samples(
        grown_scores(spark, sf_dir, LOW_THRESHOLDS), click_events(spark, sf_dir))
    return comparable(samples.select(
        KEY, "botness_score", "risk_band", F.to_json("sample_rows").alias("sample_rows")))


#: One tree (see SET_NODES) by which a cohort with one leading signature scores 1, others 0.
LEADING_NODES = [(0, 0, 0, 0.5, 1, 2, 0.0), (0, 1, -1, 0.0, -1, -1, 3.0),
                 (0, 2, -1, 0.0, -1, -1, 6.0)]


def robot_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cohorts with robots among them, by default thresholds and a set tree."""
    ensure_checkpoint_dir(spark)
    features = cohort_features(robot_events(spark, sf_dir)).checkpoint()
    tree = iforest.forest_of_nodes(spark, LEADING_NODES, ["top_signature_share"], SET_ROWS)
    scored = scoring.add_scores(features, iforest.iso_scores(features, tree))
    return scored.withColumn("botness", F.round("botness", 9))


@query
def evidence_rows(spark, sf_dir):
    """Sampled raw rows of the top cohorts, High by the default threshold."""
    rows = reports.evidence_rows(robot_scores(spark, sf_dir), robot_events(spark, sf_dir))
    return comparable(rows.select(
        KEY, "botness_score", "risk_band", "sample_no", *[
            f"row.{c}" for c in ("row_id", "timestamp", "origin", "session_id", "referrer",
                                 "cookie_present", "status_code", "payload_signature")]))


@query
def report_rows(spark, sf_dir):
    return comparable(reports.report_rows(robot_scores(spark, sf_dir)))


@query
def report_document(spark, sf_dir):
    """The JSON report without its time stamp; no oracle, since it is one nested row."""
    document = reports.report_document(grown_scores(spark, sf_dir), JOB_DATE)
    return document.select(*[F.to_json(c).alias(c) for c in document.columns if c != "metadata"])
