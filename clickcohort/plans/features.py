"""Event table to one row per cohort.

The events are read three times: for the cohorts and their agents, for the values they hold, each
counted once, and for what needs rows or their order. Each pass shuffles its own columns once to
the cohort, or, when a cohort is too large for one task, combines them map-side and spreads them by
value (see operators/layout.py). The results are then joined at cohort size, where all of them are
already partitioned by the key. Small cohorts are dropped after aggregation instead of by a join on
the events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickcohort.functions.distribution import HOUR_COLUMNS
from clickcohort.operators.frequency import (
    IDENTITY, frequency_features, identity_counts, leading_of_counts, order_value_outputs,
)
from clickcohort.operators.ingest import with_row_id
from clickcohort.operators.layout import by_cohort, find_hot
from clickcohort.operators.lookups import add_ua_churn, add_ua_ip_diversity
from clickcohort.operators.sequence import sequence_and_tallies
from clickcohort.operators.tallies import KEY
from clickcohort.params import Params
from clickcohort.session import ensure_checkpoint_dir

FEATURE_ORDER = (
    KEY, *IDENTITY,
    "ua_full", "ua_full_mode_share", "ua_full_ip_diversity", "ua_full_ip_diversity_ratio",
    *HOUR_COLUMNS,
    "hourly_entropy", "hourly_gini", "night_share",
    "gap_p50", "gap_p95", "gap_p95_over_p50", "max_run_lt_1s", "share_lt_2s",
    "schedule_regular_times", "schedule_regularity_strength",
    "first_timestamp", "last_timestamp", "duration_hours",
    "num_signatures", "top_signature_share", "num_exact_repeats_ge_10", "repeat_ratio",
    "od_unique", "dep_dates_unique", "ladder_sweep", "ladder_sweep_count",
    "top_sig_1_count", "top_sig_1_pct", "top_sig_2_count", "top_sig_2_pct",
    "top_sig_3_count", "top_sig_3_pct",
    "http11_share", "http2_share", "http3_share", "http_unknown_share",
    "cookie_rate", "referrer_rate", "ua_churn_per_ip_day",
    "ua_type_diversity", "is_bot_ua_type", "is_application_ua_type",
    "device_diversity", "is_mobile_device",
    "unique_sessions", "sessions_per_event", "n_events",
    "ok2xx_rate", "client4xx_rate", "server5xx_rate", "error_bursts",
    "total_orders", "orders_per_event", "conversion_rate", "events_with_orders",
    "events_without_orders", "order_ratio", "unique_order_values",
    "max_orders_per_event", "min_orders_per_event", "all_same_orders",
    "only_zero_or_one_orders", "order_variance",
)


def cohort_features(events: DataFrame, params: Params = Params()) -> DataFrame:
    """All day features of cohorts with at least ``params.min_events`` events.

    Absent source columns give the defaults of their block.
    """
    events = with_row_id(events.where(F.col(KEY).isNotNull()))
    have = set(events.columns)
    # Scan 1: cohorts and their agents, written once for sizes, names and day-wide look-ups.
    ensure_checkpoint_dir(events.sparkSession)
    agents = identity_counts(events).checkpoint()
    hot = find_hot(agents, params.hot_cohort_rows, count="n")
    who = leading_of_counts(agents, min_events=params.min_events)
    if {"user_agent_full", "ip", "date"} <= have:
        who = add_ua_ip_diversity(who, agents)
    if {"ip", "user_agent", "date"} <= have:
        who = add_ua_churn(who, agents)
    else:
        who = who.withColumn("ua_churn_per_ip_day", F.lit(1).cast("long"))
    # Scan 2: all counted values. Scan 3: everything that needs rows or their order.
    counted = by_cohort(events, hot, lambda e: frequency_features(
        e, ladder=True, distinct_dates=params.ladder_distinct_dates))
    out = sequence_and_tallies(events, params, KEY, hot).where(
        F.col("n_events") >= params.min_events)
    out = order_value_outputs(_with_order_values(
        out.join(who, KEY, "left").join(counted, KEY, "left")))
    if "dep_date" not in have:
        out = out.withColumns({"ladder_sweep": F.lit(False),
                               "ladder_sweep_count": F.lit(0).cast("long")})
    return out.select(*[c for c in FEATURE_ORDER if c in out.columns])


def _with_order_values(frame: DataFrame) -> DataFrame:
    if "_order_values" in frame.columns:
        return frame
    return frame.withColumn("_order_values", F.lit(0))
