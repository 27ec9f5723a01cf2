"""Measures that depend on how often each value occurs in a cohort.

Shape of every plan here: count (cohort, kind, value) first, so copies of a value
collapse map-side and the shuffle is spread by value, and only then come back to
the cohort. No task ever holds the raw rows, or all values, of one cohort.

The second step counts how many values share an occurrence count. Counts of k
different sizes need at least k(k+1)/2 events, so a cohort of N events has at
most sqrt(2N) such rows: that is the bound on the one array collected here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from clickcohort.operators.ladder import read_day_text, sweep_of_days
from clickcohort.operators.tallies import KEY

TOP_SIGNATURES = 3
# Fixed values of the repetition rules.
REPEAT_FLOOR = 10
PATTERN_MIN_EVENTS = 10
HIGH_REPETITION_SHARE = 0.5
LOW_DIVERSITY_VALUES = 5
LOW_DIVERSITY_EVENTS = 100

_FIELD = "\u0001"

IDENTITY = ("date", "site", "partner", "ip", "user_agent",
            "user_agent_type", "device_type", "os_type")


def _kind_columns(columns: Sequence[str]) -> dict[str, Column]:
    """Value text per kind, for the kinds whose source columns exist."""
    have = set(columns)
    kinds: dict[str, Column] = {}
    if "payload_signature" in have:
        kinds["signature"] = F.col("payload_signature")
    ends = [F.coalesce(F.col(c), F.lit("")) if c in have else F.lit("")
            for c in ("origin", "destination")]
    kinds["route"] = F.concat(ends[0], F.lit(_FIELD), ends[1])
    for kind, source in (("dep_date", "dep_date"), ("session", "session_id"),
                         ("ua_type", "user_agent_type"), ("device", "device_type"),
                         ("orders", "num_orders")):
        if source in have:
            kinds[kind] = F.col(source).cast("string")
    return kinds


def value_counts_by_kind(events: DataFrame, kinds: dict[str, Column], key: str = KEY) -> DataFrame:
    """(cohort, kind, value) -> n, all kinds in one pass and one shuffle."""
    pairs = F.array(*[
        F.struct(F.lit(kind).alias("kind"), value.alias("value"))
        for kind, value in kinds.items()
    ])
    return (
        events.select(key, F.explode(pairs).alias("_kv"))
        .select(key, "_kv.kind", "_kv.value")
        .groupBy(key, "kind", "value")
        .agg(F.count("*").alias("n"))
    )


def frequency_features(events: DataFrame, kinds: Sequence[str] | None = None,
                       patterns: bool = False, key: str = KEY, ladder: bool = False,
                       distinct_dates: bool = False) -> DataFrame:
    """Repetition, diversity and session measures of each cohort.

    With ``ladder``, the sweeps of ladder.py too, from the same counted departure dates.
    """
    available = _kind_columns(events.columns)
    if kinds is not None:
        available = {k: v for k, v in available.items() if k in kinds}
    ladder = ladder and "dep_date" in available
    kind, n, m = F.col("kind"), F.col("n"), F.col("m")
    counted = value_counts_by_kind(events, available, key)
    # Values are told apart no further than needed: signatures by how often they occur,
    # departure dates by the day they name.
    groups = [key, "kind", F.col("value").isNull().alias("missing"),
              F.when(kind == "signature", n).alias("size")]
    if ladder:
        day, bad = read_day_text(F.col("value"))
        groups += [F.when(kind == "dep_date", day).alias("day"),
                   ((kind == "dep_date") & bad).alias("bad")]
    profile = counted.groupBy(*groups).agg(F.count("*").alias("m"), F.sum("n").alias("rows"))
    first_kind = next(iter(available))
    aggregates = [
        F.coalesce(F.sum(F.when(kind == first_kind, F.col("rows"))), F.lit(0)).alias("_events")
    ]
    for name in available:
        known = (kind == name) & ~F.col("missing")
        aggregates.append(
            F.coalesce(F.sum(F.when(known, m)), F.lit(0)).alias(f"_distinct_{name}"))
        if name == "signature":
            size = F.col("size")
            aggregates += [
                F.coalesce(F.max(F.when(known, size)), F.lit(0)).alias("_top"),
                F.coalesce(F.sum(F.when(known & (size >= REPEAT_FLOOR), m)), F.lit(0))
                .alias("num_exact_repeats_ge_10"),
                F.coalesce(F.sum(F.when(known, (size - 1) * m)), F.lit(0)).alias("_repeats"),
                F.collect_list(F.when(known, F.struct(size.alias("n"), "m"))).alias("_sizes"),
            ]
    outputs = _outputs(available, patterns, wanted=kinds)
    if ladder:
        # One entry a calendar date, whatever the number of events.
        aggregates.append(F.sort_array(F.collect_list(F.when(
            kind == "dep_date", F.struct("day", "bad", "rows")))).alias("_days"))
        outputs += sweep_of_days(F.col("_days"), distinct_dates)
    return profile.groupBy(key).agg(*aggregates).select(key, *outputs)


def _outputs(kinds: dict[str, Column], patterns: bool,
             wanted: Sequence[str] | None) -> list[Column]:
    def asked(kind: str) -> bool:
        return wanted is None or kind in wanted

    def distinct(kind: str, default: int = 0) -> Column:
        column = F.col(f"_distinct_{kind}") if kind in kinds else F.lit(default)
        return column.cast("long")

    events = F.col("_events")
    outputs: list[Column] = []
    if asked("signature"):
        if "signature" in kinds:
            largest = F.flatten(F.transform(
                F.slice(F.sort_array("_sizes", asc=False), 1, TOP_SIGNATURES),
                lambda s: F.array_repeat(s["n"], F.least(s["m"], F.lit(TOP_SIGNATURES)).cast("int")),
            ))
            top_share = F.col("_top") / events
            outputs += [
                distinct("signature").alias("num_signatures"),
                top_share.alias("top_signature_share"),
                F.col("num_exact_repeats_ge_10"),
                (F.col("_repeats") / events).alias("repeat_ratio"),
            ]
            for rank in range(1, TOP_SIGNATURES + 1):
                count = F.get(largest, F.lit(rank - 1))
                outputs += [count.alias(f"top_sig_{rank}_count"),
                            (count / events * 100).alias(f"top_sig_{rank}_pct")]
        else:
            top_share = F.lit(0.0)
            outputs += [F.lit(0).cast("long").alias("num_signatures"),
                        F.lit(0.0).alias("top_signature_share"),
                        F.lit(0).cast("long").alias("num_exact_repeats_ge_10"),
                        F.lit(0.0).alias("repeat_ratio")]
        if patterns:
            enough = events >= PATTERN_MIN_EVENTS
            few_values = (distinct("signature") < LOW_DIVERSITY_VALUES) & (
                events >= LOW_DIVERSITY_EVENTS)
            outputs += [
                (enough & (top_share > HIGH_REPETITION_SHARE)).cast("double")
                .alias("anomaly_high_repetition"),
                (enough & few_values).cast("double").alias("anomaly_low_diversity"),
                F.lit(0.0).alias("anomaly_burst_pattern"),
            ]
    if asked("route"):
        outputs.append(distinct("route").alias("od_unique"))
    if asked("dep_date"):
        outputs.append(distinct("dep_date").alias("dep_dates_unique"))
    if asked("session"):
        outputs += [distinct("session").alias("unique_sessions"),
                    (distinct("session") / events).alias("sessions_per_event")]
    if asked("ua_type"):
        outputs.append(distinct("ua_type", 1).alias("ua_type_diversity"))
    if asked("device"):
        outputs.append(distinct("device", 1).alias("device_diversity"))
    if asked("orders"):
        outputs.append(distinct("orders").alias("_order_values"))
    return outputs


def identity_counts(events: DataFrame, identity: Sequence[str] = IDENTITY,
                    key: str = KEY) -> DataFrame:
    """(cohort, its identity columns, full user agent) -> n, first_row: as many rows as cohorts
    have agents. It feeds the leading values, the sizes of cohorts and the day-wide look-ups."""
    names = [c for c in (*identity, "user_agent_full") if c in events.columns]
    return events.groupBy(key, *names).agg(
        F.count("*").alias("n"), F.min("row_id").alias("first_row"))


def leading_values(events: DataFrame, identity: Sequence[str] = IDENTITY,
                   min_events: int = 1, key: str = KEY) -> DataFrame:
    """Columns of the first row of each cohort, and its most common full user agent.

    "First" is the smallest ``row_id``. Ties for the most common go to the smallest
    text. Both work on counted values, not on rows. Cohorts with fewer than
    ``min_events`` events are left out.
    """
    return leading_of_counts(identity_counts(events, identity, key), identity, min_events, key)


def leading_of_counts(counts: DataFrame, identity: Sequence[str] = IDENTITY,
                      min_events: int = 1, key: str = KEY) -> DataFrame:
    """``leading_values`` of a table of ``identity_counts``."""
    have = [c for c in identity if c in counts.columns]
    has_full = "user_agent_full" in counts.columns
    full = F.col("user_agent_full").cast("string") if has_full else F.lit(None).cast("string")
    by_agent = counts.groupBy(key, full.alias("_agent")).agg(
        F.sum("n").alias("n"), F.min("first_row").alias("first_row"),
        F.min_by(F.struct(*have) if have else F.lit(0), "first_row").alias("_who"))
    aggregates = [F.min_by("_who", "first_row").alias("_who"), F.sum("n").alias("_events")]
    outputs = [F.col(f"_who.{c}").cast("string").alias(c) for c in have]
    if has_full:
        known = F.col("_agent").isNotNull()
        aggregates += [
            F.min_by("_agent", F.when(known, F.struct((-F.col("n")).alias("n"), "_agent")))
            .alias("_full"),
            F.max(F.when(known, F.col("n"))).alias("_full_n"),
        ]
        outputs += [
            F.coalesce("_full", F.lit("Unknown")).alias("ua_full"),
            F.coalesce(F.col("_full_n") / F.col("_events"), F.lit(0.0))
            .alias("ua_full_mode_share"),
        ]
    grouped = by_agent.groupBy(key).agg(*aggregates).where(F.col("_events") >= min_events)
    return grouped.select(key, *outputs)


def order_value_outputs(frame: DataFrame) -> DataFrame:
    """Finish the order block once totals and the distinct count stand side by side."""
    some = F.col("total_orders") > 0
    values = F.coalesce("_order_values", F.lit(0)).cast("long")
    return frame.withColumns({
        "unique_order_values": F.when(some, values).otherwise(F.lit(0).cast("long")),
        "all_same_orders": F.when(some, values == 1).otherwise(F.lit(True)),
    }).drop("_order_values")
