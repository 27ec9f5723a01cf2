"""Order-free cohort measures: one hash aggregate over the events.

Every aggregate used here keeps a numeric buffer, so Spark combines map-side with
a hash table and a cohort holding any share of the rows costs one partial row per
map task in the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from clickcohort.functions.cleaning import contains_any_word
from clickcohort.functions.distribution import HOUR_COLUMNS, HOURS, entropy_bits, gini
from clickcohort.params import Params

KEY = "cohort_key"

# Minutes that mark a timetable, and the sizes the rules start at.
REGULAR_MINUTES = (0, 15, 30, 45)
REGULAR_MIN_EVENTS = 5

# HTTP version text of each share column.
HTTP_SHARES = {
    "http11_share": "1.1",
    "http2_share": "2",
    "http3_share": "3",
    "http_unknown_share": "unknown",
}

# Status code range [low, high) of each rate column.
STATUS_RANGES = {
    "ok2xx_rate": (200, 300),
    "client4xx_rate": (400, 500),
    "server5xx_rate": (500, 600),
}


class Block(NamedTuple):
    """Aggregates to compute per group, and the columns made from them.

    ``steps`` are columns that several outputs share.
    """

    aggregates: list[Column]
    outputs: list[Column]
    steps: dict[str, Column] = {}


def rate(part: Column, whole: Column, min_whole: int = 1) -> Column:
    """part / whole; 0 while ``whole`` is under ``min_whole``."""
    return F.when(whole >= min_whole, F.try_divide(part, whole)).otherwise(F.lit(0.0))


def _n() -> Column:
    return F.col("n_events")


def time_block(columns: Sequence[str], params: Params) -> Block:
    if "timestamp" not in columns:
        zero = [F.lit(0.0).alias(name) for name in HOUR_COLUMNS]
        rest = ("hourly_entropy", "hourly_gini", "night_share",
                "schedule_regularity_strength", "duration_hours")
        return Block([], zero + [F.lit(0.0).alias(name) for name in rest]
                     + [F.lit(False).alias("schedule_regular_times")])
    ts = F.col("timestamp")
    hour = F.hour(ts)
    aggregates = [F.expr(f"count_if(hour(timestamp) = {h}) AS _hour_{h:02d}") for h in HOURS]
    aggregates += [
        F.count(ts).alias("_timed"),
        F.count_if(hour.isin(*params.night_hours)).alias("_night"),
        F.count_if(F.minute(ts).isin(*REGULAR_MINUTES)).alias("_regular"),
        F.min(ts).alias("first_timestamp"),
        F.max(ts).alias("last_timestamp"),
    ]
    hours = ", ".join(f"_hour_{h:02d}" for h in HOURS)
    steps = {
        "_hist": F.expr(f"transform(array({hours}), c -> try_divide(c, _timed))"),
        "_strength": rate(F.col("_regular"), _n(), REGULAR_MIN_EVENTS),
    }
    hist = F.col("_hist")
    outputs = [F.expr(f"_hist[{h}] AS {name}") for h, name in zip(HOURS, HOUR_COLUMNS)]
    outputs += [
        entropy_bits(hist).alias("hourly_entropy"),
        gini(hist).alias("hourly_gini"),
        (F.col("_night") / _n()).alias("night_share"),
        F.col("_strength").alias("schedule_regularity_strength"),
        (F.col("_strength") > 0.5).alias("schedule_regular_times"),
        F.col("first_timestamp"),
        F.col("last_timestamp"),
        ((F.unix_micros("last_timestamp") - F.unix_micros("first_timestamp")) / 3.6e9)
        .alias("duration_hours"),
    ]
    return Block(aggregates, outputs, steps)


def http_block(columns: Sequence[str], params: Params) -> Block:
    if "http_version" not in columns:
        return Block([], [F.lit(0.0).alias(name) for name in HTTP_SHARES])
    return Block(
        [F.count_if(F.col("http_version") == text).alias(f"_{name}")
         for name, text in HTTP_SHARES.items()],
        [(F.col(f"_{name}") / _n()).alias(name) for name in HTTP_SHARES],
    )


def hygiene_block(columns: Sequence[str], params: Params) -> Block:
    aggregates, outputs = [], []
    for name, source, hit in (
        ("cookie_rate", "cookie_present", lambda c: c),
        ("referrer_rate", "referrer", lambda c: c.isNotNull()),
    ):
        if source in columns:
            aggregates.append(F.count_if(hit(F.col(source))).alias(f"_{name}"))
            outputs.append(rate(F.col(f"_{name}"), _n()).alias(name))
        else:
            outputs.append(F.lit(0.0).alias(name))
    return Block(aggregates, outputs)


def client_flag_block(columns: Sequence[str], params: Params) -> Block:
    aggregates, outputs = [], []
    tests = {
        "is_bot_ua_type": ("user_agent_type", lambda c: c == "Bot"),
        "is_application_ua_type": ("user_agent_type", lambda c: c == "Application"),
        "is_mobile_device": ("device_type", lambda c: contains_any_word(c, ("Phone", "Tablet"))),
    }
    for name, (source, test) in tests.items():
        if source in columns:
            aggregates.append(F.count_if(test(F.col(source))).alias(f"_{name}"))
            outputs.append((F.col(f"_{name}") > 0).alias(name))
        else:
            outputs.append(F.lit(False).alias(name))
    return Block(aggregates, outputs)


def status_block(columns: Sequence[str], params: Params) -> Block:
    if "status_code" not in columns:
        return Block([], [F.lit(1.0 if name == "ok2xx_rate" else 0.0).alias(name)
                          for name in STATUS_RANGES])
    code = F.col("status_code").cast("string").try_cast("double")
    return Block(
        [F.count_if((code >= low) & (code < high)).alias(f"_{name}")
         for name, (low, high) in STATUS_RANGES.items()],
        [(F.col(f"_{name}") / _n()).alias(name) for name in STATUS_RANGES],
    )


def order_block(columns: Sequence[str], params: Params) -> Block:
    """Order measures; the distinct count of order values comes from frequency.py."""
    if "num_orders" not in columns:
        zero = ("total_orders", "orders_per_event", "conversion_rate", "order_ratio",
                "max_orders_per_event", "min_orders_per_event", "order_variance")
        return Block([], [F.lit(0.0).alias(name) for name in zero] + [
            F.lit(0).cast("long").alias("events_with_orders"),
            _n().alias("events_without_orders"),
            F.lit(True).alias("only_zero_or_one_orders"),
        ])
    orders = F.col("num_orders")
    total = F.coalesce(F.col("_orders"), F.lit(0.0))
    some = total > 0

    def when_some(value: Column, other: object) -> Column:
        return F.when(some, value).otherwise(F.lit(other))

    buyers = F.col("_buyers")
    return Block(
        [
            F.sum(orders.cast("double")).alias("_orders"),
            F.count_if(orders > 0).alias("_buyers"),
            F.max(orders.cast("double")).alias("_orders_max"),
            F.min(orders.cast("double")).alias("_orders_min"),
            F.count_if(orders.isin(0, 1)).alias("_zero_or_one"),
            F.count(orders).alias("_orders_known"),
            F.var_pop(orders.cast("double")).alias("_orders_var"),
        ],
        [
            total.alias("total_orders"),
            (total / _n()).alias("orders_per_event"),
            (buyers / _n()).alias("conversion_rate"),
            buyers.alias("events_with_orders"),
            (_n() - buyers).alias("events_without_orders"),
            (buyers / _n()).alias("order_ratio"),
            when_some(F.col("_orders_max"), 0.0).alias("max_orders_per_event"),
            when_some(F.col("_orders_min"), 0.0).alias("min_orders_per_event"),
            when_some(F.col("_zero_or_one") == F.col("_orders_known"), True)
            .alias("only_zero_or_one_orders"),
            when_some(F.col("_orders_var"), 0.0).alias("order_variance"),
        ],
    )


BLOCKS: dict[str, Callable[[Sequence[str], Params], Block]] = {
    "time": time_block,
    "http": http_block,
    "hygiene": hygiene_block,
    "client_flags": client_flag_block,
    "status": status_block,
    "orders": order_block,
}


def joint_block(columns: Sequence[str], blocks: Sequence[str] = tuple(BLOCKS),
                params: Params = Params()) -> Block:
    """The chosen blocks and the number of events as one."""
    joint = Block([F.count("*").alias("n_events")], [F.col("n_events")], {})
    for name in blocks:
        block = BLOCKS[name](columns, params)
        joint = Block(joint.aggregates + block.aggregates, joint.outputs + block.outputs,
                      joint.steps | block.steps)
    return joint


def tallies(events: DataFrame, blocks: Sequence[str] = tuple(BLOCKS),
            params: Params = Params(), key: str = KEY) -> DataFrame:
    """The chosen blocks, one row per cohort, in a single shuffle."""
    joint = joint_block(events.columns, blocks, params)
    grouped = events.groupBy(key).agg(*joint.aggregates)
    return (grouped.withColumns(joint.steps) if joint.steps else grouped).select(
        key, *joint.outputs)


def min_size_filter(events: DataFrame, min_events: int, key: str = KEY) -> DataFrame:
    """Events of cohorts with at least ``min_events`` rows.

    The feature plan does not need this: it drops small cohorts after aggregation,
    which moves no event. Use it where the events themselves are wanted.
    """
    large = (events.groupBy(key).agg(F.count("*").alias("_size"))
             .where(F.col("_size") >= min_events).select(key))
    return events.join(large, key, "left_semi")
