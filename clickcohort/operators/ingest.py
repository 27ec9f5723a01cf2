"""Raw click rows to the event table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from clickcohort.functions import cleaning
from clickcohort.functions.signature import payload_signature
from clickcohort.operators.layout import BROADCAST_KEYS
from clickcohort.operators.tallies import KEY
from clickcohort.params import Params
from clickcohort.session import ensure_checkpoint_dir

# Export header -> event column.
RENAMES = {
    "Created Time": "timestamp",
    "Site": "site",
    "Partner Domain": "partner",
    "OriginCity": "origin",
    "DestinationCity": "destination",
    "JourneyType": "journey_type",
    "Out Date": "dep_date",
    "Return Date": "ret_date",
    "Num Adt": "num_adults",
    "Num Cnn": "num_children",
    "Num Inf": "num_infants",
    "Cabin Classes": "cabin",
    "Total Stops": "stops",
    "MarketingCarriers": "carrier",
    "Sessions ID": "session_id",
    "ID": "user_agent_id",
    "Num Orders": "num_orders",
}

# Columns added when absent.
COLUMN_DEFAULTS: dict[str, tuple[str, object]] = {
    "referrer": ("string", None),
    "cookie_present": ("boolean", False),
    "http_version": ("string", "unknown"),
    "status_code": ("double", 200.0),
    "request_id": ("string", None),
}

# What replaces null when every row is kept (left join).
FILL_ALL = {
    "site": "unknown", "partner": "unknown", "origin": "unknown", "destination": "unknown",
    "journey_type": "OW", "pax_config": "1-0-0", "cabin": "economy", "stops": "0",
    "ip": "unknown", "user_agent": "unknown", "cookie_present": False,
    "http_version": "unknown", "status_code": 200.0,
}

# What replaces null when only matched rows are kept (inner join).
FILL_MATCHED = {"stops": "0", "num_orders": 0.0}

# Text columns that are stripped.
TEXT_COLUMNS = (
    "site", "partner", "origin", "destination", "journey_type", "dep_date", "ret_date",
    "pax_config", "cabin", "stops", "ip", "user_agent", "session_id", "referrer",
    "http_version",
)

PASSENGERS = ("num_adults", "num_children", "num_infants")
KEY_PARTS = ("date", "site", "partner", "ip", "user_agent")
_SHARES = 16  # a side of a grid cell holds at most this share of ``hot_click_rows``


def rename_columns(frame: DataFrame) -> DataFrame:
    return frame.withColumnsRenamed({k: v for k, v in RENAMES.items() if k in frame.columns})


def with_row_id(frame: DataFrame) -> DataFrame:
    """A repeatable row id from the content; equal rows of one file share it."""
    if "row_id" in frame.columns:
        return frame
    return frame.withColumn("row_id", F.xxhash64(*[F.col(f"`{c}`") for c in frame.columns]))


def join_addresses(frame: DataFrame, addresses: DataFrame, how: str = "left",
                   dedupe_clicks: bool = False, hot_click_rows: int = 1_000_000) -> DataFrame:
    """Add ``ip`` from (click, addr) by ``click_id``.

    ``left`` keeps unmatched rows as 'unknown', ``inner`` drops them. A null id
    matches nothing. Clicks listed twice multiply events unless ``dedupe_clicks``.

    Rows without an id could all land in one task; a second join key, a hash of
    the row for them and 0 for all others, spreads them. An id frequent
    among the events is split by adaptive execution; one with more than
    ``hot_click_rows`` addresses (a placeholder, say) is joined on a grid of tasks.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unknown join: {how}")
    known = addresses.where(F.col("click").isNotNull()).select(
        F.col("click").cast("string").alias("click"), "addr")
    if dedupe_clicks:
        known = known.groupBy("click").agg(F.min("addr").alias("addr"))
    events = with_row_id(frame.withColumn("click_id", F.col("click_id").cast("string")))
    events = events.drop("ip")
    grids = None if dedupe_clicks else _grids(events, known, hot_click_rows)
    if grids is None:
        return _join_by_click(events, known, how)
    in_events = [F.col("click_id") == F.col("_id")]
    in_known = [F.col("click") == F.col("_id")]
    ordinary = _join_by_click(events.join(grids, in_events, "left_anti"),
                              known.join(grids, in_known, "left_anti"), how)
    return ordinary.unionByName(_join_on_grid(
        events.join(grids, in_events), known.join(grids, in_known), events.columns, how))


def _grids(events: DataFrame, known: DataFrame, limit: int) -> DataFrame | None:
    """(_id, _rows, _columns) of ids with more than ``limit`` addresses; None without any.

    The size of an id's grid follows its own numbers of events and addresses.
    """
    sizes = known.groupBy("click").agg(F.count("*").alias("_n")).where(F.col("_n") > limit)
    found = sizes.count()
    if not found:
        return None
    ensure_checkpoint_dir(events.sparkSession)
    seen = events.groupBy("click_id").agg(F.count("*").alias("_m"))
    cell = max(1, limit // _SHARES)
    grids = sizes.join(seen, F.col("click") == F.col("click_id"), "left").select(
        F.col("click").alias("_id"),
        F.ceil(F.coalesce("_m", F.lit(1)) / cell).cast("int").alias("_rows"),
        F.ceil(F.col("_n") / cell).cast("int").alias("_columns")).checkpoint()
    return F.broadcast(grids) if found <= BROADCAST_KEYS else grids


def _join_on_grid(events: DataFrame, known: DataFrame, columns: list[str],
                  how: str) -> DataFrame:
    """Inner join of ids that all have a match: each id is spread over a grid of tasks, a
    row of the grid per share of its events, a column per share of its addresses."""
    def share(column: str, width: str) -> Column:
        return F.pmod(F.xxhash64(column), F.col(width)).cast("int")

    def every(width: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(width) - 1))

    left = events.withColumns({"_row": share("row_id", "_rows"), "_column": every("_columns")})
    # Equal addresses of an id are split by counting them first.
    right = known.groupBy("click", "addr", "_rows", "_columns").agg(
        F.count("*").alias("_times")).withColumns(
        {"_column": share("addr", "_columns"), "_row": every("_rows")})
    joined = left.join(right, (F.col("click_id") == F.col("click"))
                       & (left["_row"] == right["_row"])
                       & (left["_column"] == right["_column"]), "inner")
    repeated = joined.withColumn(
        "_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times"))))
    ip = F.coalesce("addr", F.lit("unknown")) if how == "left" else F.col("addr")
    return repeated.withColumn("ip", ip).select(*columns, "ip")


def _join_by_click(events: DataFrame, known: DataFrame, how: str) -> DataFrame:
    if how == "inner":
        joined = events.where(F.col("click_id").isNotNull()).join(
            known, F.col("click_id") == F.col("click"), "inner")
        return joined.withColumn("ip", F.col("addr")).drop("click", "addr")
    salt = F.when(F.col("click_id").isNotNull(), F.lit(0)).otherwise(F.xxhash64("row_id"))
    joined = events.withColumn("_salt", salt).join(
        known.withColumn("_zero", F.lit(0).cast("long")),
        (F.col("click_id") == F.col("click")) & (F.col("_salt") == F.col("_zero")), "left")
    return joined.withColumn("ip", F.coalesce("addr", F.lit("unknown"))).drop(
        "click", "addr", "_salt", "_zero")


def match_statistics(events: DataFrame, joined: DataFrame) -> DataFrame:
    """(input_rows, joined_rows, match_rate)."""
    left = events.agg(F.count("*")).scalar()
    return joined.agg(F.count("*").alias("joined_rows")).select(
        left.alias("input_rows"), "joined_rows",
        F.try_divide("joined_rows", left).alias("match_rate"))


def build_pax_config(frame: DataFrame) -> DataFrame:
    """adults-children-infants; an existing column is kept when counts are absent."""
    if set(PASSENGERS) <= set(frame.columns):
        parts = [F.coalesce(cleaning.clean_text(F.col(c)), F.lit("0")) for c in PASSENGERS]
        return frame.withColumn("pax_config", F.concat_ws("-", *parts))
    if "pax_config" in frame.columns:
        return frame
    return frame.withColumn("pax_config", F.lit("1-0-0"))


def enrich_user_agents(frame: DataFrame, dimension: DataFrame | None) -> DataFrame:
    """Look up user_agent_id; the dimension is small and Spark broadcasts it by size.

    Unknown ids get 'Unknown' and the name 'Unknown User Agent <id>'. Without an id
    column, an existing user_agent is kept and the rest is Unknown.
    """
    unknown = F.lit("Unknown")
    if "user_agent_id" not in frame.columns:
        fixed: dict[str, Column] = {
            c: unknown for c in ("user_agent_type", "device_type", "os_type", "user_agent_full")
            if c not in frame.columns
        }
        if "user_agent" not in frame.columns:
            fixed["user_agent"] = F.lit("unknown")
        return frame.withColumns(fixed) if fixed else frame
    agent = cleaning.to_number(F.col("user_agent_id")).try_cast("long")
    names = {"user_agent": "browserModel", "user_agent_type": "userAgentType",
             "device_type": "device", "os_type": "osType"}
    frame = frame.drop(*names, "user_agent_full").withColumn("user_agent_id", agent)
    if dimension is None:
        frame = frame.withColumns({f"_{c}": F.lit(None).cast("string")
                                   for c in (*names.values(), "name")})
    else:
        looked_up = dimension.select(
            F.col("id").cast("long").alias("_id"),
            *[F.col(c).alias(f"_{c}") for c in (*names.values(), "name")])
        frame = frame.join(looked_up, F.col("user_agent_id") == F.col("_id"), "left").drop("_id")
    absent_name = F.when(
        F.col("user_agent_id").isNotNull(),
        F.concat(F.lit("Unknown User Agent "), F.col("user_agent_id").cast("string")),
    ).otherwise(unknown)
    return frame.withColumns({
        **{out: F.coalesce(f"_{source}", unknown) for out, source in names.items()},
        "user_agent_full": F.coalesce(F.col("_name"), absent_name),
    }).drop(*[f"_{c}" for c in (*names.values(), "name")])


def add_default_columns(frame: DataFrame) -> DataFrame:
    missing = {c: F.lit(value).cast(kind) for c, (kind, value) in COLUMN_DEFAULTS.items()
               if c not in frame.columns}
    return frame.withColumns(missing) if missing else frame


def normalize_columns(frame: DataFrame, params: Params = Params(),
                      zero_numbers: bool = False) -> DataFrame:
    """Types and clean text. ``zero_numbers``: bad numbers become 0, else null."""
    have = set(frame.columns)
    default = 0.0 if zero_numbers else None
    out: dict[str, Column] = {
        c: cleaning.clean_text(F.col(c)) for c in TEXT_COLUMNS if c in have}
    if "http_version" in have:
        out["http_version"] = cleaning.http_version(out["http_version"])
    if "timestamp" in have and frame.schema["timestamp"].dataType.typeName() == "string":
        out["timestamp"] = cleaning.parse_timestamp(F.col("timestamp"), params.tz)
    if "cookie_present" in have:
        out["cookie_present"] = cleaning.clean_bool(F.col("cookie_present"))
    if "status_code" in have:
        out["status_code"] = cleaning.to_number(F.col("status_code"), default)
    if "num_orders" in have:
        out["num_orders"] = cleaning.to_number(F.col("num_orders"), 0.0)
    if zero_numbers:
        for c in PASSENGERS:
            if c in have:
                out[c] = cleaning.to_number(F.col(c), 0.0)
        if "stops" in have:
            stops = cleaning.to_number(F.col("stops"), 0.0).try_cast("long")
            out["stops"] = F.coalesce(stops, F.lit(0)).cast("string")
    return frame.withColumns(out)


def fill_missing(frame: DataFrame, values: Mapping[str, object] = FILL_ALL) -> DataFrame:
    return frame.fillna({c: v for c, v in values.items() if c in frame.columns})


def cohort_key() -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("unknown"))
                              for c in KEY_PARTS])


def add_derived(frame: DataFrame, date: str | Column | None = None) -> DataFrame:
    """date, cohort parts and key, calendar parts, signature and order flags.

    ``date`` is the day the job runs for, not the day of the event; None keeps an
    existing column.
    """
    if date is not None:
        frame = frame.withColumn("date", F.lit(date) if isinstance(date, str) else date)
    absent = {c: F.lit(None).cast("string") for c in KEY_PARTS if c not in frame.columns}
    frame = frame.withColumns(absent) if absent else frame
    parts = {f"cohort_{short}": F.coalesce(F.col(c).cast("string"), F.lit("unknown"))
             for c, short in zip(KEY_PARTS, ("date", "site", "partner", "ip", "ua"))}
    if "timestamp" in frame.columns:
        calendar = {"hour": F.hour("timestamp"), "minute": F.minute("timestamp"),
                    "day_of_week": F.weekday("timestamp")}
    else:
        calendar = {c: F.lit(0) for c in ("hour", "minute", "day_of_week")}
    orders = F.col("num_orders") if "num_orders" in frame.columns else F.lit(0.0)
    return frame.withColumns({
        **parts, KEY: cohort_key(), **calendar,
        "payload_signature": payload_signature(frame.columns),
        "has_order": F.coalesce((orders > 0).cast("int"), F.lit(0)),
        "order_value": orders,
    })


def ingest(raw: DataFrame, date: str | Column | None, addresses: DataFrame | None = None,
           dimension: DataFrame | None = None, ip_join: str = "left",
           params: Params = Params(), dedupe_clicks: bool = False) -> DataFrame:
    """Raw text rows to events. ``inner`` is the batch form: matched rows only, bad
    numbers 0, fewer fills. An existing ip column is kept when no addresses are given.
    """
    frame = rename_columns(with_row_id(raw))
    if addresses is not None:
        if "click_id" not in frame.columns:
            raise ValueError("no click_id column: use sources.delimited.resolve_ids first")
        frame = join_addresses(frame, addresses, ip_join, dedupe_clicks)
    elif "ip" not in frame.columns:
        frame = frame.withColumn("ip", F.lit("unknown"))
    frame = add_default_columns(enrich_user_agents(build_pax_config(frame), dimension))
    matched = ip_join == "inner"
    frame = normalize_columns(frame, params, zero_numbers=matched)
    frame = fill_missing(frame, FILL_MATCHED if matched else FILL_ALL)
    return add_derived(frame, date)


# -- checks and statistics ------------------------------------------------------

def _counted(events: DataFrame, values: Sequence[Column], timed: bool = False) -> DataFrame:
    """(kind, value, n[, first, last]): rows per value of each kind, from one read and one shuffle.

    A kind is a position in ``values``. Every event becomes one short row of kind 0, also for
    null, and one of each other kind whose value is not null; rows are counted per task before the
    shuffle. ``timed`` keeps the time range of kind 0.
    """
    kept = [F.col("timestamp").alias("_at")] if timed else []
    cells = [F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("value"))
             for kind, value in enumerate(values)]
    emitted = F.array_compact(F.array(cells[0], *[
        F.when(value.isNotNull(), cell) for value, cell in zip(values[1:], cells[1:])]))
    rows = events.select(F.explode(emitted).alias("_c"), *kept).select(
        "_c.*", *[F.when(F.col("_c.kind") == 0, F.col("_at")).alias("_at") for _ in kept])
    return rows.groupBy("kind", "value").agg(F.count("*").alias("n"), *([
        F.min("_at").alias("first"), F.max("_at").alias("last")] if timed else []))


def _rows_of(kind: int) -> Column:
    return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0))


def _values_of(kind: int) -> Column:
    return F.count_if((F.col("kind") == kind) & F.col("value").isNotNull())


def _distinct_total(frame: DataFrame, column: str) -> Column:
    """Number of different non-null values, spread over tasks before it is counted."""
    return (frame.where(F.col(column).isNotNull()).select(column).distinct()
            .agg(F.count("*")).scalar())


def ingest_statistics(events: DataFrame) -> DataFrame:
    """rows, distinct cohorts, addresses and user agents."""
    return events.agg(F.count("*").alias("rows")).select(
        "rows", _distinct_total(events, KEY).alias("unique_cohorts"),
        _distinct_total(events, "ip").alias("unique_ips"),
        _distinct_total(events, "user_agent").alias("unique_user_agents"))


def ingest_quality(events: DataFrame, params: Params = Params(),
                   columns: Sequence[str] | None = None) -> DataFrame:
    """One row: totals, time range, small cohorts, repeated clicks, nulls per column.

    The events are read once, so a join before them runs once.
    """
    columns = list(columns or events.columns)
    clicks = "click_id" in events.columns
    timed = "timestamp" in events.columns
    values = [F.col(KEY), F.col("click_id") if clicks else F.lit(None)]
    values += [F.when(F.col(c).isNull(), F.lit("")) for c in columns]
    kind, n = F.col("kind"), F.col("n")
    out = [_rows_of(0).alias("total_rows")]
    if timed:
        out += [F.min("first").alias("first_timestamp"), F.max("last").alias("last_timestamp")]
    out += [_rows_of(i).alias(f"null_{c}") for i, c in enumerate(columns, 2)]
    out += [_values_of(0).alias("cohorts"),
            F.count_if((kind == 0) & F.col("value").isNotNull() & (n < params.min_events))
            .alias("small_cohorts")]
    if clicks:
        out.append(F.count_if((kind == 1) & (n > 1)).alias("repeated_clicks"))
    return _counted(events, values, timed).agg(*out)


def quality_issues(quality: DataFrame, params: Params = Params()) -> DataFrame:
    """The findings as rows of text."""
    issues = F.array(
        F.when(F.col("total_rows") == 0, F.lit("No data rows found")),
        F.when(F.col("cohorts") == 0, F.lit("No cohorts found")),
        F.when(F.col("small_cohorts") > 0, F.concat(
            F.col("small_cohorts").cast("string"),
            F.lit(f" cohorts have < {params.min_events} events"))),
        *([F.when((F.col("null_timestamp") > 0), F.concat(
            F.col("null_timestamp").cast("string"),
            F.lit(" events have no readable timestamp")))]
          if "null_timestamp" in quality.columns else []),
        *([F.when(F.col("repeated_clicks") > 0, F.concat(
            F.col("repeated_clicks").cast("string"), F.lit(" click ids occur more than once")))]
          if "repeated_clicks" in quality.columns else []),
    )
    return quality.select(F.explode(F.filter(issues, lambda i: i.isNotNull())).alias("issue"))
