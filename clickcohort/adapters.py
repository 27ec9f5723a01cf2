"""The driver's tables in the shape of click logs.

Each mapping is a projection of whole tables; none filters or samples.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickcohort.functions.signature import payload_signature
from clickcohort.operators.ingest import cohort_key
from clickcohort.operators.layout import dealt_out
from clickcohort.operators.tallies import KEY
from clickcohort.session import configure

# A three-row user-agent dimension.
AGENTS = (
    (0, "Chrome.120/PC/Windows/Web Browser", "Web Browser", "Chrome", 120, "Windows", "PC"),
    (1, "App.7/Android Phone/Android/Application", "Application", "App", 7, "Android",
     "Android Phone"),
    (2, "Crawler/Other/Linux/Bot", "Bot", "Crawler", None, "Linux", "Other"),
)
AGENT_SCHEMA = ("id long, name string, userAgentType string, browserModel string, "
                "majorVersion int, osType string, device string")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def agents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(AGENTS), AGENT_SCHEMA)


def _base(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    events = table(spark, sf_dir, "events")
    return (dealt_out(events, "event_id") if spread else events).select(
        F.col("event_id"), F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type",
        k.alias("k"))


def _choice(column, values):
    """values[column] as a chain of conditions."""
    out = F.lit(values[-1])
    for i, value in reversed(list(enumerate(values[:-1]))):
        out = F.when(column == i, value).otherwise(out)
    return out


def click_events(spark: SparkSession, sf_dir: str, ips: int = 10, agents: int = 3,
                 spread: bool = False) -> DataFrame:
    """``events`` as an event table ready for features; ``spread`` over all cores if few tasks
    read it."""
    k, kind = F.col("k"), F.col("event_type")
    agent = F.col("user_id") % agents
    day = F.to_date("ts")
    status = (F.when(kind == "error", 500.0)
              .when((kind == "view") & (k % 10 == 0), 404.0).otherwise(200.0))
    orders = F.when(kind == "purchase", F.when(k % 10 == 0, 2.0).otherwise(1.0)).otherwise(0.0)
    frame = _base(spark, sf_dir, spread).select(
        F.col("event_id").alias("row_id"),
        F.col("ts").alias("timestamp"),
        day.cast("string").alias("date"),
        F.lit("s1").alias("site"),
        F.lit("p1").alias("partner"),
        F.concat(F.lit("10.0.0."), (F.col("user_id") % ips).cast("string")).alias("ip"),
        agent.alias("user_agent_id"),
        _choice(agent, [a[3] for a in AGENTS]).alias("user_agent"),
        _choice(agent, [a[2] for a in AGENTS]).alias("user_agent_type"),
        _choice(agent, [a[6] for a in AGENTS]).alias("device_type"),
        _choice(agent, [a[5] for a in AGENTS]).alias("os_type"),
        F.concat(F.lit("UA"), (k % 6).cast("string")).alias("user_agent_full"),
        kind.alias("origin"),
        F.concat(F.lit("D"), (k % 3).cast("string")).alias("destination"),
        F.date_add(day, k % 7).cast("string").alias("dep_date"),
        F.lit(None).cast("string").alias("ret_date"),
        F.lit("1-0-0").alias("pax_config"),
        F.lit("economy").alias("cabin"),
        F.lit("0").alias("stops"),
        F.concat(F.col("user_id").cast("string"), F.lit("-"), F.hour("ts").cast("string"))
        .alias("session_id"),
        F.when(k % 3 != 0, "r").alias("referrer"),
        (k % 2 == 0).alias("cookie_present"),
        _choice(k % 4, ["1.1", "2", "3", "unknown"]).alias("http_version"),
        status.alias("status_code"),
        orders.alias("num_orders"),
        (orders > 0).cast("int").alias("has_order"),
    )
    return frame.withColumn(KEY, cohort_key()).withColumn(
        "payload_signature", payload_signature(frame.columns))


def robot_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` from two addresses; the first asks for one page again and again, without cookie
    or referrer, under one agent."""
    frame = click_events(spark, sf_dir, ips=2, agents=2).drop("payload_signature")
    robot = F.col("ip") == "10.0.0.0"
    fixed = {"origin": F.lit("view"), "destination": F.lit("D0"), "dep_date": F.col("date"),
             "referrer": F.lit(None), "cookie_present": F.lit(False),
             "http_version": F.lit("1.1"), "user_agent_full": F.lit("UA0")}
    frame = frame.withColumns({
        c: F.when(robot, value).otherwise(F.col(c)) for c, value in fixed.items()})
    return frame.withColumn("payload_signature", payload_signature(frame.columns))


def raw_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as the text rows of a booking export, with blanks and null spellings."""
    k, day = F.col("k"), F.to_date("ts")
    text = lambda c: c.cast("string")
    return _base(spark, sf_dir).select(
        F.col("event_id").alias("row_id"),
        F.when(k == 13, "not a time").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .alias("Created Time"),
        F.lit(" s1 ").alias("Site"),
        F.when(k % 25 == 0, "nan").otherwise("p1").alias("Partner Domain"),
        F.concat(F.lit(" "), F.upper("event_type")).alias("OriginCity"),
        F.concat(F.lit("D"), text(k % 3)).alias("DestinationCity"),
        F.when(k % 4 == 0, F.lit(None)).otherwise("RT").alias("JourneyType"),
        text(F.date_add(day, k % 7)).alias("Out Date"),
        F.when(k % 2 == 0, text(F.date_add(day, 10))).alias("Return Date"),
        text(1 + k % 3).alias("Num Adt"),
        text(k % 2).alias("Num Cnn"),
        F.when(k % 5 == 0, F.lit(None)).otherwise("0").alias("Num Inf"),
        F.lit("Economy").alias("Cabin Classes"),
        F.when(k % 11 == 0, F.lit(None)).otherwise(text(k % 2)).alias("Total Stops"),
        F.lit("XX").alias("MarketingCarriers"),
        F.concat(text(F.col("user_id")), F.lit("-"), text(F.hour("ts"))).alias("Sessions ID"),
        F.when(F.col("event_type") == "purchase", "1").when(k == 7, "bad").otherwise("0")
        .alias("Num Orders"),
        F.when(k != 17, text(F.col("user_id") % 4)).alias("user_agent_id"),
        F.when(k != 19, text(F.col("event_id"))).alias("click_id"),
    )


def address_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(click, addr): signups are logged under ids nobody clicked, purchases twice."""
    base = _base(spark, sf_dir)
    copies = F.when(F.col("event_type") == "purchase", 2).otherwise(1)
    return base.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).select(
        F.concat(F.when(F.col("event_type") == "signup", "none-").otherwise(""),
                 F.col("event_id").cast("string")).alias("click"),
        F.concat(F.lit("10.0.0."), (F.col("user_id") % 10).cast("string")).alias("addr"))
