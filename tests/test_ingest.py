import datetime as dt

import pytest
from pyspark.sql import functions as F

from clickcohort.operators import ingest as ops
from clickcohort.operators.ingest import ingest, ingest_quality, ingest_statistics
from clickcohort.operators.tallies import KEY
from clickcohort.params import Params
from clickcohort.sources.delimited import (
    address_table, list_files, read_csv, read_exports, read_many, resolve_ids,
)
from clickcohort.sources.dimension import read_dimension
from clickcohort.sources.lake import read_day, write_day

BOOKING_HEADER = ("ID,Created Time,Site,Partner Domain,OriginCity,DestinationCity,JourneyType,"
                  "Out Date,Return Date,Num Adt,Num Cnn,Num Inf,Cabin Classes,Total Stops,"
                  "MarketingCarriers,Sessions ID,Num Orders,ID")


def booking(agent, click, time="2025-09-05 10:00:00", orders="0", partner="p", stops="1"):
    return (f"{agent},{time},s,{partner},LAX,NYC,OW,2025-10-01,,1,0,0,Economy,{stops},XX,"
            f"sess,{orders},{click}")


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


@pytest.fixture
def dimension(spark, tmp_path):
    return read_dimension(spark, write(
        tmp_path / "agents.csv", "id,name,userAgentType,browserModel,majorVersion,osType,device",
        "1001,Chrome.86/PC,Web Browser,Chrome,86,Windows,PC",
        "1002,Bot/Other,Bot,Crawler,,Linux,Other"))


def test_dimension(spark, dimension, tmp_path):
    rows = {r["id"]: r for r in dimension.collect()}
    assert rows[1001]["majorVersion"] == 86 and rows[1002]["majorVersion"] is None
    assert read_dimension(spark, str(tmp_path / "missing.csv")).count() == 0
    bad = write(tmp_path / "bad.csv", "id,other", "1,x")
    assert read_dimension(spark, bad).count() == 0


def test_null_tokens_quotes_and_file_name(spark, tmp_path):
    path = write(tmp_path / "a.csv", "x,y", 'NULL,"say ""hi"", you"', "n/a,2", " nan ,3", "0,None")
    rows = read_csv(spark, path).orderBy("y").collect()
    assert [r["x"] for r in rows] == ["0", None, None, None]
    assert rows[3]["y"] == 'say "hi", you'
    assert rows[0]["source_file"].endswith("a.csv")


def test_duplicate_ids_and_prefixed_headers(spark, tmp_path):
    raw = resolve_ids(read_csv(spark, write(tmp_path / "b.csv", BOOKING_HEADER,
                                            booking(1001, 9000000001))))
    row = raw.first()
    assert (row["user_agent_id"], row["click_id"]) == ("1001", "9000000001")
    single = resolve_ids(read_csv(spark, write(tmp_path / "c.csv", "Site,ID", "s,77"))).first()
    assert (single["user_agent_id"], single["click_id"]) == ("77", "77")
    last = resolve_ids(read_csv(spark, write(tmp_path / "d.csv", "Site,code", "s,77"))).first()
    assert last["click_id"] == "77"
    with pytest.raises(ValueError):
        resolve_ids(read_csv(spark, str(tmp_path / "d.csv")), strict=True)
    for header in ("mdc.addr,mdc.click,mdc.request.id", "mdc\\.addr,mdc\\.click,mdc\\.request\\.id",
                   "the addr,Click No,z"):
        found = address_table(read_csv(spark, write(tmp_path / "e.csv", header, "1.2.3.4,7,r")))
        assert found.first().asDict() == {"click": "7", "addr": "1.2.3.4"}
    with pytest.raises(ValueError):
        address_table(read_csv(spark, str(tmp_path / "d.csv")))


def test_files_are_found_once_and_united_by_name(spark, tmp_path):
    write(tmp_path / "booking_1.csv", "ID,Site", "1,a")
    write(tmp_path / "booking_entry_clicks.csv", "Site,ID,Extra", "b,2,x")   # matches both globs
    write(tmp_path / "other.csv", "Site", "no")
    write(tmp_path / "On_demand_report_1.csv", "mdc.addr,mdc.click", "1.1.1.1,1")
    write(tmp_path / "On_demand_report_2.csv", "mdc.click,mdc.addr", "2,2.2.2.2")
    found = list_files(spark, str(tmp_path), ["booking_*.csv", "*entry_clicks*.csv"])
    assert [f.rsplit("/", 1)[1] for f in found] == ["booking_1.csv", "booking_entry_clicks.csv"]
    rows = {r["Site"]: r for r in read_many(spark, found).collect()}
    assert rows["a"]["Extra"] is None and rows["b"]["ID"] == "2"
    bookings, addresses = read_exports(spark, str(tmp_path))
    assert {(r["Site"], r["click_id"]) for r in bookings.collect()} == {("a", "1"), ("b", "2")}
    assert {(r["click"], r["addr"]) for r in addresses.collect()} == {
        ("1", "1.1.1.1"), ("2", "2.2.2.2")}


def test_missing_exports(spark, tmp_path):
    with pytest.raises(ValueError, match="booking"):
        read_exports(spark, str(tmp_path))
    write(tmp_path / "booking_1.csv", "ID", "1")
    with pytest.raises(ValueError, match="IP"):
        read_exports(spark, str(tmp_path))


def exports(spark, tmp_path):
    raw = resolve_ids(read_csv(spark, write(
        tmp_path / "b.csv", BOOKING_HEADER,
        booking(1001, 1), booking(1002, 2, orders="2"), booking(9999, 3, time="invalid"),
        booking("", 4, partner="null", stops=""), booking(1001, ""))))
    addresses = address_table(read_csv(spark, write(
        tmp_path / "i.csv", "mdc.addr,mdc.click", "10.0.0.1,1", "10.0.0.2,2", "10.0.0.2,2",
        "10.0.0.3,3", "10.0.0.9,", "10.0.0.8,88")))
    return raw, addresses


def test_left_join(spark, tmp_path, dimension):
    raw, addresses = exports(spark, tmp_path)
    events = ingest(raw, "2025-09-05", addresses, dimension)
    rows = events.collect()
    assert len(rows) == 6                                  # the click listed twice gives two
    by_click = {r["click_id"]: r for r in rows}
    assert by_click["4"]["ip"] == "unknown" and by_click[None]["ip"] == "unknown"
    assert by_click["1"]["user_agent"] == "Chrome" and by_click["1"]["device_type"] == "PC"
    assert by_click["3"]["user_agent_full"] == "Unknown User Agent 9999"
    assert by_click["4"]["user_agent_full"] == "Unknown"
    assert by_click["3"]["timestamp"] is None              # never the current time
    assert by_click["4"]["partner"] == "unknown" and by_click["4"]["stops"] == "0"
    assert by_click["1"]["pax_config"] == "1-0-0"
    assert by_click["1"][KEY] == "2025-09-05|s|p|10.0.0.1|Chrome"
    assert (by_click["2"]["has_order"], by_click["2"]["order_value"]) == (1, 2.0)
    assert (by_click["1"]["hour"], by_click["1"]["minute"], by_click["1"]["day_of_week"]) == (10, 0, 4)
    once = ingest(raw, "2025-09-05", addresses, dimension, dedupe_clicks=True)
    assert once.count() == 5


def test_inner_join(spark, tmp_path, dimension):
    raw, addresses = exports(spark, tmp_path)
    rows = ingest(raw, "2025-09-05", addresses, dimension, ip_join="inner").collect()
    assert sorted(r["click_id"] for r in rows) == ["1", "2", "2", "3"]
    assert all(r["num_adults"] == 1.0 for r in rows)
    joined = ops.join_addresses(raw, addresses, "inner")
    found = ops.match_statistics(raw, joined).first()
    assert (found["input_rows"], found["joined_rows"], found["match_rate"]) == (5, 4, 0.8)
    with pytest.raises(ValueError):
        ops.join_addresses(raw, addresses, "outer")


def test_existing_columns_are_kept(spark, tmp_path):
    path = write(tmp_path / "x.csv",
                 "timestamp,site,partner,ip,user_agent,pax_config,cookie_present,http_version,status_code",
                 "2025-01-15T22:00:00Z,s,p,9.9.9.9,Mozilla/5.0,2-1-0,false,2.0,404",
                 "2025-01-15T22:00:01Z,s,p,9.9.9.9,Mozilla/5.0,2-1-0,true,1.1,oops")
    rows = ingest(read_csv(spark, path), "2025-01-15").orderBy("timestamp").collect()
    assert (rows[0]["ip"], rows[0]["user_agent"], rows[0]["pax_config"]) == (
        "9.9.9.9", "Mozilla/5.0", "2-1-0")
    assert [r["cookie_present"] for r in rows] == [False, True]
    assert [r["http_version"] for r in rows] == ["2", "1.1"]
    assert [r["status_code"] for r in rows] == [404.0, 200.0]
    assert rows[0]["user_agent_type"] == "Unknown"


def test_few_columns(spark, tmp_path):
    path = write(tmp_path / "x.csv", "timestamp,site,ip", "2025-01-15T10:00:00Z,s,1.1.1.1")
    row = ingest(read_csv(spark, path), "2025-01-15").first()
    assert row[KEY] == "2025-01-15|s|unknown|1.1.1.1|unknown"
    assert (row["pax_config"], row["http_version"], row["status_code"]) == ("1-0-0", "unknown", 200.0)
    assert (row["cookie_present"], row["referrer"], row["order_value"]) == (False, None, 0.0)


def test_header_only(spark, tmp_path):
    path = write(tmp_path / "x.csv", "timestamp,site,ip")
    events = ingest(read_csv(spark, path), "2025-01-15")
    assert events.count() == 0
    quality = ops.ingest_quality(events)
    assert {r["issue"] for r in ops.quality_issues(quality).collect()} == {
        "No data rows found", "No cohorts found"}


def test_quality(spark, tmp_path, dimension):
    raw, addresses = exports(spark, tmp_path)
    events = ingest(raw, "2025-09-05", addresses, dimension)
    row = ops.ingest_quality(events).first()
    assert (row["total_rows"], row["null_timestamp"], row["repeated_clicks"]) == (6, 1, 1)
    assert row["small_cohorts"] == row["cohorts"]
    issues = [r["issue"] for r in ops.quality_issues(ops.ingest_quality(events)).collect()]
    assert any("no readable timestamp" in i for i in issues)
    totals = ops.ingest_statistics(events).first()
    assert (totals["rows"], totals["unique_ips"]) == (6, 4)


def test_hot_null_ids_are_spread(spark, tmp_path):
    raw = spark.range(400).select(
        F.col("id").alias("row_id"), F.lit(None).cast("string").alias("click_id"))
    addresses = spark.createDataFrame([("1", "a"), (None, "b")], "click string, addr string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = ops.join_addresses(raw, addresses)
        parts = joined.select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert parts > 1
    assert joined.where(F.col("ip") == "unknown").count() == 400


@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_clicks_give_the_same(spark, how):
    """The grid against the plain join, with copies, null addresses and unmatched ids."""
    raw = spark.range(60).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, "0").when(F.col("id") % 7 != 0, F.col("id").cast("string"))
        .alias("click_id"))
    addresses = spark.range(90).select(
        F.when(F.col("id") % 2 == 0, "0").otherwise((F.col("id") % 50).cast("string")).alias("click"),
        F.when(F.col("id") != 4, (F.col("id") % 9).cast("string")).alias("addr"))
    plain = ops.join_addresses(raw, addresses, how)
    grid = ops.join_addresses(raw, addresses, how, hot_click_rows=10)
    assert sorted(grid.columns) == sorted(plain.columns)
    order = ["row_id", "ip"]
    expected = plain.select(*order).orderBy(*order).collect()
    if how == "left":                       # a matched click without an address
        assert any(r["ip"] == "unknown" for r in expected)
    assert grid.select(*order).orderBy(*order).collect() == expected


def test_days_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "days")
    one = spark.createDataFrame([("2025-01-01", 1)], "date string, v int")
    two = spark.createDataFrame([("2025-01-02", 2)], "date string, v int")
    write_day(one, path)
    write_day(two.withColumn("extra", F.lit("x")), path)
    write_day(one.withColumn("v", F.lit(7)), path)
    assert {(r["date"], r["v"]) for r in read_day(spark, path).collect()} == {
        ("2025-01-01", 7), ("2025-01-02", 2)}
    assert read_day(spark, path, "2025-01-01").columns == ["v", "date"]
    plan = read_day(spark, path, "2025-01-02")
    assert [r["extra"] for r in plan.collect()] == ["x"]


def test_time_zone(spark, tmp_path):
    path = write(tmp_path / "x.csv", "timestamp,site,ip", "2025-01-15 23:30:00,s,1.1.1.1")
    row = ingest(read_csv(spark, path), "2025-01-15", params=Params(tz="America/New_York")).first()
    assert (row["hour"], row["minute"]) == (4, 30)


def test_quality_reads_the_events_once(spark):
    """Counts, ranges and repeats by hand; nulls in every column; one scan, one event shuffle."""
    at = dt.datetime(2025, 1, 15, 10, tzinfo=dt.timezone.utc)
    rows = ([("c1", "x", at + dt.timedelta(seconds=i), "1.1.1.1", "ua") for i in range(6)]
            + [("c2", "y", at, None, "ua"), (None, None, None, None, None),
               (None, "z", None, "2.2.2.2", None)])
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(value):
        read.add(1)
        return value
    frame = spark.createDataFrame(
        rows, "cohort_key string, click_id string, timestamp timestamp, ip string, "
        "user_agent string").repartition(4).withColumn("ip", seen("ip"))
    found = ingest_quality(frame).first().asDict()
    assert read.value == len(rows)
    first, last = found.pop("first_timestamp"), found.pop("last_timestamp")
    assert (last - first).total_seconds() == 5
    assert found == {
        "total_rows": 9, "null_cohort_key": 2, "null_click_id": 1, "null_timestamp": 2,
        "null_ip": 2, "null_user_agent": 2, "cohorts": 2, "small_cohorts": 1,
        "repeated_clicks": 1}
    assert ingest_statistics(frame).first().asDict() == {
        "rows": 9, "unique_cohorts": 2, "unique_ips": 2, "unique_user_agents": 1}
    empty = ingest_quality(frame.limit(0)).first()
    assert (empty["total_rows"], empty["cohorts"], empty["first_timestamp"]) == (0, 0, None)
