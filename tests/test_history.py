import pytest
from pyspark.sql import functions as F

from clickcohort.operators import history
from clickcohort.operators.tallies import KEY
from clickcohort.params import Params

SCHEMA = f"date string, site string, partner string, ip string, user_agent string, {KEY} string"


def days(spark, rows, extra):
    """(date, ip, values...) rows with the identity filled in."""
    full = [(d, "s", "p", ip, "u", f"{d}|s|p|{ip}|u", *rest) for d, ip, *rest in rows]
    return spark.createDataFrame(full, f"{SCHEMA}, {extra}")


def test_ewma_runs_oldest_to_newest(spark):
    past = days(spark, [("2025-01-03", "a", 4.0), ("2025-01-01", "a", 1.0), ("2025-01-02", "a", 2.0),
                        ("2025-01-02", "b", None)], "night_share double")
    today = days(spark, [("2025-01-04", "a", 9.0), ("2025-01-04", "b", 5.0), ("2025-01-04", "c", None)],
                 "night_share double")
    rows = {r["ip"]: r for r in history.add_ewma(today, past).collect()}
    assert rows["a"]["ewma_night_share_7d"] == pytest.approx(2.689497716894977)
    assert rows["b"]["ewma_night_share_7d"] == 5.0        # only a null before: today's value
    assert rows["c"]["ewma_night_share_30d"] == 0.0       # nothing at all
    assert "_past" not in rows["a"]


def test_features_missing_in_history(spark):
    past = days(spark, [("2025-01-01", "a", 1.0)], "night_share double")
    today = days(spark, [("2025-01-02", "a", 2.0, 7.0)], "night_share double, gap_p50 double")
    row = history.add_ewma(today, past).first()
    assert (row["ewma_night_share_7d"], row["ewma_gap_p50_7d"]) == (1.0, 7.0)


def test_no_history_adds_nothing(spark):
    today = days(spark, [("2025-01-02", "a", 2.0)], "night_share double")
    assert history.add_ewma(today, None).columns == today.columns


def test_all_days_at_once_agree_with_one_day(spark):
    rows = [(f"2025-01-{d:02d}", ip, float(d * 7 % 5) + 0.5) for d in range(1, 13)
            for ip in ("a", "b") if (d, ip) != (5, "b")]
    table = days(spark, rows, "night_share double")
    params = Params(lookback_days=6)
    together = {r[KEY]: r for r in history.ewma_over_days(table, params, ["night_share"]).collect()}
    past = table.where((F.col("date") >= "2025-01-06") & (F.col("date") < "2025-01-12"))
    single = history.add_ewma(table.where(F.col("date") == "2025-01-12"), past, params)
    for row in single.collect():
        for name in ("ewma_night_share_7d", "ewma_night_share_30d"):
            assert together[row[KEY]][name] == pytest.approx(row[name])


def test_read_history_window(spark, tmp_path):
    path = str(tmp_path / "features")
    days(spark, [(d, "a", 1.0) for d in ("2024-12-01", "2025-01-01", "2025-01-30", "2025-01-31")],
         "night_share double").write.partitionBy("date").parquet(path)
    found = history.read_history(spark, path, "2025-01-31", 30)
    assert sorted(r["date"] for r in found.collect()) == ["2025-01-01", "2025-01-30"]
    assert history.read_history(spark, path, "2024-12-01") is None


def test_ewma_series(spark):
    frame = spark.createDataFrame([("k", "1", 1.0), ("k", "2", None), ("k", "3", 2.0), ("k", "4", 4.0)],
                                  "k string, d string, v double")
    rows = history.ewma_series(frame, ["k"], "d", "v", 0.3, 30, "e").orderBy("d").collect()
    assert [r["e"] for r in rows] == pytest.approx([1.0, (0.7 + 2) / 1.7, 2.689497716894977])
    short = history.ewma_series(frame, ["k"], "d", "v", 0.3, 1, "e").orderBy("d").collect()
    assert [r["e"] for r in short] == [1.0, 2.0, 4.0]


def test_jaccard_with_previous_day(spark):
    sets = {("2025-01-01", "a"): "xy", ("2025-01-03", "a"): "yz", ("2025-01-03", "b"): "x",
            ("2025-01-01", "c"): "x"}
    events = days(spark, [(d, ip, s) for (d, ip), text in sets.items() for s in text * 2],
                  "payload_signature string")
    cohorts = spark.createDataFrame(
        [(d, "s", "p", ip, "u", f"{d}|s|p|{ip}|u") for d, ip in (
            ("2025-01-01", "a"), ("2025-01-03", "a"), ("2025-01-03", "b"), ("2025-01-03", "c"),
            ("2025-01-03", "d"))], SCHEMA)
    found = history.jaccard_vs_previous_day(cohorts, history.signature_table(events))
    rows = {(r["date"][-2:], r["ip"]): r["jaccard_signatures_vs_prev_day"] for r in found.collect()}
    assert rows[("01", "a")] is None                       # nothing came before
    assert rows[("03", "a")] == pytest.approx(1 / 3)       # the latest day, not yesterday
    assert rows[("03", "b")] == 0.0
    assert rows[("03", "c")] == 0.0
    assert rows[("03", "d")] == 1.0                        # both sets empty


def test_latest_day(spark):
    frame = days(spark, [("2025-01-01", "a", 1), ("2025-01-03", "a", 2)], "v int")
    assert [r["v"] for r in history.latest_day(frame).collect()] == [2]


def test_null_identity_is_followed(spark):
    rows = [("2025-01-01", "a", 0.5), ("2025-01-02", "a", 0.1)]
    table = days(spark, rows, "night_share double").withColumn("partner", F.lit(None).cast("string"))
    today = table.where("date = '2025-01-02'")
    row = history.add_ewma(today, table.where("date = '2025-01-01'")).first()
    assert row["ewma_night_share_7d"] == 0.5 and row["partner"] is None
    signatures = days(spark, [("2025-01-01", "a", "x"), ("2025-01-02", "a", "y")],
                      "payload_signature string").withColumn(
        "partner", F.lit(None).cast("string"))
    found = history.jaccard_vs_previous_day(today, signatures).first()
    assert found["jaccard_signatures_vs_prev_day"] == 0.0
