import hashlib
import json
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from clickcohort.operators import iforest
from clickcohort.operators.history import signature_table
from clickcohort.operators.ranking import sample_rows
from clickcohort.params import Params
from clickcohort.plans import reports
from clickcohort.plans.pipeline import (
    build_features, ingest_file, load_model, run_day, score_day,
)
from clickcohort.sources.lake import read_day
from fixtures import events_from, four_cohorts, run
from test_ingest import BOOKING_HEADER, booking, dimension, write  # noqa: F401

PARAMS = Params(min_events=3, n_trees=20)


def export(folder, day, shift):
    folder.mkdir()
    rows, logged = [], []
    for ip in range(4):
        for i in range(6 + ip):
            click = shift + 100 * ip + i
            rows.append(booking(1001 + ip % 2, click, f"2025-09-{day:02d} {(3 * ip + i) % 24:02d}:00:0{i % 10}",
                                orders="1" if i == 5 else "0", stops=str(i % (ip + 1))))
            logged.append(f"10.0.0.{ip},{click}")
    half = len(rows) // 2
    write(folder / "booking_1.csv", BOOKING_HEADER, *rows[:half])
    write(folder / "x_entry_clicks_2.csv", BOOKING_HEADER, *rows[half:])
    write(folder / "On_demand_report_1.csv", "mdc\\.addr,mdc\\.click", *logged)
    return str(folder)


def test_three_days(spark, tmp_path, dimension):  # noqa: F811
    root = str(tmp_path / "lake")
    outs = [run_day(spark, f"2025-09-0{day}", root, folder=export(tmp_path / f"d{day}", day, 1000 * day),
                    dimension=dimension, params=PARAMS) for day in (1, 2, 3)]
    scores = read_day(spark, f"{root}/scores")
    assert scores.groupBy("date").count().orderBy("date").collect() == [
        (f"2025-09-0{d}", 4) for d in (1, 2, 3)]
    first, third = (read_day(spark, f"{root}/scores", f"2025-09-0{d}") for d in (1, 3))
    assert not [c for c in first.columns if c.startswith(("ewma_", "jaccard_"))]
    assert len([c for c in third.columns if c.startswith("ewma_")]) == 16
    rows = third.collect()
    # The same traffic every day: averages equal today, signatures repeat.
    for row in rows:
        assert row["ewma_gap_p50_7d"] == pytest.approx(row["gap_p50"])
        assert row["jaccard_signatures_vs_prev_day"] == 1.0
        assert 0 <= row["iso_score"] <= 1
        assert row["botness"] == pytest.approx((row["rule_score"] + row["iso_score"]) / 2)
    assert {r["n_events"] for r in rows} == {6, 7, 8, 9}
    out = outs[2]
    cohorts = spark.read.option("header", True).csv(f"{out}/cohorts")
    assert cohorts.count() == 4 and len(cohorts.columns) == 26
    document = spark.read.json(f"{out}/report").first()
    assert document["metadata"]["date"] == "2025-09-03"
    assert spark.read.option("header", True).csv(f"{out}/risk_distribution").count() == 3
    model = load_model(spark, root, "2025-09-03")
    assert model.nodes().select("tree_id").distinct().count() == 20


def test_rerun_of_a_day_changes_nothing(spark, tmp_path, dimension):  # noqa: F811
    root = str(tmp_path / "lake")
    folders = {d: export(tmp_path / f"d{d}", d, 1000 * d) for d in (1, 2)}
    for d in (1, 2):
        run_day(spark, f"2025-09-0{d}", root, folder=folders[d], dimension=dimension, params=PARAMS)
    before = read_day(spark, f"{root}/scores").orderBy("cohort_key").collect()
    build_features(spark, "2025-09-02", root, PARAMS)
    score_day(spark, "2025-09-02", root, PARAMS)
    assert read_day(spark, f"{root}/scores").orderBy("cohort_key").collect() == before


def test_single_file(spark, tmp_path):
    rows = [f"2025-01-15T22:00:0{i}Z,s,p,LAX,NYC,2025-02-0{i + 1},9.9.9.9,ua,x,200" for i in range(6)]
    csv = write(tmp_path / "one.csv",
                "timestamp,site,partner,origin,destination,dep_date,ip,user_agent,session_id,status_code",
                *rows)
    root = str(tmp_path / "lake")
    events = ingest_file(spark, csv, "2025-01-15", root, ip_csv=str(tmp_path / "missing.csv"))
    assert events.count() == 6
    row = build_features(spark, "2025-01-15", root).first()
    assert (row["ip"], row["n_events"], row["ladder_sweep_count"], row["gap_p50"]) == (
        "9.9.9.9", 6, 5, 1.0)
    assert row["night_share"] == 1.0
    scored = score_day(spark, "2025-01-15", root)
    assert scored.first()["iso_score"] == 0.0              # one row cannot be ranked
    with pytest.raises(ValueError):
        run_day(spark, "2025-01-15", root)


def test_evidence(spark):
    events = four_cohorts(spark)
    keys = [r[0] for r in events.select("cohort_key").distinct().orderBy("cohort_key").collect()]
    scored = spark.createDataFrame(
        [(k, 0.9 - i / 10, "High" if i < 3 else "Low") for i, k in enumerate(keys)],
        ["cohort_key", "botness", "risk_band"])
    rows = reports.evidence_samples(scored, events, Params(sample_rows=3), 2).collect()
    assert {r["cohort_key"] for r in rows} == set(keys[:2])
    assert all(len(r["sample_rows"]) == 3 for r in rows)
    assert all(s["cohort_key"] == r["cohort_key"] for r in rows for s in r["sample_rows"])
    again = reports.evidence_samples(scored, events.repartition(5), Params(sample_rows=3), 2).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_sample_is_small_and_stable(spark):
    events = events_from(spark, run("2025-01-15T10:00:00", 50, 1, ip="a")
                         + run("2025-01-15T10:00:00", 2, 1, ip="b"))
    first = {r["row_id"] for r in sample_rows(events).collect()}
    assert len(first) == 5
    assert {r["row_id"] for r in sample_rows(events.repartition(8)).collect()} == first
    assert {r["row_id"] for r in sample_rows(events, seed=7).collect()} != first


def test_sample_is_the_smallest_digests(spark):
    """Against SHA-1 by hand; rows are cut before the shuffle."""
    events = events_from(spark, run("2025-01-15T10:00:00", 40, 1, ip="a")
                         + run("2025-01-15T10:00:00", 1, 1, ip="b"))
    expected = set()
    for ip in ("a", "b"):
        ids = [r["row_id"] for r in events.where(F.col("ip") == ip).collect()]
        expected |= set(sorted(ids, key=lambda i: hashlib.sha1(f"9:{i}".encode()).hexdigest())[:3])
    sampled = sample_rows(events, 3, 9)
    assert {r["row_id"] for r in sampled.collect()} == expected
    assert sample_rows(events.limit(0)).collect() == []
    plan = sampled._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"WindowGroupLimit.*Final", plan) and re.search(
        r"WindowGroupLimit.*Partial", plan)


def test_report_rows_say_what_the_document_says(spark):
    scored = spark.createDataFrame(
        [(f"k{i:02}", i / 20, i / 20, i / 20, "High" if i > 14 else "Medium" if i > 9 else "Low",
          i, i % 2 == 0, None if i % 3 else 0.5) for i in range(20)],
        "cohort_key string, rule_score double, iso_score double, botness double, "
        "risk_band string, n_events long, ladder_sweep boolean, gap_p50 double")
    params = Params(top_n=3)
    rows = reports.report_rows(scored, params).collect()
    document = reports.report_document(scored, "2025-01-15", params).first().asDict(True)
    for section in ("high_risk_cohorts", "medium_risk_cohorts"):
        for rank, record in enumerate(document[section], 1):
            cells = {r["field"]: r for r in rows if (r["section"], r["rank"]) == (section, rank)}
            assert set(cells) == set(record) and len(document[section]) == 3
            for field, value in record.items():
                got = cells[field]["text"] if isinstance(value, str) else cells[field]["number"]
                assert got == value and cells[field]["cohort_key"] == record["cohort_key"]
    single = {(r["section"], r["field"]): r["number"] for r in rows if r["rank"] is None}
    assert single["summary", "total_cohorts"] == document["metadata"]["total_cohorts"]
    for field, value in document["summary"].items():
        assert single["summary", field] == value
    for stat in document["statistics"]:
        for name in ("mean", "std", "min", "max"):
            assert single["statistics", f"{stat['score']}_{name}"] == pytest.approx(stat[name])
    nothing = {(r["section"], r["field"]): r["number"]
               for r in reports.report_rows(scored.limit(0)).collect()}
    assert nothing["summary", "high_risk_count"] == 0
    assert nothing["statistics", "botness_mean"] is None and len(nothing) == 16


def test_record_columns(spark):
    frame = spark.createDataFrame([("k", "d", 0.5, 1.0)], ["cohort_key", "date", "botness", "http2_share"])
    record = reports.cohort_records(frame).select(F.to_json("record")).first()[0]
    assert json.loads(record) == {"cohort_key": "k", "botness": 0.5}


def test_signatures_are_distinct(spark):
    assert signature_table(four_cohorts(spark)).count() == 3 + 6 + 1 + 5


def test_feature_columns_exclude_labels(spark):
    frame = spark.createDataFrame(
        [("k", 1, 0.5, True, 0.1, 0.2)],
        "cohort_key string, n_events long, gap_p50 double, ladder_sweep boolean, rule_score double, iso_score double")
    assert iforest.feature_columns(frame) == ["gap_p50", "n_events"]


def _clicks(path, n):
    rows = [f"2025-01-16 10:00:{i:02d},s,1.1.1.1" for i in range(n)]
    path.write_text("timestamp,site,ip\n" + "\n".join(rows) + "\n")
    return str(path)


def test_quiet_day_and_rerun_with_fewer_rows(spark, tmp_path):
    root, day = str(tmp_path / "lake"), "2025-01-16"
    run_day(spark, day, root, csv=_clicks(tmp_path / "full.csv", 8))
    assert read_day(spark, f"{root}/scores", day).count() == 1
    out = run_day(spark, day, root, csv=_clicks(tmp_path / "few.csv", 2))
    for name in ("features", "scores"):
        assert read_day(spark, f"{root}/{name}", day).count() == 0
    assert read_day(spark, f"{root}/signatures", day).count() <= 2
    report = json.loads("".join(p.read_text() for p in
                                Path(f"{out}/report").glob("part-*")))
    assert report["metadata"]["total_cohorts"] == 0
    assert report["summary"]["high_risk_count"] == 0


def test_agent_id_of_a_booking_file_without_addresses(spark, tmp_path, dimension):  # noqa: F811
    lines = [booking(1001 + i % 2, 50 + i, f"2025-09-01 10:00:0{i}") for i in range(4)]
    write(tmp_path / "b.csv", BOOKING_HEADER, *lines)
    events = ingest_file(spark, str(tmp_path / "b.csv"), "2025-09-01", str(tmp_path / "lake"),
                         dimension=dimension)
    assert {r["user_agent_id"] for r in events.collect()} == {1001, 1002}


def test_cells_that_do_not_fit_their_type(spark, tmp_path, dimension):  # noqa: F811
    write(tmp_path / "b.csv", BOOKING_HEADER,
          booking("99999999999999999999", 1, "2025-09-01 10:00:00"),
          booking(1001, 2, "2025-09-01 10:00:01", stops="inf"))
    events = ingest_file(spark, str(tmp_path / "b.csv"), "2025-09-01", str(tmp_path / "lake"),
                         dimension=dimension).orderBy("timestamp").collect()
    assert len(events) == 2 and events[0]["user_agent_id"] is None


def test_line_break_inside_quotes_is_one_record(spark, tmp_path, dimension):  # noqa: F811
    broken = booking(1001, 2, "2025-09-01 10:00:01", partner='"two\nlines"')
    write(tmp_path / "b.csv", BOOKING_HEADER, booking(1001, 1, "2025-09-01 10:00:00"), broken)
    one = ingest_file(spark, str(tmp_path / "b.csv"), "2025-09-01", str(tmp_path / "lake"),
                      dimension=dimension).orderBy("timestamp").collect()
    assert len(one) == 2 and "two" in one[1]["partner"] and "lines" in one[1]["partner"]
    folder = tmp_path / "exports"
    folder.mkdir()
    write(folder / "booking_1.csv", BOOKING_HEADER, broken)
    write(folder / "On_demand_report_1.csv", "mdc\\.addr,mdc\\.click", "10.0.0.1,2")
    root = str(tmp_path / "lake2")
    run_day(spark, "2025-09-01", root, folder=str(folder), dimension=dimension, params=PARAMS)
    assert read_day(spark, f"{root}/events", "2025-09-01").count() == 1
