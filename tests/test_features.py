import random
import re

import pytest
from pyspark.sql import functions as F

from clickcohort.operators import sequence
from clickcohort.operators.frequency import frequency_features, leading_values
from clickcohort.operators.ladder import ladder_sweep
from clickcohort.operators.layout import by_cohort, dealt_out
from clickcohort.operators.lookups import ua_churn
from clickcohort.operators.sequence import sequence_features
from clickcohort.operators.tallies import KEY, min_size_filter, rate, tallies
from clickcohort.params import Params
from clickcohort.plans.features import cohort_features
from fixtures import at, day, events_from, four_cohorts, run


def by_ip(frame):
    return {r["ip"]: r for r in frame.collect()}


def only(frame):
    rows = frame.collect()
    assert len(rows) == 1
    return rows[0]


def test_known_cohorts(spark):
    rows = by_ip(cohort_features(four_cohorts(spark)))
    one_hour, one_to_two, two_to_three = 7.626e-08, 0.918295834, 0.970950594
    expected = {
        "a": dict(n_events=12, night_share=1.0, hourly_entropy=one_hour, gap_p50=4, gap_p95=4,
                  share_lt_2s=0.0, schedule_regularity_strength=0.0, num_signatures=3,
                  top_signature_share=1 / 3, repeat_ratio=0.75, num_exact_repeats_ge_10=0,
                  ladder_sweep_count=0, dep_dates_unique=3, duration_hours=44 / 3600,
                  http11_share=1, cookie_rate=0, referrer_rate=0, max_run_lt_1s=0),
        "b": dict(n_events=6, night_share=0.0, hourly_entropy=one_to_two, gap_p50=600,
                  gap_p95=600, share_lt_2s=0.0, schedule_regularity_strength=1 / 3,
                  num_signatures=6, top_signature_share=1 / 6, repeat_ratio=0.0,
                  num_exact_repeats_ge_10=0, ladder_sweep_count=5, dep_dates_unique=6,
                  duration_hours=5 / 6, http2_share=1, cookie_rate=1, referrer_rate=1,
                  max_run_lt_1s=0),
        "c": dict(n_events=15, night_share=0.0, hourly_entropy=one_hour, gap_p50=0.5,
                  gap_p95=0.5, share_lt_2s=1.0, schedule_regularity_strength=1.0,
                  num_signatures=1, top_signature_share=1.0, repeat_ratio=14 / 15,
                  num_exact_repeats_ge_10=1, ladder_sweep_count=0, dep_dates_unique=1,
                  duration_hours=7 / 3600, http2_share=1, cookie_rate=0, referrer_rate=1,
                  max_run_lt_1s=10),
        "d": dict(n_events=5, night_share=1.0, hourly_entropy=two_to_three, gap_p50=1200,
                  gap_p95=1200, share_lt_2s=0.0, schedule_regularity_strength=0.4,
                  num_signatures=5, top_signature_share=0.2, repeat_ratio=0.0,
                  num_exact_repeats_ge_10=0, ladder_sweep_count=0, dep_dates_unique=5,
                  duration_hours=4 / 3, http11_share=1, cookie_rate=1, referrer_rate=0,
                  max_run_lt_1s=0),
    }
    assert set(rows) == set(expected)
    for ip, values in expected.items():
        for name, wanted in values.items():
            assert rows[ip][name] == pytest.approx(wanted, abs=1e-6), (ip, name)


def test_ladder_with_distinct_dates(spark):
    counts = {r[KEY].split("|")[3]: r["ladder_sweep_count"] for r in ladder_sweep(
        four_cohorts(spark), distinct_dates=True).collect()}
    assert counts == {"a": 2, "b": 5, "c": 0, "d": 0}


@pytest.mark.parametrize("dates, expected", [
    ([day(1), day(2), day(3), day(4)], (True, 3)),
    ([day(1), day(6), day(11)], (False, 0)),
    ([day(1), day(2)], (False, 0)),                       # too few rows
    ([day(1), day(2), day(4), day(5)], (False, 0)),       # runs of one step
    ([day(1), day(2), day(3), day(5), day(6), day(7)], (True, 4)),
    ([day(1), day(2), day(2), day(3)], (False, 0)),       # a repeated date breaks the run
    ([day(1), day(2), day(3), day(3), day(4), day(5)], (True, 4)),
    ([day(3), day(1), day(2)], (True, 2)),                # order does not matter
    ([day(1), day(2), day(3), "soon"], (False, 0)),       # one unreadable date
    ([day(1), day(2), day(3), None], (True, 2)),          # nulls are left out
    ([day(1), day(2), None], (False, 0)),
    ([None, None, None], (False, 0)),
    (["1/15/2025", "01/16/2025", "1/17/2025 8:30", "2025-01-18"], (True, 3)),  # month first
])
def test_ladder(spark, dates, expected):
    row = only(ladder_sweep(events_from(spark, [{"dep_date": d} for d in dates])))
    assert (row["ladder_sweep"], row["ladder_sweep_count"]) == expected


def sequence_of(spark, seconds, codes=None, params=Params()):
    start = at("2025-01-15T10:00:00").timestamp()
    import datetime as dt
    rows = [{"timestamp": None if s is None else dt.datetime.fromtimestamp(start + s, dt.timezone.utc),
             "status_code": float(codes[i]) if codes else 200.0} for i, s in enumerate(seconds)]
    return only(sequence_features(events_from(spark, rows), params))


def test_gap_percentiles(spark):
    times = [0]
    for gap in (1, 2, 3, 4, 5, 10, 20, 30, 40, 50):
        times.append(times[-1] + gap)
    row = sequence_of(spark, times)
    assert row["gap_p50"] == pytest.approx(7.5)
    assert row["gap_p95"] == pytest.approx(45.5)
    assert row["gap_p95_over_p50"] == pytest.approx(45.5 / 7.5)
    assert row["share_lt_2s"] == pytest.approx(0.1)
    assert row["max_run_lt_1s"] == 0


def test_gap_order_and_nulls(spark):
    row = sequence_of(spark, [15, 0, None, 20, 5])
    assert row["gap_p50"] == pytest.approx(5.0)
    assert sequence_of(spark, [0])["gap_p50"] == 0.0
    assert sequence_of(spark, [0])["share_lt_2s"] is None
    assert sequence_of(spark, [0])["max_run_lt_1s"] is None
    same = sequence_of(spark, [0, 0])
    assert (same["gap_p50"], same["gap_p95_over_p50"], same["max_run_lt_1s"]) == (0.0, 0.0, 0)


def test_dense_run(spark):
    dense = [i * 0.5 for i in range(10)]                  # nine gaps: no full frame
    assert sequence_of(spark, dense)["max_run_lt_1s"] == 0
    assert sequence_of(spark, [i * 0.5 for i in range(11)])["max_run_lt_1s"] == 10
    mixed = [0, 5, 10, 10.1, 10.2, 10.3, 10.4, 10.5, 20, 30, 40, 50]
    assert sequence_of(spark, mixed)["max_run_lt_1s"] == 5


@pytest.mark.parametrize("codes, expected", [
    ([200, 404, 404, 404, 200, 500, 500, 200], 3), ([200, 200], 0), ([500] * 4, 4),
    ([200, 404, 404], 2), ([404, 404, 200], 2), ([404, float("nan"), 404], 1)])
def test_error_bursts(spark, codes, expected):
    assert sequence_of(spark, list(range(len(codes))), codes)["error_bursts"] == expected


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_hot_cohorts_give_the_same(spark, seed):
    """Pieces against one window, on ties, copies, nulls and error runs across cuts."""
    rng = random.Random(seed)
    rows = []
    for cohort in range(4):
        size = (3, 25, 60, 150)[cohort]
        clock = 0.0
        for i in range(size):
            clock += rng.choice([0, 0, 0.2, 0.4, 0.9, 1.0, 5.0])
            row = {"ip": str(cohort), "status_code": rng.choice([200.0, 500.0, 500.0]),
                   "timestamp": None if rng.random() < 0.05 else at(
                       f"2025-01-15T10:{int(clock) // 60:02d}:{int(clock) % 60:02d}.{int(clock * 10) % 10}")}
            copies = rng.choice([1, 1, 1, 30]) if cohort == 3 else 1
            rows += [{**row, "row_id": 1000 * cohort + i}] * copies
    events = events_from(spark, rows).repartition(3)
    plain = sequence_features(events).orderBy(KEY).collect()
    for limit in (10, 40):
        split = sequence_features(events, Params(hot_cohort_rows=limit)).orderBy(KEY).collect()
        assert split == plain


def recorded_cuts(monkeypatch, frame_class):
    """The checkpointed frames that hold pieces."""
    kept, checkpoint = [], frame_class.checkpoint

    def record(frame, *args, **kwargs):
        done = checkpoint(frame, *args, **kwargs)
        if "piece" in done.columns:
            kept.append(done)
        return done
    monkeypatch.setattr(frame_class, "checkpoint", record)
    return kept


@pytest.mark.parametrize("task_rows, tasks", [(100_000, 1), (150, 8), (40, 30)])
def test_tasks_follow_rows_and_pieces_the_limit(spark, monkeypatch, task_rows, tasks):
    """A small limit cuts all its cohorts into small pieces, but takes no task for each."""
    monkeypatch.setattr(sequence, "TASK_ROWS", task_rows, raising=False)
    cuts = recorded_cuts(monkeypatch, type(spark.range(1)))
    rng = random.Random(task_rows)
    rows = [row for ip in "abc" for row in run(
        "2025-01-15T10:00:00", 400, 0.7, ip=ip,
        status_code=[rng.choice([200.0, 500.0, 500.0]) for _ in range(400)])]
    events = events_from(spark, rows).repartition(3)
    plain = sequence_features(events).orderBy(KEY).collect()
    assert not cuts
    assert sequence_features(events, Params(hot_cohort_rows=8)).orderBy(KEY).collect() == plain
    cut, = cuts
    assert cut.rdd.getNumPartitions() == tasks
    sizes = cut.withColumn("task", F.spark_partition_id()).groupBy(KEY, "piece").agg(
        F.count("*").alias("rows"), F.count_distinct("task").alias("tasks"))
    most = sizes.agg(F.max("rows"), F.max("tasks"), F.count("*")).first()
    assert most[0] <= 4 and most[1] == 1 and most[2] >= 300


@pytest.mark.parametrize("limit", [1, 2, 7, 20, 24, 60])
def test_dense_runs_across_cuts(spark, limit):
    """Frames over any number of cuts, against the window: gaps, copies, times that are missing."""
    rng = random.Random(limit)
    rows = []
    for cohort in range(6):
        clock = 0.0
        for i in range((1, 10, 11, 12, 90, 200)[cohort]):
            clock += rng.choice([0, 0.5, 0.5, 1.5] if cohort < 5 else [1.5, 1.5, 0.5])
            rows += [{"ip": str(cohort), "row_id": 1000 * cohort + i, "status_code": 200.0,
                      "timestamp": None if rng.random() < 0.1 else at(
                          f"2025-01-15T10:{int(clock) // 60:02d}:{int(clock) % 60:02d}"
                          f".{int(clock * 10) % 10}")}] * rng.choice([1, 1, 1, 1, 3])
    events = events_from(spark, rows)
    plain = sequence_features(events).orderBy(KEY).collect()
    assert len({r["max_run_lt_1s"] for r in plain}) > 3
    assert sequence_features(events, Params(hot_cohort_rows=limit)).orderBy(KEY).collect() == plain


def test_rows_of_a_large_cohort_do_not_meet(spark):
    """Windows over events run inside a piece; one over a cohort has a row for each piece."""
    frame = sequence_features(four_cohorts(spark), Params(hot_cohort_rows=8))
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Window .*\], \[cohort_key#\d+, piece#\d+L\], \[ts#", plan)
    over_pieces = re.findall(r"Window .*\], \[cohort_key#\d+\], \[(piece#.*)\]", plan)
    assert over_pieces and all("," not in order for order in over_pieces)


@pytest.mark.parametrize("limit, scans", [(1, 0), (8, 1)])
def test_large_cohorts_are_read_once_and_joined_with_nothing(spark, tmp_path, limit, scans):
    """Rows in pieces are read for the cut alone, and once more only where cohorts are ordinary."""
    four_cohorts(spark).write.parquet(str(tmp_path / "events"))
    stored = spark.read.parquet(str(tmp_path / "events"))
    plain = sequence_features(stored).orderBy(KEY).collect()
    frame = sequence_features(stored, Params(hot_cohort_rows=limit))
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(" parquet") == scans
    assert re.findall(r"Join (\w+)", plan) == ["LeftAnti"] * scans + ["LeftOuter"]
    assert frame.orderBy(KEY).collect() == plain


def test_rows_without_a_key_are_ordinary(spark):
    rows = run("2025-01-15T10:00:00", 30, 0.5, ip="a")
    events = events_from(spark, rows)
    events = events.unionByName(events.withColumn(KEY, F.lit(None).cast("string")))
    plain = sequence_features(events).orderBy(KEY).collect()
    assert [r[KEY] is None for r in plain] == [True, False]
    assert sequence_features(events, Params(hot_cohort_rows=8)).orderBy(KEY).collect() == plain


def test_signature_measures(spark):
    rows = [{"origin": o} for o in ("a", "a", "a", "b", "b", "c")]
    row = only(frequency_features(events_from(spark, rows), ["signature"], patterns=True))
    assert row["num_signatures"] == 3
    assert row["top_signature_share"] == 0.5
    assert row["repeat_ratio"] == 0.5
    assert [row[f"top_sig_{i}_count"] for i in (1, 2, 3)] == [3, 2, 1]
    assert row["top_sig_2_pct"] == pytest.approx(100 / 3)
    assert row["anomaly_high_repetition"] == 0.0         # fewer than ten events


def test_equal_signature_counts_fill_the_top(spark):
    rows = [{"origin": o} for o in ("a", "a", "b", "b", "c", "c", "d", "d")]
    row = only(frequency_features(events_from(spark, rows), ["signature"]))
    assert [row[f"top_sig_{i}_count"] for i in (1, 2, 3)] == [2, 2, 2]


def test_null_signatures(spark):
    events = events_from(spark, [{"origin": "a"}] * 3).withColumn(
        "payload_signature", F.when(F.col("row_id") > 0, F.col("payload_signature")))
    row = only(frequency_features(events, ["signature"]))
    assert row["num_signatures"] == 1
    assert row["top_signature_share"] == pytest.approx(2 / 3)
    assert row["top_sig_2_count"] is None
    none = only(frequency_features(events.withColumn(
        "payload_signature", F.lit(None).cast("string")), ["signature"]))
    assert (none["num_signatures"], none["top_signature_share"], none["repeat_ratio"]) == (0, 0, 0)
    assert none["top_sig_1_count"] is None


def test_patterns(spark):
    rows = [{"origin": "a"}] * 98 + [{"origin": "b"}, {"origin": "c"}]
    row = only(frequency_features(events_from(spark, rows), ["signature"], patterns=True))
    assert (row["anomaly_high_repetition"], row["anomaly_low_diversity"],
            row["anomaly_burst_pattern"]) == (1.0, 1.0, 0.0)


def test_route_diversity(spark):
    rows = [{"origin": o, "destination": d, "dep_date": day(n)} for o, d, n in (
        ("LAX", "NYC", 15), ("LAX", "NYC", 16), ("SFO", "NYC", 15), ("SFO", "CHI", 15))]
    row = only(frequency_features(events_from(spark, rows), ["route", "dep_date"]))
    assert (row["od_unique"], row["dep_dates_unique"]) == (3, 2)


def test_status_and_hygiene(spark):
    codes = events_from(spark, [{"status_code": float(c)} for c in (200, 200, 404, 500, 200)])
    row = only(tallies(codes, ["status"]))
    assert [row[c] for c in ("ok2xx_rate", "client4xx_rate", "server5xx_rate")] == [0.6, 0.2, 0.2]
    hygiene = events_from(spark, [
        {"cookie_present": c, "referrer": r} for c, r in zip(
            (True, True, False, False, True), ("r1", "r2", None, "", "r3"))])
    row = only(tallies(hygiene, ["hygiene"]))
    assert (row["cookie_rate"], row["referrer_rate"]) == (0.6, 0.8)


def test_rate_needs_its_minimum(spark):
    row = spark.range(1).select(rate(F.lit(1), F.lit(5), 10).alias("few"),
                                rate(F.lit(1), F.lit(5)).alias("enough"),
                                rate(F.lit(1), F.lit(0)).alias("none")).first()
    assert (row["few"], row["enough"], row["none"]) == (0.0, 0.2, 0.0)


def test_schedule_regularity(spark):
    assert only(tallies(events_from(spark, run("2025-01-15T10:00:00", 5, 900)), ["time"]))[
        "schedule_regular_times"] is True
    short = only(tallies(events_from(spark, run("2025-01-15T10:00:00", 4, 900)), ["time"]))
    assert (short["schedule_regular_times"], short["schedule_regularity_strength"]) == (False, 0.0)


def test_null_times_leave_the_histogram(spark):
    rows = [{"timestamp": at("2025-01-15T23:00:00")}, {"timestamp": None}]
    row = only(tallies(events_from(spark, rows), ["time"]))
    assert row["hourly_hist_23"] == 1.0
    assert row["night_share"] == 0.5


def test_two_identical_failing_events(spark):
    rows = [{"status_code": 500.0, "http_version": "unknown"}] * 2
    row = only(cohort_features(events_from(spark, rows), Params(min_events=1)))
    assert (row["n_events"], row["gap_p50"], row["top_signature_share"], row["ok2xx_rate"],
            row["server5xx_rate"], row["error_bursts"]) == (2, 0.0, 1.0, 0.0, 1.0, 2)


def test_minimum_size(spark):
    events = four_cohorts(spark)
    assert cohort_features(events, Params(min_events=10)).count() == 2
    assert cohort_features(events, Params(min_events=16)).count() == 0
    assert min_size_filter(events, 10).count() == 27


def test_orders(spark):
    def row_of(values):
        events = events_from(spark, [{"num_orders": float(v)} for v in values],
                             extra="num_orders double")
        return only(cohort_features(events, Params(min_events=1)))
    row = row_of([0, 1, 2, 1])
    assert row["total_orders"] == 4 and row["orders_per_event"] == 1.0
    assert (row["events_with_orders"], row["events_without_orders"]) == (3, 1)
    assert (row["unique_order_values"], row["max_orders_per_event"], row["min_orders_per_event"]) \
        == (3, 2.0, 0.0)
    assert (row["all_same_orders"], row["only_zero_or_one_orders"]) == (False, False)
    assert row["order_variance"] == pytest.approx(0.5)
    none = row_of([0, 0])
    assert (none["unique_order_values"], none["all_same_orders"],
            none["only_zero_or_one_orders"], none["order_variance"]) == (0, True, True, 0)


def test_absent_columns_give_defaults(spark):
    events = events_from(spark, run("2025-01-15T10:00:00", 3, 60)).select(
        "row_id", "timestamp", "site", "ip", KEY)
    row = only(cohort_features(events, Params(min_events=1)))
    assert (row["http11_share"], row["cookie_rate"], row["ok2xx_rate"]) == (0.0, 0.0, 1.0)
    assert (row["num_signatures"], row["ua_type_diversity"], row["device_diversity"]) == (0, 1, 1)
    assert (row["total_orders"], row["events_without_orders"], row["all_same_orders"]) == (0, 3, True)
    assert (row["unique_sessions"], row["ladder_sweep"], row["gap_p50"]) == (0, False, 60.0)


def test_modal_agent_and_first_row(spark):
    rows = [{"user_agent_full": f, "device_type": d} for f, d in (
        ("b", "Tablet"), ("a", "PC"), ("b", "PC"), ("a", "PC"), (None, "PC"))]
    events = events_from(spark, rows, extra="user_agent_full string, device_type string")
    row = only(leading_values(events))
    assert (row["ua_full"], row["ua_full_mode_share"]) == ("a", 0.4)
    assert row["device_type"] == "Tablet"
    empty = only(cohort_features(events.withColumn(
        "user_agent_full", F.lit(None).cast("string")), Params(min_events=1)))
    assert (empty["ua_full"], empty["ua_full_mode_share"], empty["ua_full_ip_diversity"],
            empty["ua_full_ip_diversity_ratio"]) == ("Unknown", 0.0, 1, 0.0)


def test_churn_counts_agents_of_an_address(spark):
    rows = [{"ip": "a", "user_agent": u} for u in ("x", "y", "y")] + [{"ip": "b"}]
    found = {r["ip"]: r["ua_churn_per_ip_day"] for r in ua_churn(events_from(spark, rows)).collect()}
    assert found == {"a": 2, "b": 1}


def test_row_order_and_partitions_do_not_matter(spark):
    events = four_cohorts(spark)
    plain = cohort_features(events).orderBy(KEY).collect()
    shuffled = events.orderBy(F.xxhash64("row_id")).repartition(7)
    assert cohort_features(shuffled).orderBy(KEY).collect() == plain


def test_hot_cohorts_do_not_change_features(spark):
    events = four_cohorts(spark)
    plain = cohort_features(events).orderBy(KEY).collect()
    assert cohort_features(events, Params(hot_cohort_rows=8)).orderBy(KEY).collect() == plain


@pytest.mark.parametrize("limit", [2, 8])
def test_features_take_no_task_for_each_piece(spark, monkeypatch, limit):
    events = four_cohorts(spark)
    plain = cohort_features(events).orderBy(KEY).collect()
    cuts = recorded_cuts(monkeypatch, type(events))
    assert cohort_features(events, Params(hot_cohort_rows=limit)).orderBy(KEY).collect() == plain
    cut, = cuts
    assert cut.rdd.getNumPartitions() == 1
    assert cut.select(KEY, "piece").distinct().count() >= cut.count() / (limit // 2)


def test_rows_of_few_tasks_are_dealt_out(spark):
    cores = spark.sparkContext.defaultParallelism
    rows = dealt_out(spark.range(1000).coalesce(1), "id")
    tasks = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert len(tasks) == cores and max(tasks) <= 2 * 1000 / cores
    assert sorted(r["id"] for r in rows.collect()) == list(range(1000))
    many = spark.range(1000, numPartitions=cores + 1)
    assert dealt_out(many, "id") is many


def test_ordinary_cohorts_are_shuffled_once_per_block(spark):
    events = four_cohorts(spark)
    for compute in (tallies, frequency_features, leading_values, ladder_sweep):
        frame = by_cohort(events, None, compute)
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1


def test_hot_rows_are_combined_before_every_shuffle(spark):
    """Every exchange of the tally and frequency blocks sits above a partial aggregate."""
    for frame in (tallies(four_cohorts(spark)), frequency_features(four_cohorts(spark))):
        plan = frame._jdf.queryExecution().sparkPlan().toString()
        executed = frame._jdf.queryExecution().executedPlan().toString().splitlines()
        assert "Window" not in plan
        for line, below in zip(executed, executed[1:]):
            if "Exchange hashpartitioning" in line:
                assert "HashAggregate" in below


def test_three_scans_and_three_event_shuffles(spark, tmp_path):
    """The plan reads and shuffles the events twice; once more for the written table of agents."""
    four_cohorts(spark).write.parquet(str(tmp_path / "events"))
    stored = spark.read.parquet(str(tmp_path / "events"))
    plan = cohort_features(stored)._jdf.queryExecution().executedPlan().toString().splitlines()
    kinds = [word for line in plan for word in ("FileScan parquet", "Exchange hashpartitioning")
             if word in line]
    # Lines go from the result down to the scans: each scan is under one exchange of its own.
    assert kinds.count("FileScan parquet") == 2
    below = [b for a, b in zip(kinds, kinds[1:]) if a == "Exchange hashpartitioning"]
    assert below.count("FileScan parquet") == 2
