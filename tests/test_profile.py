import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickcohort.operators import profile, quantiles
from clickcohort.operators.quantiles import exact_quantiles
from clickcohort.operators.tallies import KEY

PROBS = (0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0)

COLUMNS = {
    "uniform": lambda rng, n: rng.uniform(-5, 5, n),
    "heavy": lambda rng, n: np.exp(rng.normal(0, 8, n)),
    "ties": lambda rng, n: rng.integers(0, 4, n).astype(float),
    "one_hot": lambda rng, n: np.where(np.arange(n) % 3 > 0, 1.0, rng.normal(1, 1e-9, n)),
    "huge": lambda rng, n: rng.choice([-1.7e308, 0.0, 1.7e308], n),
    "tiny": lambda rng, n: rng.choice([0.0, 5e-324, 1e-323], n),
}


@pytest.mark.parametrize("n", [1, 2, 3, 1000])
def test_exact_quantiles(spark, n):
    rng = np.random.default_rng(n)
    data = {name: make(rng, n) for name, make in COLUMNS.items()}
    frame = spark.createDataFrame([tuple(float(c[i]) for c in data.values()) for i in range(n)],
                                  list(data))
    found = exact_quantiles(frame, list(data), PROBS)
    for name, xs in data.items():
        ordered = np.sort(xs)
        for p, got in zip(PROBS, found[name]):
            place = p * (n - 1)
            low, high = ordered[math.floor(place)], ordered[math.ceil(place)]
            part = place - math.floor(place)
            assert got == pytest.approx(low * (1 - part) + high * part, rel=1e-12, abs=1e-322)


def test_quantiles_skip_nulls_and_nan(spark):
    frame = spark.createDataFrame([(1.0, None), (None, None), (float("nan"), None), (3.0, None)],
                                  "x double, empty double")
    assert exact_quantiles(frame, ["x", "empty"], [0.5]) == {"x": [2.0], "empty": None}


def test_robust_stats(spark):
    xs = [1.0, 2.0, 2.0, 3.0, 10.0]
    frame = spark.createDataFrame([(x, None) for x in xs] + [(float("nan"), None)],
                                  "x double, empty double")
    rows = {r["column"]: r for r in profile.robust_stats(frame).collect()}
    row, centred = rows["x"], np.array(xs) - np.mean(xs)
    m2 = (centred ** 2).mean()
    assert row["n"] == 5 and row["median"] == 2.0 and row["iqr"] == 1.0
    assert row["std"] == pytest.approx(np.std(xs))
    assert row["skewness"] == pytest.approx((centred ** 3).mean() / m2 ** 1.5)
    assert row["kurtosis"] == pytest.approx((centred ** 4).mean() / m2 ** 2 - 3)
    empty = rows["empty"].asDict()
    assert {k: v for k, v in empty.items() if k != "column"} == dict.fromkeys(
        ("n", "mean", "median", "std", "q25", "q75", "iqr", "skewness", "kurtosis"), 0)
    short = profile.robust_stats(spark.createDataFrame([(1.0,), (2.0,)], "x double")).first()
    assert (short["skewness"], short["kurtosis"]) == (0.0, 0.0)


def test_normalize(spark):
    frame = spark.createDataFrame([(1.0, 5, "a"), (2.0, 5, "b"), (4.0, 5, "c")],
                                  "x double, flat int, label string")
    minmax = profile.normalize(frame, "minmax").orderBy("label").collect()
    assert [r["x"] for r in minmax] == pytest.approx([0, 1 / 3, 1])
    assert [r["flat"] for r in minmax] == [0.0] * 3
    standard = profile.normalize(frame, "standard").orderBy("label").collect()
    xs = np.array([1.0, 2.0, 4.0])
    assert [r["x"] for r in standard] == pytest.approx(list((xs - xs.mean()) / xs.std()))
    robust = profile.normalize(frame).orderBy("label").collect()
    assert [r["x"] for r in robust] == pytest.approx(list((xs - 2) / 1.5))
    with pytest.raises(ValueError):
        profile.normalize(frame, "other")


def test_correlation(spark):
    frame = spark.createDataFrame(
        [(1.0, 2.0, 7.0), (2.0, 4.1, 7.0), (3.0, 5.9, 7.0), (4.0, None, 7.0)],
        "a double, b double, flat double")
    rows = {(r["column_a"], r["column_b"]): r["correlation"]
            for r in profile.correlation_pairs(frame).collect()}
    assert rows[("a", "b")] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4.1, 5.9])[0, 1])
    assert rows[("a", "flat")] is None
    high = profile.correlation_pairs(frame, threshold=0.95).collect()
    assert [(r["column_a"], r["column_b"]) for r in high] == [("a", "b")]
    matrix = {(r["column_a"], r["column_b"]): r["correlation"]
              for r in profile.correlation_matrix(frame).collect()}
    assert len(matrix) == 9
    assert matrix[("b", "a")] == matrix[("a", "b")] and matrix[("a", "a")] == 1.0
    assert matrix[("flat", "flat")] is None


def orders(spark):
    rows = [("c1", v) for v in (1, 1, 1, 1, 1)] + [("c2", v) for v in (0, 1, 0, 0, 1)] \
        + [("c3", 0)] * 20 + [("c4", 2)]
    return spark.createDataFrame([(k, float(v), int(v > 0)) for k, v in rows],
                                 f"{KEY} string, num_orders double, has_order int")


def test_order_audit(spark):
    audit = profile.order_audit(orders(spark))
    rows = {r[KEY]: r for r in audit.collect()}
    assert rows["c1"]["identical_orders"] and not rows["c1"]["only_zero_one"]
    assert rows["c2"]["only_zero_one"] and not rows["c2"]["identical_orders"]
    assert rows["c3"]["high_volume_no_orders"] and rows["c3"]["identical_orders"]
    assert not rows["c4"]["identical_orders"]
    summary = {r["suspicion"]: r["cohorts"] for r in profile.order_audit_summary(audit).collect()}
    assert summary == {"identical_orders": 2, "only_zero_one": 2, "high_volume_no_orders": 1}
    assert [r[KEY] for r in profile.order_audit_examples(audit, "identical_orders", 1).collect()] == ["c1"]


def test_order_tables(spark):
    total = profile.order_totals(orders(spark)).first()
    assert (total["events"], total["total_orders"], total["events_with_orders"]) == (31, 9.0, 8)
    spread = profile.order_distribution(orders(spark), 2).collect()
    assert [(r["num_orders"], r["events"]) for r in spread] == [(0.0, 23), (1.0, 7)]
    groups = profile.orders_by(orders(spark), KEY).collect()
    assert groups[1]["mean_orders"] == 0.4 and groups[1]["conversion_pct"] == 40.0
    empty = profile.order_totals(orders(spark).where(F.lit(False))).first()
    assert (empty["events"], empty["conversion_pct"]) == (0, None)


def test_agent_tables(spark):
    events = spark.createDataFrame(
        [(1, "PC", "Bot", "new", 5), (1, "iphone", "Application", "old", 2), (2, None, None, "b", 3),
         (None, "Tablet", "Web Browser", "c", 4)],
        "user_agent_id long, device_type string, user_agent_type string, user_agent string, row_id long")
    counts = profile.value_counts(events, "user_agent_type").collect()
    assert [(r["value"], r["events"], r["pct"]) for r in counts] == [
        ("Application", 1, 25.0), ("Bot", 1, 25.0), ("Web Browser", 1, 25.0)]
    totals = {r["client"]: r["events"] for r in profile.client_totals(events).collect()}
    assert totals == {"bot": 1, "application": 1, "web_browser": 1, "mobile": 2, "desktop": 1}
    top = profile.top_user_agent_ids(events).collect()
    assert [(r["user_agent_id"], r["events"], r["browser"]) for r in top] == [(1, 2, "old"), (2, 1, "b")]
    dimension = spark.createDataFrame([(1, "Chrome", "Bot", "PC", "X")],
                                      "id long, browserModel string, userAgentType string, device string, osType string")
    found = {r["user_agent_id"]: r["browser_model"]
             for r in profile.user_agent_distribution(events, dimension).collect()}
    assert found == {1: "Chrome", 2: "Unknown"}


def test_quantiles_of_infinite_values(spark):
    inf = float("inf")
    frame = spark.createDataFrame([(-inf,), (1.0,), (2.0,), (inf,), (3.0,), (inf,)], "v double")
    assert exact_quantiles(frame, ["v"], (0.0, 0.2, 0.4, 0.6, 1.0))["v"] == [-inf, 1.0, 2.0, 3.0, inf]
    only = spark.createDataFrame([(inf,), (inf,)], "v double")
    assert exact_quantiles(only, ["v"], (0.5,))["v"] == [inf]


def test_correlation_names_every_pair(spark):
    frame = spark.createDataFrame(
        [(1.0, 2.0, None), (2.0, 4.0, None), (None, 1.0, 5.0), (None, 3.0, 6.0)],
        "a double, b double, c double")
    matrix = {(r["column_a"], r["column_b"]): r["correlation"]
              for r in profile.correlation_matrix(frame).collect()}
    assert len(matrix) == 9
    assert matrix["a", "b"] == pytest.approx(1.0) and matrix["a", "c"] is None


def test_quantiles_read_the_rows_twice(spark, monkeypatch):
    """Brackets from the sketch; also where they miss, the results are exact."""
    read = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(value):
        read.add(1)
        return value
    n = 3000
    monkeypatch.setattr(quantiles, "SHORT", 100)
    rng = np.random.default_rng(2)
    values = np.round(rng.normal(0, 50, n), 1)
    frame = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(3).select(
        seen("v").alias("v"))
    probs = (0.0, 0.1, 0.25, 0.5, 0.9, 1.0)
    found = quantiles.exact_quantiles(frame, ["v"], probs)["v"]
    assert found == pytest.approx(np.quantile(values, probs).tolist(), abs=1e-9)
    assert read.value == 2 * n
    monkeypatch.setattr(quantiles, "ACCURACY", 1_000_000_000)   # brackets too narrow to hold ranks
    monkeypatch.setattr(quantiles.F, "percentile_approx", lambda c, p, a: F.array(
        *[F.lit(0.05)] * len(p)))
    found = quantiles.exact_quantiles(frame, ["v"], probs)["v"]
    assert found == pytest.approx(np.quantile(values, probs).tolist(), abs=1e-9)


def _pairwise(values):
    """Correlations by numpy over the rows that hold both, pair by pair."""
    wide = values.shape[1]
    out = np.full((wide, wide), np.nan)
    for i in range(wide):
        for j in range(wide):
            both = ~np.isnan(values[:, i]) & ~np.isnan(values[:, j])
            x, y = values[both, i], values[both, j]
            if len(x) and np.ptp(x) > 0 and np.ptp(y) > 0:
                out[i, j] = np.corrcoef(x, y)[0, 1]
    return out


def test_correlation_of_many_columns_reads_once(spark):
    """40 columns, 780 pairs: gaps, far means, parts of unequal level; one scan."""
    read = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(value):
        read.add(1)
        return value
    rng = np.random.default_rng(3)
    n, wide = 600, 40
    values = rng.normal(0, 1, (n, wide)) + rng.normal(0, 1, (n, 1))
    values[:, 1] += 1e8                                   # mean far above the spread
    values[: n // 2, 2] += 50                             # partitions of different level
    values[rng.random((n, wide)) < 0.2] = np.nan
    values[::3, 9] = values[::3, 8] = np.nan   # 7 is near 0 for 9, 8 half constant
    values[: n // 2, 4], values[n // 2:, 5] = np.nan, np.nan   # no common row
    values[:, 6] = 0.1
    values[::3, 7], values[1::3, 7], values[1::3, 8] = 1e9, np.round(values[1::3, 7], 3), 0.3
    names = [f"v{i}" for i in range(wide)]
    frame = spark.createDataFrame(
        [tuple(None if np.isnan(v) else float(v) for v in row) for row in values],
        ", ".join(f"{c} double" for c in names)).repartitionByRange(5, "v0")
    frame = frame.withColumn("v0", seen("v0"))
    expected = _pairwise(values)
    rows = profile.correlation_matrix(frame, names).collect()
    assert read.value == n
    assert len(rows) == wide * wide
    for r in rows:
        want = expected[names.index(r["column_a"]), names.index(r["column_b"])]
        if np.isnan(want):
            assert r["correlation"] is None, r
        else:
            assert r["correlation"] == pytest.approx(want, abs=1e-6), r


@pytest.mark.parametrize("few", [0, 10])
def test_correlation_in_both_forms(spark, monkeypatch, few):
    """One aggregate or masked products: the same results, on odd inputs too."""
    from clickcohort.operators import comoments

    rng = np.random.default_rng(5)
    values = rng.normal(5, 2, (200, 3))
    frame = spark.createDataFrame([tuple(map(float, r)) for r in values],
                                  "`x.y` double, b double, part double").repartition(7)
    monkeypatch.setattr(comoments, "GROUPS", 2)
    monkeypatch.setattr(profile, "_FEW_COLUMNS", few)
    found = {(r["column_a"], r["column_b"]): r["correlation"]
             for r in profile.correlation_pairs(frame).collect()}
    assert found["x.y", "part"] == pytest.approx(np.corrcoef(values[:, 0], values[:, 2])[0, 1])
    empty = profile.correlation_pairs(frame.limit(0)).collect()
    assert len(empty) == 3 and all(r["correlation"] is None for r in empty)
    assert profile.correlation_pairs(frame, ["b"]).collect() == []
    odd = spark.createDataFrame(
        [(1.0, 2.0, float("inf")), (2.0, 4.0, 1.0), (float("nan"), 1.0, 2.0), (3.0, 6.0, 0.5)],
        "a double, b double, c double")
    cells = {(r["column_a"], r["column_b"]): r["correlation"]
             for r in profile.correlation_pairs(odd).collect()}
    assert cells["a", "b"] == pytest.approx(1.0)          # an infinite c spoils its own pairs only
    assert np.isnan(cells["a", "c"])
