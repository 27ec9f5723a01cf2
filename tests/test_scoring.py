import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickcohort.operators import iforest, ranking, scoring
from clickcohort.operators.tallies import KEY
from clickcohort.params import Params
from clickcohort.plans import reports
from clickcohort.sources import lake

RULES = {
    # all suspicious, all harmless, in between; without events the volume adds nothing
    "n_events": [0, 0, 0],
    "night_share": [1.0, 0.0, 0.5],
    "hourly_entropy": [0.0, 4.0, 2.0],
    "top_signature_share": [1.0, 0.0, 0.6],
    "repeat_ratio": [1.0, 0.0, 0.2],
    "gap_p50": [0.0, 60.0, 15.0],
    "max_run_lt_1s": [10, 0, 5],
    "cookie_rate": [0.0, 1.0, 0.25],
    "referrer_rate": [0.0, 1.0, 0.75],
    "http11_share": [1.0, 0.0, 0.4],
    "http2_share": [0.0, 0.5, 0.96],
}

# Fixed values, published rows: inputs, then rule score, forest score, blend and band.
GOLDEN = [
    (263, 1.0, 1.0, 5, 7.626007666637631e-08, 0.3612167300380228, 0.2236842105263158,
     0.5847031709989969, 1.0, 0.7923515854994985, "High"),
    (377, 1.0, 1.0, 6, 7.626007666637631e-08, 0.3156498673740053, 0.2631578947368421,
     0.5958885786160141, 0.9648375207074564, 0.7803630496617353, "High"),
    (5, 0.0, 557.0, 0, 0.7219281679456272, 1.0, 0.18421052631578946,
     0.3593316457790786, 0.009585983359829898, 0.18445881456945426, "Low"),
]


def test_rule_scores(spark):
    rows = [(f"c{i}", *[v[i] for v in RULES.values()]) for i in range(3)]
    scored = scoring.add_scores(spark.createDataFrame(rows, [KEY, *RULES])).orderBy(KEY)
    # cadence, repetition, speed, hygiene, protocol by hand
    between = 0.2 * 0.5 + 0.3 * 0.4 + 0.2 * 0.625 + 0.15 * 0.5 + 0.1 * 1
    assert [r["rule_score"] for r in scored.collect()] == pytest.approx([0.95, 0.0, between])


def test_published_scores(spark):
    names = ["n_events", "night_share", "gap_p50", "max_run_lt_1s", "hourly_entropy",
             "ua_full_mode_share", "ua_full_ip_diversity_ratio", "rule", "iso", "blend", "band"]
    frame = spark.createDataFrame([(str(i), *row) for i, row in enumerate(GOLDEN)], [KEY, *names])
    for c in ("cookie_rate", "referrer_rate", "http11_share", "http2_share",
              "top_signature_share", "repeat_ratio"):
        frame = frame.withColumn(c, F.lit(0.0))
    for row in scoring.add_scores(frame, F.col("iso")).collect():
        assert row["rule_score"] == pytest.approx(row["rule"], abs=1e-12)
        assert row["botness"] == pytest.approx(row["blend"], abs=1e-12)
        assert row["risk_band"] == row["band"]


def test_only_volume(spark):
    frame = spark.createDataFrame([("a", 100)], [KEY, "n_events"])
    row = scoring.add_scores(frame).first()
    assert row["rule_score"] == pytest.approx(0.05 * math.log(101) / 10)
    assert row["iso_score"] == 0.0


def test_nulls_score_as_zero(spark):
    frame = spark.createDataFrame(
        [("a", None, None)], f"{KEY} string, gap_p50 double, max_run_lt_1s long")
    assert scoring.add_scores(frame).first()["rule_score"] == pytest.approx(0.1)


def test_bands(spark):
    frame = spark.createDataFrame(
        [(0.9,), (0.75,), (0.6,), (0.55,), (0.3,), (0.1,), (float("nan"),), (None,)], "s double")
    found = [r[0] for r in frame.select(scoring.risk_band(F.col("s"))).collect()]
    assert found == ["High", "High", "Medium", "Medium", "Low", "Low", "Low", "Low"]


def scored(spark, n=60):
    rows = [(f"k{i:02d}", i / n, i / n, i / n, ["Low", "Medium", "High"][i * 3 // n])
            for i in range(n)]
    return spark.createDataFrame(rows, [KEY, "rule_score", "iso_score", "botness", "risk_band"])


def test_statistics_and_counts(spark):
    stats = {r["score"]: r for r in scoring.score_statistics(scored(spark)).collect()}
    xs = np.arange(60) / 60
    assert stats["botness"]["mean"] == pytest.approx(xs.mean())
    assert stats["botness"]["std"] == pytest.approx(xs.std(ddof=1))
    assert (stats["botness"]["min"], stats["botness"]["max"]) == (0.0, 59 / 60)
    counts = {r["risk_band"]: r["cohorts"] for r in scoring.band_counts(scored(spark)).collect()}
    assert counts == {"High": 20, "Medium": 20, "Low": 20}


def test_reports_of_nothing(spark):
    empty = scored(spark).where(F.lit(False))
    rows = reports.risk_distribution(empty).collect()
    assert [(r["cohorts"], r["pct"]) for r in rows] == [(0, 0.0)] * 3
    assert scoring.scoring_issues(empty).count() == 0
    document = reports.report_document(empty, "2025-01-15").first()
    assert document["summary"]["high_risk_count"] == 0
    assert document["high_risk_cohorts"] == []


def test_issues(spark):
    good = scored(spark)
    assert scoring.scoring_issues(good).count() == 0
    bad = good.withColumns({
        "rule_score": F.when(F.col(KEY) == "k00", None).otherwise(F.col("rule_score")),
        "iso_score": F.col("iso_score") + 0.1,
        "risk_band": F.when(F.col(KEY) == "k01", "None").otherwise(F.col("risk_band"))})
    found = {r["issue"]: r["cohorts"] for r in scoring.scoring_issues(bad).collect()}
    assert found == {"missing rule_score": 1, "iso_score outside [0, 1]": 5,
                     "invalid risk_band": 1}


def test_ranking(spark):
    frame = scored(spark)
    assert [r[KEY] for r in ranking.top_of_band(frame, "High", 2).collect()] == ["k59", "k58"]
    top = ranking.top_per_band(frame, 3).collect()
    assert len(top) == 9
    assert {r[KEY] for r in top if r["risk_band"] == "Low"} == {"k19", "k18", "k17"}
    plan = ranking.top_per_band(frame, 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_document_lists_are_ordered(spark):
    document = reports.report_document(scored(spark), "2025-01-15", Params(top_n=3)).first()
    assert [r["cohort_key"] for r in document["high_risk_cohorts"]] == ["k59", "k58", "k57"]
    assert document["summary"]["medium_risk_count"] == 20
    assert document["metadata"]["total_cohorts"] == 60


# -- isolation forest ---------------------------------------------------------------

def cloud(spark, n=200):
    rng = np.random.default_rng(7)
    x, y = rng.normal(0, 1, n), rng.normal(0, 1, n)
    x[0], y[0] = 12.0, -12.0
    rows = [(f"k{i:04d}", float(x[i]), float(y[i]), 3.0) for i in range(n)]
    return spark.createDataFrame(rows, [KEY, "x", "y", "constant"])


SMALL = Params(n_trees=60, max_samples=0.8)


def flat(forest):
    return sorted(map(tuple, forest.nodes().collect()))


def test_forest_finds_the_outlier(spark):
    frame = cloud(spark)
    forest = iforest.fit_forest(frame, params=SMALL)
    assert forest.columns == ["constant", "x", "y"]
    assert forest.samples == 160
    assert forest.nodes().select("tree_id").distinct().count() == 60
    rows = {r[KEY]: r["iso_score"] for r in iforest.iso_scores(frame, forest).collect()}
    assert len(rows) == 200
    assert rows["k0000"] == 0.0 and max(rows.values()) == 1.0
    turned = {r[KEY]: r["iso_score"] for r in iforest.iso_scores(frame, forest, "anomaly").collect()}
    assert turned["k0000"] == 1.0
    assert turned["k0005"] == pytest.approx(1 - rows["k0005"])


def test_forest_does_not_depend_on_partitions(spark):
    frame = cloud(spark)
    first = iforest.fit_forest(frame, params=SMALL)
    second = iforest.fit_forest(frame.repartition(9, "x"), params=SMALL)
    assert flat(first) == flat(second)


def test_hash_is_sparks(spark):
    rng = np.random.default_rng(1)
    rows = rng.integers(-2 ** 63, 2 ** 63 - 1, (50, 3))
    frame = spark.createDataFrame([tuple(map(int, r)) for r in rows], "a bigint, b bigint, c bigint")
    wanted = [r[0] for r in frame.select(F.xxhash64("a", "b", "c")).collect()]
    assert iforest.hash_longs(rows[:, 0], rows[:, 1], rows[:, 2]).tolist() == wanted


def plain_path(x, members, tree, depth, node, columns, seed, limit):
    """Path lengths of all rows of one tree by plain recursion; ``members`` are its sample."""
    if not len(members):
        return {}
    rows = x[members[0]]
    low, high = rows.min(axis=0), rows.max(axis=0)
    varied = [f for f in columns if high[f] > low[f]]
    everyone = members[1]
    if len(rows) < 2 or not varied or depth >= limit:
        return {i: float(iforest.path_length(depth, np.array([len(rows)]))[0]) for i in everyone}
    feature = max(varied, key=lambda f: int(iforest.hash_longs(seed, tree, node, f)))
    cut = float(iforest.cut_place(seed, tree, node, low[feature], high[feature]))
    out = {}
    for child, side in ((2 * node, lambda v: v <= cut), (2 * node + 1, lambda v: v > cut)):
        part = [[i for i in m if side(x[i, feature])] for m in members]
        out |= plain_path(x, part, tree, depth + 1, child, columns, seed, limit)
    return out


@pytest.mark.parametrize("cell_rows, turn_bytes", [(10_000, 1 << 40), (8, 1 << 40), (30, 6_000)])
def test_paths_match_plain_recursion(spark, monkeypatch, cell_rows, turn_bytes):
    """However a tree is cut into levels and cells, every row has the path of the plain method."""
    n, trees, seed = 90, 5, 42
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(0, 1, (n, 3)), 1)
    x[:30] = x[0]               # a third of all rows are the same
    frame = spark.createDataFrame([(f"k{i:03d}", *map(float, x[i])) for i in range(n)],
                                  [KEY, "a", "b", "c"]).repartition(3)
    params = Params(n_trees=trees, max_samples=0.8, seed=seed)
    forest = iforest.fit_forest(frame, params=params, cell_rows=cell_rows, turn_bytes=turn_bytes)
    rows = frame.select(F.col(KEY).alias("key"))
    cuts = iforest.cut_offs(rows, n, 72, trees, seed)
    inside = {r[0]: r[1] for r in rows.select(
        "key", iforest._inside(range(trees), cuts, seed)).collect()}
    wanted = np.zeros(n)
    for tree in range(trees):
        sample = [i for i in range(n) if inside[f"k{i:03d}"][tree]]
        assert len(sample) == 72
        for i, path in plain_path(x, [sample, range(n)], tree, 0, 1, range(3), seed, 7).items():
            wanted[i] += path
    got = {r[KEY]: r["path"] for r in iforest.path_sums(
        frame, forest, group_bytes=4000, part_rows=25, turn_bytes=turn_bytes).collect()}
    assert got == {f"k{i:03d}": wanted[i] for i in range(n)}
    assert (forest.cells.where("cell > 1").count() > 0) == (cell_rows < 72)


def test_every_tree_gets_its_rows(spark):
    keys = cloud(spark).select(F.col(KEY).alias("key"))
    for samples in (1, 2, 100, 160, 199):
        cuts = iforest.cut_offs(keys, 200, samples, 30, 42)
        taken = keys.select(F.posexplode(iforest._inside(range(30), cuts, 42))).where("col")
        assert {r["count"] for r in taken.groupBy("pos").count().collect()} == {samples}
        assert taken.select("pos").distinct().count() == 30


def test_rows_per_tree_follow_one_rule():
    for n in (1, 50, 4_000, 4_167, 4_168, 10_000, 5_000_000):
        assert iforest.rows_per_tree(n, 0.8) == max(1, int(0.8 * n))
        assert iforest.rows_per_tree(n, 256) == min(256, n)


@pytest.mark.parametrize("n", [1000, 6000])
def test_trees_see_what_the_parameter_says(spark, n):
    frame = spark.range(n).select(F.format_string("k%06d", "id").alias(KEY),
                                  F.xxhash64("id").cast("double").alias("x"))
    forest = iforest.fit_forest(frame, params=Params(n_trees=3, max_samples=0.8))
    # Values differ, so every row ends in a leaf of its own unless the depth limit stops it.
    assert forest.samples == int(0.8 * n)
    assert iforest.fit_forest(frame, params=Params(n_trees=3, max_samples=64)).samples == 64


def test_default_trees_see_four_fifths_of_the_cohorts(spark):
    frame = cloud(spark, 1000)
    forest = iforest.fit_forest(frame, params=Params(n_trees=3))
    assert Params().max_samples == 0.8
    assert forest.samples == 800


def test_forest_degenerate_inputs(spark):
    frame = cloud(spark)
    assert iforest.fit_forest(frame.where(F.lit(False))) is None
    assert iforest.fit_forest(frame.select(KEY)) is None
    assert iforest.iso_scores(frame, None).agg(F.max("iso_score")).first()[0] == 0.0
    one = frame.limit(1)
    assert iforest.iso_scores(one, iforest.fit_forest(one, params=SMALL)).first()["iso_score"] == 0.0
    same = frame.select(KEY, "constant")
    flat = iforest.iso_scores(same, iforest.fit_forest(same, params=SMALL))
    assert flat.agg(F.max("iso_score")).first()[0] == 0.0


def test_stored_model_scores(spark, tmp_path):
    """Scores of a forest read back from its table, without a node on the driver."""
    frame = cloud(spark)
    for cell_rows in (1000, 20):
        forest = iforest.fit_forest(frame, params=SMALL, cell_rows=cell_rows)
        path = str(tmp_path / f"model{cell_rows}")
        lake.write_model(forest, path)
        again = iforest.Forest.from_table(spark.read.parquet(path))
        assert again.columns == forest.columns and again.samples == forest.samples
        a = iforest.iso_scores(frame, forest).orderBy(KEY).collect()
        assert iforest.iso_scores(frame, again).orderBy(KEY).collect() == a


def test_new_rows_are_scored_by_a_given_forest(spark):
    nodes = [(0, 0, 0, 1.5, 1, 2, 0.0), (0, 1, -1, 0.0, -1, -1, 2.0), (0, 2, -1, 0.0, -1, -1, 4.0),
             (1, 0, -1, 0.0, -1, -1, 1.0)]
    forest = iforest.forest_of_nodes(spark, nodes, ["v"], 8)
    frame = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", None), ("d", float("nan"))],
                                  [KEY, "v"])
    assert {tuple(r) for r in iforest.path_sums(frame, forest).collect()} == {
        ("a", 3.0), ("b", 5.0), ("c", 3.0), ("d", 3.0)}
