"""Every catalog query against its SQL on the smallest driver tables."""

import json
from pathlib import Path

import pytest

from clickcohort import catalog
from clickcohort.catalog import QUERIES
from clickcohort.catalog_sql import ORACLES
from compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables not mounted")

WITHOUT_SQL = {"iforest_score", "forest_extract", "evidence_samples", "report_document"}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql_but_these():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_grown_forest_takes_part_in_bands(spark):
    rows = QUERIES["forest_extract"](spark, SF_DIR).collect()
    iso = {r["iso_score"] for r in rows}
    assert min(iso) == 0 and max(iso) == 1 and len(iso) > 2
    for r in rows:
        assert abs(r["botness"] - (r["rule_score"] + r["iso_score"]) / 2) < 2e-6
        assert r["risk_band"] == ("High" if r["botness"] >= 0.75 else
                                  "Medium" if r["botness"] >= 0.55 else "Low")


def test_reports_use_the_grown_forest(spark):
    """Samples and report agree with the cohorts that forest_extract scores."""
    scored = {r["cohort_key"]: r for r in QUERIES["forest_extract"](spark, SF_DIR).collect()}
    samples = QUERIES["evidence_samples"](spark, SF_DIR).collect()
    assert samples
    for r in samples:
        assert abs(r["botness_score"] - scored[r["cohort_key"]]["botness"]) < 2e-6
    summary = json.loads(QUERIES["report_document"](spark, SF_DIR).first()["summary"])
    for band in ("High", "Medium"):
        assert summary[f"{band.lower()}_risk_count"] == sum(
            r["risk_band"] == band for r in scored.values())


def test_entry(spark):
    import __spark_entry__
    assert __spark_entry__.entry(spark).count() > 0
    assert QUERIES.keys() <= __spark_entry__.queries().keys()


def test_features_of_large_cohorts_are_counted_on_all_cores(spark, monkeypatch):
    """However few tasks read the events; the rows are those that are read."""
    taken = []
    monkeypatch.setattr(
        catalog, "cohort_features", lambda events, params: taken.append(events) or events)
    catalog.features_of_large_cohorts(spark, SF_DIR)
    events, = taken
    assert events.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism > 1
    plain = catalog.click_events(spark, SF_DIR)
    assert plain.rdd.getNumPartitions() == 1
    assert events.orderBy("row_id").collect() == plain.orderBy("row_id").collect()
