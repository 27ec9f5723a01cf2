"""The registered queries on the driver's smallest tables."""

from pathlib import Path

import pytest

import corpus_pipeline
from clickcohort.llm.common import table
from clickcohort.llm.queries import QUERIES
from clickcohort.llm.queries_sql import ORACLES
from compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables not mounted")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) is None


def test_pipeline(spark):
    docs = table(spark, SF_DIR, "documents")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF_DIR).checkpoint()
        assert after.columns == columns, name
        if name != "mixing sources":
            assert 0 < after.count() <= before.count(), name
        before = after
    out = corpus_pipeline.STAGES[-1][1](spark, before, SF_DIR)
    assert out.count() == before.count()
    key = ["doc_id", "size", "text_crc32", "shard", "slot"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).select(key).collect())) == sorted(
        map(tuple, out.select(key).collect()))


def test_pipeline_on_odd_documents(spark):
    rows = [(9001, None, "en", "s", 0), (9002, "", "en", None, 0), (None, "word " * 9, "en", "s", 45)]
    odd = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs = table(spark, SF_DIR, "documents").select(odd.columns).unionByName(odd)
    for given in (docs, docs.where("false")):
        frame = given
        for _, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, SF_DIR).checkpoint()
        assert {"shard", "slot", "doc_id", "text"} <= set(frame.columns)
        assert (frame.count() > 0) == (given is docs)
