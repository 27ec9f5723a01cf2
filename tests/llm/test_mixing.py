import itertools
import re

import pytest
from pyspark.sql import functions as F

from clickcohort.llm import mixing
from cases import clashing, documents, empty

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_targets_share_everything_and_stop_at_three_times():
    sizes = {"a": 10, "b": 1000, None: 5, "c": 200}
    found = mixing.targets(sizes, (1, 2, 3))
    assert sum(found.values()) == pytest.approx(1215)
    assert found[None] == 15 and all(found[s] <= 3 * n + 1e-9 for s, n in sizes.items())
    open_ones = {s: found[s] / w for s, w in zip(["a", "b", "c", None], (1, 2, 3, 1))
                 if found[s] < 3 * sizes[s] - 1e-9}
    assert max(open_ones.values()) == pytest.approx(min(open_ones.values()))
    assert mixing.targets({"a": 0}, (1,)) == {"a": 0.0}


def cost(flow, capacity):
    total = 0
    for p, f in flow.items():
        words = sum(f.values())
        for k in range(3):
            total += k * min(capacity[p], max(0, words - k * capacity[p]))
    return total


@pytest.mark.parametrize("capacity, quota", [
    ({("a",): 2, ("a", "b"): 2, ("b",): 1}, {"a": 3, "b": 3}),
    ({("a",): 1, ("b",): 3, ("a", "b"): 1}, {"a": 4, "b": 2}),
    ({("a", "b"): 2}, {"a": 5, "b": 3}),
])
def test_flow_is_cheapest(capacity, quota):
    found = mixing.min_cost_flow(capacity, quota)
    arcs = [(p, s) for p in capacity for s in p]
    best = None
    for amounts in itertools.product(*[range(quota[s] + 1) for _, s in arcs]):
        flow = {}
        for (p, s), x in zip(arcs, amounts):
            flow.setdefault(p, {})[s] = x
        if any(sum(f.values()) > 3 * capacity[p] for p, f in flow.items()):
            continue
        if any(sum(f.get(s, 0) for f in flow.values()) > quota[s] for s in quota):
            continue
        key = (-sum(amounts), cost(flow, capacity))
        best = key if best is None else min(best, key)
    assert (-sum(sum(f.values()) for f in found.values()), cost(found, capacity)) == best


def test_every_source_meets_its_target(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 23)), "xyz"[i % 3] if i % 5 else None)
            for i in range(400)]
    out = mixing.mix(documents(spark, rows)).collect()
    again = mixing.mix(documents(spark, rows).repartition(7)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    source = {i: s for i, _, s in rows}
    for name in {*source.values()}:
        own = [r for r in out if source[r["doc_id"]] == name]
        assert sum(r["size"] for r in own) == own[0]["source_size"]
        assert sum(r["taken"] for r in own) == pytest.approx(own[0]["target"], abs=0.5)
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in out)


def test_overlapping_sources(spark):
    docs = spark.createDataFrame(
        [(1, "a b c d", ["x"]), (2, "a b", ["x", "y"]), (3, "a b c", ["y", "y"]), (4, "z", [])],
        "doc_id bigint, text string, homes array<string>")
    rows = {r["doc_id"]: r for r in mixing.mix(docs, (1,), sources=F.col("homes")).collect()}
    assert rows[4]["taken"] == 0 and rows[4]["target"] is None
    # Sizes 6 and 5 make targets of 5.5 each, rounded up.
    assert sum(r["taken"] for r in rows.values()) == 12


def test_odd_documents(spark):
    out = mixing.mix(documents(spark)).collect()
    assert len(out) == 11
    assert {r["size"] for r in out if r["doc_id"] in (1, 2, 3)} == {0}
    assert sum(r["taken"] for r in out) == pytest.approx(sum(r["size"] for r in out), abs=2)
    copies = mixing.mixed_copies(documents(spark))
    assert copies.columns == documents(spark).columns
    assert copies.where("coalesce(trim(text), '') = ''").count() == 0
    assert mixing.mix(empty(spark)).count() == 0
    assert mixing.mixed_copies(empty(spark)).count() == 0


def test_names_of_other_columns_do_not_matter(spark):
    docs = clashing(spark)
    out = mixing.mixed_copies(docs, weights=(1,), repeats=3)
    assert out.columns == docs.columns
    known = {tuple(r) for r in docs.collect()}
    rows = [tuple(r) for r in out.collect()]
    assert rows and set(rows) <= known
    assert mixing.mix(docs).count() == docs.count()
