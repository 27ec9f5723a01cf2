import numpy as np
import pytest
from pyspark.sql import functions as F

from clickcohort.llm import topk

SCHEMA = "vec_id bigint, embedding array<float>, rank string, score string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "r", "s") for i, v in rows], SCHEMA)


def brute(rows, every, k):
    entries = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        entries.setdefault(i, []).append([int(np.floor(float(np.float32(x)) * 1024)) for x in v])
    out = []
    for q in entries:
        if q % every:
            continue
        best = []
        for i, vectors in entries.items():
            if i != q:
                best.append((-max(sum(a * b for a, b in zip(v, w)) for v in vectors
                                  for w in entries[q]), i))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(best)[:k])]
    return sorted(out)


def found(spark, rows, every=10, k=10, **options):
    out = topk.top_k(frame(spark, rows), F.col("vec_id") % every == 0, k=k, **options)
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in out.collect())


@pytest.mark.parametrize("block", [2048, 8])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "_BLOCK", block)
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 1, (6, 12))
    v = centres[rng.integers(0, 6, 400)] + rng.normal(0, 0.3, (400, 12))
    v[:100] /= np.linalg.norm(v[:100], axis=1)[:, None]
    v[150:210] = v[150]  # many equal vectors, so many ties
    rows = [(int(i) * 3, [float(x) for x in r]) for i, r in enumerate(v)]
    assert found(spark, rows, every=30, pivots=5) == brute(rows, 30, 10)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (10, [1.0]), (20, None), (30, [nan, 1.0]),
            (40, [inf, 0.0]), (50, [None, 1.0]), (None, [1.0, 1.0]), (60, []), (70, [0.5, -0.25]),
            (7, [3.0, 3.0]), (7, [4.0, 3.0]), (3, [1000.0, 0.001])]
    assert found(spark, rows, k=3) == brute(rows, 10, 3)
    assert found(spark, rows, k=100) == brute(rows, 10, 100)
    assert found(spark, []) == []
    assert found(spark, [(0, [1.0])]) == []


def test_large_numbers_stay_exact(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 1e5, 4)]) for i in range(60)]
    assert found(spark, rows) == brute(rows, 10, 10)


def test_long_vectors_take_part(spark, monkeypatch):
    monkeypatch.setattr(topk, "_QUERIES", 4)
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 1e3, 4)]) for i in range(40)]
    rows += [(100 + i, [float(np.float32(x)) for x in rng.normal(0, size, 4)])
             for i, size in enumerate([3e6, 3e6, 3e6, 1e12, 1e12, 1e30, 1e30, 3e37, 3e37, 3e37])]
    rows += [(110, [3e6, -3e6]), (110, [1.0, 2.0]), (110, [3e6, -3e6]), (120, [-1e38] * 3),
             (7, [1e20]), (130, [float("inf"), 1e30])]
    expected = [(q, rank, i, max(-2 ** 63, min(2 ** 63 - 1, score)))
                for q, rank, i, score in brute(rows, 10, 10)]
    assert found(spark, rows) == expected
    only = rows[-6:]
    assert found(spark, only) == [(q, rank, i, max(-2 ** 63, min(2 ** 63 - 1, score)))
                                  for q, rank, i, score in brute(only, 10, 10)]


def test_places_sort_like_numbers(spark):
    numbers = [0, 1, -1, 9, 10, -9, -10, 99, -123, 2 ** 62, -2 ** 62, 123456]
    frame = spark.createDataFrame([(n,) for n in numbers], "score bigint")
    found = {r["score"]: r["p"] for r in frame.select(
        "score", topk._place_of(F.col("score")).alias("p")).collect()}
    assert found == {n: topk._place(n) for n in numbers}
    more = numbers + [10 ** 80, -10 ** 80, 10 ** 80 + 1]
    assert sorted(more, key=topk._place) == sorted(more)
