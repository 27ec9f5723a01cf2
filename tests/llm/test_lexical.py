import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from clickcohort.llm import lexical
from cases import documents, empty

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return TERM.findall(low)


def brute(docs, items, k):
    held = [(d, Counter(terms(t))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    N, L = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item_id, text in items:
        rows = []
        for d, c in held:
            m = 75 + 25 * c.total() * N // L
            score = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1)))
                        * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if score > 0:
                rows.append((-score, d is None, d or 0, d))
        out += [(item_id, i + 1, r[3], -r[0]) for i, r in enumerate(sorted(rows)[:k])]
    return sorted(out, key=str)


def found(frame):
    return sorted((tuple(r) for r in frame.select("item_id", "rank", "doc_id", "score").collect()),
                  key=str)


def test_terms():
    for text in ("aB-c É Éx 中文🙂 1\x7f2\x00", "", None, "ÀÉ_x [z]`q{w"):
        assert [t.decode() for t in lexical.terms_of(text)] == terms(text)


@pytest.mark.parametrize("k, run, block", [(3, 40, 10_000), (20, 10**6, 30), (1, 1, 1)])
def test_against_brute_force(spark, monkeypatch, k, run, block):
    monkeypatch.setattr(lexical, "_FIRST_DEPTH", 2)
    rng = random.Random(5)
    words = [f"w{int(i)}" for i in np.arange(60)] + ["the"] * 80 + ["É", "Ab", "ab"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 30)))) for i in range(120)]
    docs += [(7, docs[7][1]), (None, "w1 w2 the"), (None, "w1 w2 the"), (500, None), (501, " ,;"),
             (502, "the " * 3000 + "w3"), *((600 + i, "w4 w5 the") for i in range(40))]
    rng.shuffle(docs)
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for i in range(9)]
    items += [(3, "w1 w1 the"), (3, "w1 w1 the"), (None, "AB é"), (20, None), (21, "unknown"),
              (22, ""), (23, "w4, w5"), (24, " ".join(words))]
    frame = documents(spark, [(d, t, "a") for d, t in docs]).repartition(3)
    asked = spark.createDataFrame([(i, t, 1, 2) for i, t in items],
                                  "item_id bigint, text string, rank int, item int")
    got = lexical.rank(frame, asked, k, block, run)
    assert found(got) == brute(docs, items, k)


def test_bounds_stop_reading_early():
    """Rare terms settle the best documents before the common list is read through."""
    rng = np.random.default_rng(3)
    size = 20_000
    n = rng.integers(50, 80, size)
    terms_, counts, starts = [], [], [0]
    for d in range(size):
        own = [0] + ([1, 2] if d % 1000 == 0 else [])
        terms_ += own
        counts += [1 + d % 3] * len(own)
        starts.append(len(terms_))
    weights = lexical.Weights(size, int(n.sum()), np.array([size, 20, 20]))
    run = lexical.Run(n, np.array(starts), np.array(terms_), np.array(counts), weights,
                      weights.of_terms())
    docs, scores = run.best(np.array([0, 1, 2]), np.array([1, 1, 1]), 5, 1)
    assert set(docs.tolist()) <= set(range(0, size, 1000)) and len(docs) >= 5
    floor = int(np.sort(scores)[-5])
    again, _ = run.best(np.array([0]), np.array([1]), 5, floor)
    assert not len(again)       # the common term alone never reaches the floor


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "one two")], "item_id bigint, text string")
    assert lexical.rank(empty(spark), items).count() == 0
    out = lexical.rank(documents(spark), items.where("false"))
    assert out.count() == 0 and out.columns == ["item_id", "rank", "doc_id", "score"]
