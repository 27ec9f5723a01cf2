import random
import re

import numpy as np
import pytest

import clickcohort.llm.ngram_join as ngram_join
from clickcohort.llm.components import components
from clickcohort.llm.shingles import shingle_sets, word_hashes
from cases import clashing, documents, empty

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows, k, num, den):
    """Group of each row by its index."""
    sets = [shingles(t, k) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and den * both >= num * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    return [(rows[i][0], len(sets[i]),
             min((x for x in groups[find(i)] if x is not None), default=None))
            for i in range(len(rows))]


def corpus(seed, n=160):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(400)]
    shared = " ".join(rng.choices(vocabulary, k=12))
    rows, texts = [], []
    for i in range(n):
        kind = rng.random()
        if texts and kind < 0.6:
            words = rng.choice(texts).split()
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            text = " ".join(words)
        else:
            text = " ".join(rng.choices(vocabulary, k=rng.choice([3, 30, 60, 90])))
            if kind > 0.85:
                text += " " + shared
        texts.append(text)
        rows.append((i * 3 + 1, text, "a"))
    return rows


def key(row):
    return tuple((x is not None, x or 0) for x in row)


@pytest.mark.parametrize("k, num, den, block", [(3, 9, 10, 2048), (5, 4, 5, 2048), (3, 4, 5, 6)])
def test_groups_against_brute_force(spark, monkeypatch, k, num, den, block):
    monkeypatch.setattr(ngram_join, "_BLOCK", block)
    rows = corpus(k * num)
    out = ngram_join.near_groups(documents(spark, rows), k, num, den).select(
        "doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, out), key=key) == sorted(brute(rows, k, num, den), key=key)


def test_odd_documents(spark):
    rows = [(r[0], r[1], "a") for r in documents(spark).select("doc_id", "text").collect()]
    rows += [(None, "lonely null id two", "a")]
    docs = documents(spark, rows)
    out = ngram_join.near_groups(docs, 3, 9, 10)
    found = sorted((tuple(r) for r in out.select(
        "doc_id", "n_shingles", "component_id").collect()), key=key)
    assert found == sorted(brute(rows, 3, 9, 10), key=key)
    kept = ngram_join.without_near_copies(docs)
    assert kept.columns == docs.columns
    # Blank texts stay; of each group one; rows without an id are no group of their own.
    assert sorted(r[0] or 0 for r in kept.collect()) == [0, 0, 1, 2, 3, 4, 5, 6, 9]
    assert ngram_join.near_groups(empty(spark)).count() == 0
    assert ngram_join.without_near_copies(empty(spark)).count() == 0


def test_sets_that_share_a_name_stay_apart(spark, monkeypatch):
    whole = ngram_join._digests
    monkeypatch.setattr(ngram_join, "_digests", lambda found: (
        whole(found)[0] % 5, whole(found)[1]))
    rows = corpus(11)
    out = ngram_join.near_groups(documents(spark, rows), 3, 9, 10).select(
        "doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, out), key=key) == sorted(brute(rows, 3, 9, 10), key=key)


def test_columns_of_any_name_are_kept(spark):
    docs = clashing(spark)
    docs = docs.unionByName(docs.where("doc_id = 9"))
    kept = ngram_join.without_near_copies(docs)
    assert kept.columns == docs.columns
    rows = {r["doc_id"]: r for r in docs.collect()}
    # Texts of 0, 1 and 2 words repeated up to 6 times: one set only where the words are equal.
    found = kept.collect()
    assert sorted(r["doc_id"] for r in found) == list(range(30))
    assert all(r == rows[r["doc_id"]] for r in found)


def test_components(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 100), (70, 90), (90, 80), (None, 3)] + [
        (rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in links:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert {r["node"]: r["root"] for r in components(frame).collect()} == {x: find(x) for x in root}
    assert components(frame.where("a > 1000")).count() == 0


def test_word_hashes_do_not_depend_on_pieces(monkeypatch):
    import clickcohort.llm.shingles as module
    raw = np.frombuffer((" ".join(f"Wort{i} é" for i in range(500)) + "\n").encode(), np.uint8)
    whole = word_hashes(raw)
    monkeypatch.setattr(module, "_PIECE", 64)
    parts = word_hashes(raw)
    assert all((a == b).all() for a, b in zip(whole, parts))
    assert len(np.unique(whole[0])) == 501
    sets = list(shingle_sets([b"", b"a b", b"A  B", b"a b c", b"a b a b a b"], 3))
    assert [len(s) for s in sets] == [0, 1, 1, 1, 2] and sets[1] == sets[2]
