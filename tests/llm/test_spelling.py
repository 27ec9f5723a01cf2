import random
import re
import zlib
from collections import Counter

import pytest

from clickcohort.llm import spelling
from cases import documents, empty

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def edits_one(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def brute(docs, one_in=97, letters=5, least=3, times=2):
    n = Counter()
    for doc_id, text in docs:
        for run in RUN.findall(text or ""):
            low = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            if h % one_in == 0:
                low = low[:h % len(low)] + low[h % len(low) + 1:]
            n[low] += 1
    n = {w: c for w, c in n.items() if len(w) >= letters and c >= least}
    near = {w: [x for x in n if edits_one(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= times * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out)


def found(frame):
    return sorted(tuple(r) for r in frame.select("word", "form", "root", "n", "n_near", "form_n").collect())


def corpus(seed, letters="abcé"):
    rng = random.Random(seed)
    stems = ["".join(rng.choices(letters, k=rng.randint(4, 8))) for _ in range(120)] + [
        "aaaaaa", "aaaaa", "aaaaaaa", "Österreich", "österreich", "×÷×÷×"]
    docs = []
    for i in range(150):
        words = []
        for _ in range(60):
            w = stems[int(rng.random() ** 3 * len(stems))]
            j = rng.randrange(len(w))
            w = rng.choice([w, w, w, w.upper(), w[:j] + w[j + 1:], w[:j] + rng.choice(letters) + w[j:],
                            w[:j] + rng.choice(letters) + w[j + 1:]])
            words.append(w)
        docs.append((i if i % 9 else None, rng.choice([" ", "-", "1", "中"]).join(words)))
    return docs + [(3, None), (4, ""), (5, "12 34"), docs[7], docs[7]]


@pytest.mark.parametrize("slice_words", [4096, 3])
def test_against_brute_force(spark, slice_words):
    docs = corpus(1)
    got = spelling.variants(documents(spark, [(d, t, "a") for d, t in docs]), slice_words=slice_words)
    wanted = brute(docs)
    assert len({w[2] for w in wanted}) < len(wanted) and any(w[1] and w[1] != w[2] for w in wanted)
    assert found(got) == wanted


def test_other_settings(spark):
    docs = corpus(2, "ab")
    got = spelling.variants(documents(spark, [(d, t, "a") for d, t in docs]), one_in=5,
                            least_letters=2, least_count=1, times=1 + 1)
    assert found(got) == brute(docs, 5, 2, 1)


def test_bitsets_of_one_slice():
    rng = random.Random(4)
    words = list({"".join(rng.choices("abc", k=6)) for _ in range(300)})
    index = spelling.Slice(words)
    for length in (5, 6):
        for _ in range(200):
            word = "".join(rng.choices("abcd", k=length))
            assert sorted(index.one_error(word)) == sorted(w for w in words if edits_one(word, w))


def test_long_chains_are_followed(spark):
    # Each word twice as frequent as the one before it and one letter away.
    chain = ["a" * i + "b" * (12 - i) for i in range(10)]
    text = " ".join(w for i, w in enumerate(chain) for _ in range(3 << i))
    got = {r["word"]: r for r in spelling.variants(
        documents(spark, [(1, text, "a")]), one_in=1 << 40).collect()}
    assert len(got) == 10 and {r["root"] for r in got.values()} == {chain[-1]}
    assert got[chain[0]]["form"] == chain[1] and got[chain[-1]]["form"] is None


def test_empty_tables(spark):
    for docs in (empty(spark), documents(spark, [(1, None, "a"), (2, "only once here", "a")])):
        out = spelling.variants(docs)
        assert out.count() == 0
        assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
