import zlib
from collections import defaultdict

import numpy as np
import pytest

from clickcohort.llm import packing
from clickcohort.llm.queries import ENCODER, tokenizer_file
from cases import documents, empty


def ids_of(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_file(ENCODER))
    return [[*x.ids, 2] for x in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_binary_lengths():
    for n in range(1, 300):
        pieces = packing.binary_lengths(n, 32)
        assert sum(pieces) == n and pieces == sorted(pieces, reverse=True)
        assert all(p & (p - 1) == 0 and p <= 32 for p in pieces)
        rest = [p for p in pieces if p < 32]
        assert len(set(rest)) == len(rest)


@pytest.mark.parametrize("length", [64, 4096])
def test_pieces_are_the_librarys_ids(spark, tmp_path, length):
    docs, folder = documents(spark).repartition(5), f"{tmp_path}/buckets"
    packing.write_buckets(docs, tokenizer_file(ENCODER), folder, 2, length)
    rows = packing.read_buckets(spark, folder).collect()
    held = docs.select("doc_id", "text").collect()

    # Every document is whole: the multiset of (doc_id, ids) is that of the library.
    wanted = sorted((r["doc_id"] or -1, tuple(x)) for r, x in zip(held, ids_of(
        [r["text"] for r in held])))
    by_doc = defaultdict(lambda: defaultdict(list))
    for r in rows:
        ids = np.frombuffer(r["ids"], f"<u{r['width']}").tolist()
        assert len(ids) == r["length"] and r["length"] & (r["length"] - 1) == 0
        assert r["length"] <= length and r["offset"] == 0
        by_doc[r["doc_id"] or -1][r["start"]].append((ids, r["doc_tokens"]))
    found = []
    for doc_id, starts in by_doc.items():
        copies = len(starts[0])  # rows that repeat have equal pieces
        ids = [i for s in sorted(starts) for i in starts[s][0][0]]
        for s, same in starts.items():
            assert len(same) == copies and all(x == same[0] for x in same)
            assert same[0][1] == len(ids)
        found += [(doc_id, tuple(ids))] * copies
    assert sorted(found) == wanted

    # Sequences are numbered without a gap, longest bucket first.
    numbers = sorted((r["sequence_id"], r["length"]) for r in rows)
    assert [n for n, _ in numbers] == list(range(len(rows)))
    assert [x for _, x in numbers] == sorted((x for _, x in numbers), reverse=True)

    sums = {r["sequence_id"]: r for r in packing.digests(
        packing.read_buckets(spark, folder)).collect()}
    for r in rows:
        raw = np.frombuffer(r["ids"], f"<u{r['width']}").astype("<u4").tobytes()
        assert sums[r["sequence_id"]]["ids_crc32"] == zlib.crc32(raw)

    if length == 64:
        one = packing.read_buckets(spark, folder, 4).select(rows[0].__fields__).collect()
        assert one and {tuple(r) for r in one} == {tuple(r) for r in rows if r["length"] == 4}


def test_nothing_and_wrong_lengths(spark, tmp_path):
    packing.write_buckets(empty(spark), tokenizer_file(ENCODER), f"{tmp_path}/none")
    out = packing.read_buckets(spark, f"{tmp_path}/none")
    assert out.count() == 0 and packing.digests(out).count() == 0
    with pytest.raises(ValueError):
        packing.write_buckets(empty(spark), tokenizer_file(ENCODER), f"{tmp_path}/x", length=100)


def test_a_hot_document_and_one_task(spark, tmp_path):
    rows = [(3, "alpha beta gamma " * 7, "a")] * 40 + [(i, "x " * i, "b") for i in range(20)]
    packing.write_buckets(documents(spark, rows).coalesce(1), tokenizer_file(ENCODER),
                          f"{tmp_path}/hot", length=8)
    out = packing.read_buckets(spark, f"{tmp_path}/hot").collect()
    assert sum(r["length"] for r in out) == sum(len(x) for x in ids_of([r[1] for r in rows]))
    assert sorted(r["sequence_id"] for r in out) == list(range(len(out)))
