import json
import random
import shutil
import zlib

import numpy as np
import pyarrow as pa
import pytest

from clickcohort.llm import token_counts, token_files
from clickcohort.llm.queries import COUNTER, ENCODER, tokenizer_file
from cases import documents, empty


def reference_ids(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_file(ENCODER))
    return [x.ids for x in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_encoding_by_words_is_the_librarys():
    random.seed(11)
    parts = list("aBz.,;:'!?%& \t\n\x0b<|>/-019éßΣσİı\u0301\u00a0\u2003中🙂≠ǅ\u0338") + [
        "<|endoftext|>", "<|ENDOFTEXT|>", "'s", "'LL", "\u0085", "ﬁ", "٣", "word", "Word,"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 25))) for _ in range(4000)]
    encoder = token_files.Encoder(tokenizer_file(ENCODER), 2)
    assert encoder.by_words and encoder.parts
    ids, counts = encoder(texts)
    at = 0
    for wanted, n in zip(reference_ids(texts), counts):
        assert ids[at:at + n].tolist() == [*wanted, 2]
        at += n


def same_ids(encoder, texts, wanted):
    ids, counts = encoder(texts)
    assert len(counts) == len(texts) and counts.sum() == len(ids)
    for end, n, expected in zip(np.cumsum(counts), counts, wanted):
        assert ids[end - n:end].tolist() == [*expected, 2]


def test_small_letters_go_straight_to_the_model():
    random.seed(12)
    encoder = token_files.Encoder(tokenizer_file(ENCODER), 2)
    letters = token_files._SMALL
    words = [*letters, *("".join(random.choices(letters, k=random.randint(2, 12)))
                         for _ in range(3000))]
    whole = []
    encoder._encoded, asked = lambda tokenizer, texts: (
        whole.extend(texts) if tokenizer is encoder.tokenizer else None) or asked(
        tokenizer, texts), encoder._encoded
    same_ids(encoder, [" ".join(words)], reference_ids([" ".join(words)]))
    assert not whole


def test_a_process_keeps_its_encoder_and_words(tmp_path):
    path = shutil.copy(tokenizer_file(ENCODER), tmp_path / "words.json")
    encoder = token_files.encoder_of(str(path), 2)
    text = "thether ontion was it 12 o'clock élan"
    same_ids(encoder, [text], reference_ids([text]))
    again, asked = token_files.encoder_of(str(path), 2), []
    assert again is encoder
    again._new, ask = lambda words: asked.extend(words.to_pylist()) or ask(words), again._new
    same_ids(again, [text, "was other"], reference_ids([text, "was other"]))
    assert asked == ["other"]
    with open(path, "a") as file:
        file.write("\n")
    assert token_files.encoder_of(str(path), 2) is not encoder


def test_words_used_last_stay_known(monkeypatch):
    encoder = token_files.Encoder(tokenizer_file(ENCODER), 2)
    monkeypatch.setattr(token_files, "_KNOWN_BYTES", 10_000)
    for at in range(20):
        texts = ["the and of", " ".join(f"x{at}y{i}" for i in range(60)), "z" * at * 400]
        same_ids(encoder, texts, reference_ids(texts))
        assert len(encoder.words) == len(encoder.coded) == len(encoder.used) < 400
    asked, ask = [], encoder._new
    encoder._new = lambda words: asked.extend(words.to_pylist()) or ask(words)
    same_ids(encoder, ["and the"], reference_ids(["and the"]))
    assert not asked


def test_an_added_token_of_letters_is_found_inside_words(tmp_path):
    from tokenizers import Tokenizer
    with open(tokenizer_file(ENCODER), encoding="utf-8") as file:
        told = json.load(file)
    told["added_tokens"].append({**told["added_tokens"][0], "id": 49408, "content": "foo"})
    path = tmp_path / "added.json"
    path.write_text(json.dumps(told), encoding="utf-8")
    texts = ["xfoox foo bar", "foo", "FOO foot"]
    found = Tokenizer.from_file(str(path)).encode_batch(texts, add_special_tokens=False)
    encoder = token_files.Encoder(str(path), 2)
    assert encoder.by_words
    same_ids(encoder, texts, [e.ids for e in found])


def test_other_tokenizers_encode_whole_texts():
    path = tokenizer_file("byte_bpe_50k.json")
    encoder = token_files.Encoder(path, 2)
    assert not encoder.by_words
    ids, counts = encoder(["a b", ""])
    assert counts.tolist() == [3, 1] and ids[-1] == 2


@pytest.mark.parametrize("length, batch", [(4, 2), (16, 3)])
def test_files_round_trip(spark, tmp_path, length, batch):
    docs, folder = documents(spark), f"file:{tmp_path}/tokens"
    manifest = token_files.write_tokens(docs, tokenizer_file(ENCODER), folder, 2, length, batch)
    out = token_files.read_documents(spark, manifest, folder).collect()
    rows = sorted(docs.select("doc_id", "text").collect(),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start, wanted = 0, []
    for row, ids in zip(rows, reference_ids([r["text"] for r in rows])):
        raw = np.array([*ids, 2], dtype="<u4").tobytes()
        wanted.append((row["doc_id"], start, len(ids) + 1, zlib.crc32(raw)))
        start += len(ids) + 1
    assert sorted(map(tuple, out), key=lambda r: r[1]) == wanted

    for row in manifest.collect():
        shard = token_files.ShardReader(folder, row["name"])
        assert {len(b) for b in shard.batches[:-1]} <= {batch}
        whole, at = shard.ids(), 0
        for i in range(len(shard)):
            ids, mask = shard.sequence(i)
            assert len(ids) == len(mask) == length and not ids.flags.owndata
            real = sum(mask.to_pylist())
            assert ids[:real].tolist() == whole[at:at + real].tolist()
            at += real
        assert at == len(whole) == row["n_ids"]
        assert isinstance(shard.batches[0].schema.field("mask").type, pa.FixedSizeListType)


@pytest.mark.parametrize("doc_id", [7, None])
def test_one_id_goes_to_several_shards(spark, tmp_path, doc_id):
    texts = sorted(f"{i * 7919 % 1000:03d} " + "word " * (i % 40) for i in range(400))
    docs = documents(spark, [(doc_id, t, "a") for t in reversed(texts)])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = token_files.write_tokens(docs, tokenizer_file(ENCODER), f"file:{tmp_path}/t")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert manifest.count() > 1
    rows = token_files.read_documents(spark, manifest, f"file:{tmp_path}/t").orderBy("start").collect()
    wanted = [np.array([*ids, 2], "<u4") for ids in reference_ids(texts)]
    assert [r["n_tokens"] for r in rows] == [len(ids) for ids in wanted]
    assert [r["ids_crc32"] for r in rows] == [zlib.crc32(ids.tobytes()) for ids in wanted]


def test_no_documents_no_files(spark, tmp_path):
    manifest = token_files.write_tokens(empty(spark), tokenizer_file(ENCODER), f"file:{tmp_path}/t")
    assert manifest.count() == 0
    assert token_files.read_documents(spark, manifest, f"file:{tmp_path}/t").count() == 0


def test_counts_and_cache(spark, tmp_path, monkeypatch):
    import sentencepiece
    docs, cache, path = documents(spark), f"{tmp_path}/cache", tokenizer_file(COUNTER)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    wanted = sorted(((r[0] or -1), len((r[1] or "").encode()), len(model.encode(r[1] or "")))
                    for r in docs.select("doc_id", "text").collect())

    def found():
        return sorted(((r[0] or -1), r[1], r[2])
                      for r in token_counts.count_tokens(docs, path, cache).collect())
    assert found() == wanted
    stamp = token_counts.version(path)
    held = spark.read.parquet(f"{cache}/version={stamp}")
    distinct = docs.selectExpr("coalesce(text, '') t").distinct().count()
    assert held.count() == distinct

    def refuse(_):
        raise AssertionError("a cached text was encoded again")
    monkeypatch.setattr(token_counts, "load", refuse)
    assert found() == wanted
    assert spark.read.parquet(f"{cache}/version={stamp}").count() == distinct


def test_counts_of_nothing_and_another_version(spark, tmp_path):
    path, cache = tokenizer_file(COUNTER), f"{tmp_path}/cache"
    assert token_counts.count_tokens(empty(spark), path, cache).count() == 0
    other = tokenizer_file("byte_bpe_50k.json")
    assert token_counts.version(other) != token_counts.version(path)
    out = token_counts.count_tokens(documents(spark), other, cache)
    assert {r["n_tokens"] for r in out.where("doc_id in (1, 2)").collect()} == {0}
