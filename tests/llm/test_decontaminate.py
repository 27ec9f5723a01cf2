import random
from itertools import combinations

import corpus_pipeline
from clickcohort.llm import decontaminate
from clickcohort.llm.queries import QUERIES
from cases import clashing, documents, empty

VOCABULARY = [f"w{i}" for i in range(3000)]


def case(seed=6):
    rng = random.Random(seed)
    items = [(i, " ".join(rng.choices(VOCABULARY, k=rng.choice([15, 25, 40, 59])))) for i in range(40)]
    rows, leaks = [], set()
    for d in range(300):
        words = rng.choices(VOCABULARY, k=rng.randint(5, 3000 if d % 50 == 0 else 150))
        if d % 3 == 0:
            item, text = rng.choice(items)
            own = text.split()
            for at in rng.sample(range(len(own)), int(len(own) * rng.choice([0, 0.1, 0.2]))):
                own[at] = "changed"
            at = rng.randint(0, len(words))
            words[at:at] = [w.upper() for w in own]
            leaks.add((d, item))
        elif d % 3 == 1:  # seven words of an item are no leak
            words[2:2] = rng.choice(items)[1].split()[:7]
        rows.append((d, rng.choice([" ", "\n", " \t"]).join(words), "a"))
    return items, rows, leaks


def test_planted_passages(spark):
    items, rows, leaks = case()
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    out = decontaminate.overlaps(documents(spark, rows), benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in out} == leaks
    words = {d: t.lower().split() for d, t, _ in rows}
    told = {i: t.split() for i, t in items}
    for r in out:
        here = words[r["doc_id"]][r["doc_start"]:r["doc_start"] + r["n_words"]]
        assert r["matched"] == sum(a == b for a, b in zip(here, told[r["item_id"]]))
    clean = decontaminate.without_leaks(documents(spark, rows), benchmark)
    assert {r["doc_id"] for r in clean.collect()} == {d for d, _, _ in rows} - {d for d, _ in leaks}


def test_masks_find_one_word_in_five_changed():
    rng, missed = random.Random(1), 0
    for _ in range(600):
        length = rng.choice([15, 20, 37, 59])
        bad = set(rng.sample(range(length), length // 5))
        missed += not any(all(p + k not in bad for k in mask) for mask in decontaminate.MASKS
                          for p in range(length - mask[-1]))
    assert missed == 0


def test_cut_passage_and_long_text(spark):
    text = " ".join(VOCABULARY[:30])
    benchmark = spark.createDataFrame([(1, text), (2, text.upper()), (3, "too short to tell"), (4, None)],
                                      "item_id bigint, text string")
    filler = " ".join(f"f{i}" for i in range(5000))
    rows = [(1, " ".join(VOCABULARY[16:30]) + " " + filler, "a"),  # begins inside the passage
            (2, filler + " " + " ".join(VOCABULARY[:13]), "a"),      # ends inside it
            (3, filler + " " + text + " " + filler, "a"), (3, filler + " " + text + " " + filler, "a"),
            (None, text, "a"), (4, "too short to tell", "a"), (5, None, "a"), (6, "", "a")]
    out = decontaminate.overlaps(documents(spark, rows), benchmark).collect()
    assert sorted((r["doc_id"] or 0, r["item_id"], r["doc_start"], r["matched"]) for r in out) == [
        (0, 1, 0, 30), (1, 1, 0, 14), (2, 1, 5000, 13), (3, 1, 5000, 30)]


def test_odd_tables(spark):
    docs = documents(spark)
    benchmark = spark.createDataFrame([(1, "a b c d e f g h i j k l m n")], "item_id bigint, text string")
    assert decontaminate.overlaps(docs, benchmark).count() == 0
    assert decontaminate.without_leaks(docs, benchmark).count() == 11
    none = benchmark.where("item_id > 9")
    assert decontaminate.without_leaks(docs, none).columns == docs.columns
    assert decontaminate.overlaps(docs, none).count() == 0
    assert decontaminate.overlaps(empty(spark), benchmark).count() == 0


def test_columns_of_any_name_are_kept(spark):
    docs = clashing(spark)
    benchmark = spark.createDataFrame([(1, "word6 " * 6), (2, "nothing of this")],
                                      "item_id bigint, text string")
    kept = decontaminate.without_leaks(docs, benchmark, short_items=True)
    assert kept.columns == docs.columns
    assert sorted(kept.collect()) == sorted(docs.where("doc_id <> 6").collect())


def test_masks_find_every_change_of_short_passages():
    for length in range(8, 14):
        for bad in combinations(range(length), length // 5):
            assert any(all(p + k not in bad for k in mask) for mask in decontaminate.MASKS
                       for p in range(length - mask[-1])), (length, bad)


def leaks_by_hand(items, rows):
    """Every item laid on every diagonal of every document."""
    out = set()
    for d, text, _ in rows:
        here = (text or "").lower().split()
        for i, told in items:
            there = told.lower().split()
            for diagonal in range(-len(there), len(here)):
                equal = sum(0 <= diagonal + k < len(here) and here[diagonal + k] == w
                            for k, w in enumerate(there))
                if equal * 100 >= len(there) * 80:
                    out.add((d, i))
    return out


def test_short_items_by_hand(spark, tmp_path):
    rng = random.Random(3)
    items = [(n, " ".join(f"s{n}x{k}" for k in range(n))) for n in range(1, 11)]
    rows = []
    for d in range(120):
        words = rng.choices(VOCABULARY, k=rng.choice([0, 1, 5, 40, 1030]))
        own = rng.choice(items)[1].split()
        for at in rng.sample(range(len(own)), min(len(own), rng.choice([0, 1, 1, 2]))):
            own[at] = "changed"
        at = rng.choice([0, len(words), rng.randint(0, len(words))])
        words[at:at] = own[rng.choice([0, 0, 0, 1]):]
        rows.append((d, " ".join(words), "a"))
    rows += [(600 + n, f"before {text} after", "a") for n, text in items]
    rows += [(500, "s1x0 " * 3000, "a"), (501, items[4][1].upper(), "a"), (502, None, "a")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    docs = documents(spark, rows)
    expected = leaks_by_hand(items, rows)
    out = decontaminate.overlaps(docs, benchmark, short_items=True).collect()
    assert {(r["doc_id"], r["item_id"]) for r in out} == expected
    assert {i for _, i in expected} == set(range(1, 11))
    clean = decontaminate.without_leaks(docs, benchmark, short_items=True)
    assert {r["doc_id"] for r in clean.collect()} == {d for d, _, _ in rows} - {d for d, _ in expected}
    # The registered query and the stage take short items too.
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))
    asked = QUERIES["op10_decontaminate"](spark, str(tmp_path)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in asked} == expected
    kept = corpus_pipeline.decontamination(spark, docs, str(tmp_path))
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in clean.collect()}


def test_wide_tables_are_not_broadcast(spark, monkeypatch):
    """By bytes as well as rows; nulls and empty lists count as nothing."""
    from clickcohort.llm import common

    def hinted(frame):
        return "broadcast" in common.small(frame)._jdf.queryExecution().logical().toString()
    frame = spark.createDataFrame(
        [(1, "a" * 500, ["b" * 500], [1.0] * 30), (2, None, None, None), (3, "", [None], [])],
        "id long, text string, words array<string>, numbers array<double>")
    assert hinted(frame) and hinted(frame.limit(0))
    monkeypatch.setattr(common, "BROADCAST_BYTES", 1500)
    assert not hinted(frame) and hinted(frame.select("id", "text"))
    monkeypatch.setattr(common, "BROADCAST_ROWS", 2)
    assert not hinted(frame.select("id"))
