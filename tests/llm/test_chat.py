import hashlib
import json
import random

from pyspark.sql import functions as F

from clickcohort.llm import chat

ROWS = "conv_id bigint, turn bigint, role string, text string, formatted string, head string"


def wanted(turns):
    """turns: (turn, role, text) of one conversation, in order."""
    told = "".join(f"{r}\n{t}\n" for _, r, t in turns)
    learned = "".join(t for _, r, t in turns if r == "assistant")
    return (len(turns), hashlib.sha256(told.encode()).hexdigest(), len(learned),
            hashlib.sha256(learned.encode()).hexdigest())


def test_round_trip(spark, tmp_path):
    rng = random.Random(2)
    parts = ["<turn>", "</turn>", "<say>", "\\", "\n", "a", "é🙂", "</turn>\n", "<\\turn>", "$1", "<", ""]
    rows, talks = [], {}
    for conv in [*range(60), None]:
        for turn in range(rng.randint(1, 6)):
            role = rng.choice(["user", "assistant", "sys<turn>", None])
            text = rng.choice([None, "".join(rng.choices(parts, k=rng.randint(0, 12)))])
            for _ in range(rng.choice([1, 1, 1, 2])):
                rows.append((conv, turn if rng.random() > 0.1 else None, role, text, "x", "y"))
                talks.setdefault(conv, []).append((rows[-1][1], role or "", text or ""))
    rng.shuffle(rows)
    path = str(tmp_path / "out")
    chat.write_formatted([spark.createDataFrame(rows, ROWS)], path)
    back = chat.read_formatted(spark, path)
    out = {r["conv_id"]: r for r in chat.digests(back).collect()}
    assert out.keys() == talks.keys()
    for conv, turns in talks.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        row = out[conv]
        assert (row["n_turns"], row["turns_sha256"], row["loss_chars"], row["loss_sha256"]) \
            == wanted(turns)
    for row in back.collect():
        raw = row["formatted"].encode()
        for span in row["loss_spans"]:
            assert raw[span["stop"]:span["stop"] + 8] == b"</turn>\n"
            assert b"<turn>" not in raw[span["start"]:span["stop"]]


def test_layouts_of_tables(spark):
    turns = [(5, 0, "user", "q"), (5, 1, "assistant", "a")]
    frames = [
        spark.createDataFrame(turns, "conv_id bigint, turn int, role string, text string"),
        spark.createDataFrame([(5, [("user", "q"), ("assistant", "a")], "x")],
                              "conv_id bigint, messages array<struct<role: string, content: string>>, "
                              "extra string"),
        spark.createDataFrame([(5, [("human", "q"), ("gpt", "a")])],
                              "conv_id bigint, conversations array<struct<`from`: string, value: string>>"),
        spark.createDataFrame([(5, "q", "a")], "conv_id bigint, prompt string, response string"),
        spark.createDataFrame([(5, "q", "a")], "conv_id bigint, prompt string, completion string"),
        spark.createDataFrame([(5, "q", "a")], "conv_id bigint, instruction string, output string"),
    ]
    for frame in frames:
        assert sorted(map(tuple, chat.turns_of(frame).collect())) == turns
    try:
        chat.turns_of(spark.createDataFrame([(1, "x")], "conv_id bigint, body string"))
    except ValueError as error:
        assert "no layout" in str(error)
    else:
        raise AssertionError


def test_layouts_of_records(spark):
    records = [
        {"conv_id": 1, "messages": [{"role": "user", "content": "q", "more": 1}, {"role": "assistant", "content": None}]},
        {"conv_id": 2, "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"conv_id": 3, "instruction": "do", "input": "this", "output": "done", "id": "x"},
        {"conv_id": 4, "prompt": "q", "response": "a"},
        {"conv_id": 5, "messages": []},
        {"conv_id": 6, "turn": 0, "role": "user", "text": None},
        {"conv_id": 7, "body": "?"},
    ]
    frame = spark.createDataFrame([(json.dumps(r),) for r in records] + [("not json",), (None,)],
                                  "record string")
    turns, unknown = chat.turns_of_records(frame, "record")
    found = {}
    for r in turns.orderBy("conv_id", "turn").collect():
        found.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert found == {
        1: [("user", "q"), ("assistant", None)], 2: [("user", "q"), ("assistant", "a")],
        3: [("user", "do\n\nthis"), ("assistant", "done")],
        4: [("user", "q"), ("assistant", "a")], 6: [("user", None)]}
    assert unknown.count() == 3


def test_nothing(spark):
    none = spark.createDataFrame([], ROWS)
    assert chat.digests(chat.format_turns(chat.turns_of(none))).count() == 0
    assert spark.range(1).select(chat.unescape(chat.escape(F.lit(None).cast("string")))).first()[0] == ""
