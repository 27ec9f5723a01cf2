"""Documents that every operator must bear."""

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
          "size bigint, shard int, `class` string, gram string, row_key string, _size string")

LONG = " ".join(f"w{i % 997}x{i % 89}" for i in range(30_000))


def documents(spark, rows=None):
    """(doc_id, text, source) with extra columns whose names operators use themselves."""
    if rows is None:
        rows = [
            (1, None, "a"), (2, "", "a"), (3, " \t\n ", "b"), (4, "one two", "b"),
            (5, "Eins ZWEI drei vier fünf sechs", None), (5, "Eins ZWEI drei vier fünf sechs", None),
            (6, LONG, "a"), (7, LONG + " end", "c"), (None, "no id here at all", "c"),
            (8, "one two", "a"), (9, "\u00a0odd\u2003space 中文 🙂", "b"),
        ]
    full = [(i, t, "en", s, len(t or ""), 7, 1, "x", "y", "z", "q") for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def empty(spark):
    return documents(spark, [])


#: Names that operators use for columns of their own.
TAKEN_NAMES = (
    "times", "rest", "left", "edge1", "edge2", "bin", "words", "before", "_first", "_rank", "_end",
    "_size", "_crc", "_at", "_arc", "_class", "_shard", "_in", "_row", "_member", "_pattern",
    "_order", "_bin1", "_bin2", "_copy", "_taken", "_target", "_source_size", "_moved", "_cuts",
    "_owners", "label", "x", "score", "count", "gone", "_gone", "again", "_again", "_key", "leaked",
    "_leaked", "row_key", "class", "second", "sketch", "group", "component", "component_id", "n",
    "tokens", "seed", "at", "diagonal", "piece", "item_id", "h", "p", "w", "base")


def clashing(spark):
    """Documents with a column of every such name; each row has values of its own."""
    rows = [(i, f"word{i} " * (i % 7), "ab"[i % 2], *(f"{name}-{i}" for name in TAKEN_NAMES))
            for i in range(30)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, " + ", ".join(
        f"`{name}` string" for name in TAKEN_NAMES))
