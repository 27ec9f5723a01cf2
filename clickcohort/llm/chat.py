"""Chat formatting: layouts told by a hash of their field paths, one reversible template.

A layout is declared as the set of its nested field paths (`messages[].role`) and an
expression that turns a record into turns. The paths of a table or of a JSON record that
any layout knows are sorted and hashed, and the hash selects the layout; fields that no
layout knows are left out of the hash, so extra columns do no harm.

Template, once per turn: `<turn>` role `<say>` text `</turn>` and a line feed. Inside
roles and texts a backslash becomes two and each control string gets a backslash after
its `<`, so no control string is left in them and the first form can always be restored.
The loss mask lists the byte ranges of the assistant turns' texts in the formatted text.

Null texts and roles are read as empty. Turns are ordered by turn number, nulls first;
equal numbers by role and text. Rows that repeat are turns that repeat. Conversations
with a null id are one conversation. A record without turns gives no conversation; an
empty table gives no rows. A formatted conversation is one value and so is made in one
task; nothing else is gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

OPEN, SAY, CLOSE = "<turn>", "<say>", "</turn>"
ASSISTANT = "assistant"
_ESCAPE = "\\"
TURN = "struct<turn: bigint, role: string, text: string>"
_TURNS = f"array<{TURN}>"


# -- layouts ---------------------------------------------------------------------

def fingerprint(paths: Iterable[str]) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()


def _turn(number, role, text) -> Column:
    as_column = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(as_column(number).cast("bigint").alias("turn"),
                    as_column(role).cast("string").alias("role"),
                    as_column(text).cast("string").alias("text"))


def _listed(items: str, role: str, text: str, names: dict[str, str]):
    def build() -> Column:
        def one(item: Column, at: Column) -> Column:
            given = item[role]
            known = F.coalesce(*[F.when(given == k, F.lit(v)) for k, v in names.items()], given) \
                if names else given
            return _turn(at, known, item[text])
        return F.transform(F.col(items), one)
    return build


def _pair(question: str, answer: str, context: str | None = None):
    def build() -> Column:
        asked = F.coalesce(F.col(question), F.lit(""))
        if context:
            more = F.coalesce(F.col(context), F.lit(""))
            asked = F.when(more == "", asked).otherwise(F.concat(asked, F.lit("\n\n"), more))
        return F.array(_turn(0, "user", asked), _turn(1, ASSISTANT, F.col(answer)))
    return build


@dataclass(frozen=True)
class Layout:
    """paths: the fields that make the layout; turns: array of turns of a record."""

    name: str
    paths: tuple[str, ...]
    turns: Callable[[], Column]


#: JSON types of every field that some layout reads.
RECORD = ("conv_id bigint, turn bigint, role string, text string, prompt string, "
          "response string, completion string, instruction string, input string, "
          "output string, messages array<struct<role: string, content: string>>, "
          "conversations array<struct<`from`: string, value: string>>")
_SPEAKERS = {"human": "user", "gpt": ASSISTANT}

LAYOUTS = (
    Layout("turn rows", ("conv_id", "turn", "role", "text"),
           lambda: F.array(_turn(F.col("turn"), F.col("role"), F.col("text")))),
    Layout("messages", ("conv_id", "messages", "messages[].role", "messages[].content"),
           _listed("messages", "role", "content", {})),
    Layout("no messages", ("conv_id", "messages"), lambda: F.array().cast(_TURNS)),
    Layout("speakers", ("conv_id", "conversations", "conversations[].from",
                        "conversations[].value"),
           _listed("conversations", "from", "value", _SPEAKERS)),
    Layout("no speakers", ("conv_id", "conversations"), lambda: F.array().cast(_TURNS)),
    Layout("prompt and response", ("conv_id", "prompt", "response"), _pair("prompt", "response")),
    Layout("prompt and completion", ("conv_id", "prompt", "completion"),
           _pair("prompt", "completion")),
    Layout("instruction", ("conv_id", "instruction", "output"), _pair("instruction", "output")),
    Layout("instruction with input", ("conv_id", "instruction", "input", "output"),
           _pair("instruction", "output", "input")),
)


def field_paths(schema: T.StructType, prefix: str = "") -> list[str]:
    """Nested field paths; an array's elements are written `[]`."""
    found = []
    for field in schema.fields:
        path, kind = prefix + field.name, field.dataType
        found.append(path)
        if isinstance(kind, T.ArrayType):
            kind, path = kind.elementType, path + "[]"
        if isinstance(kind, T.StructType):
            found += field_paths(kind, path + ".")
    return found


def _known(layouts: Sequence[Layout]) -> set[str]:
    return {path for layout in layouts for path in layout.paths}


def turns_of(frame: DataFrame, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """conv_id, turn, role and text of a table whose columns follow one of the layouts."""
    seen = _known(layouts) & set(field_paths(frame.schema))
    by_hash = {fingerprint(layout.paths): layout for layout in layouts}
    layout = by_hash.get(fingerprint(seen))
    if layout is None:
        raise ValueError(f"no layout has the fields {sorted(seen)}")
    return frame.select("conv_id", F.explode(layout.turns()).alias("_turn")).select(
        "conv_id", "_turn.*")


def record_fingerprint(record: Column, layouts: Sequence[Layout] = LAYOUTS) -> Column:
    """The same hash for one JSON object; an array's first element stands for all."""
    known = _known(layouts)
    top = F.json_object_keys(record)
    lists = sorted({path.split("[]")[0] for path in known if "[]" in path})
    none = F.array().cast("array<string>")

    def inside(name: str) -> Column:
        keys = F.json_object_keys(F.get_json_object(record, f"$.{name}[0]"))
        return F.coalesce(F.transform(keys, lambda k: F.concat(F.lit(f"{name}[]."), k)), none)

    paths = F.concat(F.coalesce(top, none), *[inside(name) for name in lists])
    kept = F.array_sort(F.array_intersect(paths, F.array(*[F.lit(p) for p in sorted(known)])))
    return F.sha2(F.array_join(kept, "\n"), 256)


def turns_of_records(frame: DataFrame, column: str,
                     layouts: Sequence[Layout] = LAYOUTS) -> tuple[DataFrame, DataFrame]:
    """Turns of a column of JSON records in mixed layouts, and the records of no layout."""
    marked = frame.select(F.col(column).alias("record"),
                          record_fingerprint(F.col(column), layouts).alias("fingerprint"),
                          F.from_json(column, RECORD).alias("_record"))
    hashes = [fingerprint(layout.paths) for layout in layouts]
    fits = F.coalesce(F.col("fingerprint").isin(hashes), F.lit(False))
    read = marked.where(fits).select("fingerprint", "_record.*")
    built = F.coalesce(*[F.when(F.col("fingerprint") == key, layout.turns())
                         for key, layout in zip(hashes, layouts)])
    turns = read.select("conv_id", F.explode(built).alias("_turn")).select("conv_id", "_turn.*")
    return turns, marked.where(~fits).select("record", "fingerprint")


# -- template ----------------------------------------------------------------------

def escape(text: Column) -> Column:
    out = F.replace(F.coalesce(text, F.lit("")), F.lit(_ESCAPE), F.lit(_ESCAPE * 2))
    for control in (OPEN, SAY, CLOSE):
        out = F.replace(out, F.lit(control), F.lit("<" + _ESCAPE + control[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_turns(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans (start and stop in bytes)."""
    said = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    said = said.select(
        "conv_id", "turn", "role", "text",
        F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(SAY)).alias("head"),
        escape(F.col("text")).alias("body"))
    size = F.octet_length("head") + F.octet_length("body") + F.lit(len(CLOSE) + 1)
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    placed = said.select(
        "conv_id", "role", "head", "body", F.row_number().over(order).alias("at"),
        (F.sum(size.cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0))
         - size).alias("begin"))
    start = F.col("begin") + F.octet_length("head")
    pieces = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        "at", F.concat("head", "body", F.lit(CLOSE + "\n")).alias("piece"),
        (F.col("role") == ASSISTANT).alias("learned"), start.alias("start"),
        (start + F.octet_length("body")).alias("stop")))).alias("pieces"))
    spans = F.transform(F.filter("pieces", lambda x: x["learned"]),
                        lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop")))
    return pieces.select(
        "conv_id", F.array_join(F.transform("pieces", lambda x: x["piece"]), "").alias("formatted"),
        spans.alias("loss_spans"))


def parse(formatted: Column) -> Column:
    """Turns (role, text) of a formatted conversation."""
    pieces = F.split(formatted, f"{CLOSE}\n")

    def one(piece: Column) -> Column:
        halves = F.split(piece, SAY, 2)
        return F.struct(unescape(F.substr(halves[0], F.lit(len(OPEN) + 1))).alias("role"),
                        unescape(halves[1]).alias("text"))
    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), one)


def learned_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, as it was before escaping."""
    raw = formatted.cast("binary")
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(
        raw, (s["start"] + 1).cast("int"), (s["stop"] - s["start"]).cast("int")).cast("string"))),
        "")


def write_formatted(frames: Sequence[DataFrame], path: str) -> None:
    """Format the conversations of tables in any layouts and write them as Parquet."""
    turns = None
    for frame in frames:
        part = turns_of(frame)
        turns = part if turns is None else turns.unionByName(part)
    format_turns(turns).write.parquet(path)


def read_formatted(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(
        "conv_id bigint, formatted string, "
        "loss_spans array<struct<start: bigint, stop: bigint>>").parquet(path)


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests that are read back from formatted conversations."""
    back = formatted.select(
        "conv_id", "formatted", parse(F.col("formatted")).alias("turns"),
        learned_text(F.col("formatted"), F.col("loss_spans")).alias("learned"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))
