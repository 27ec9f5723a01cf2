"""CSV records that may hold line breaks, read in pieces of a file.

Spark reads such files whole, one task a file, since a line break may lie inside quotes. Here
lines are read as text, in as many blocks as Spark cuts a file into, and put together again:

1. Each block says what it does to a reader that enters it outside or inside quotes: whether it
   leaves the block inside, and whether some line ends a record. That is one row a block.
2. A file's blocks are chained in order, which settles how each one is entered and, for one entered
   inside quotes, in which earlier block its first record began.
3. Blocks are read again, each with its own entry state. Records that lie in one block come out
   whole; the parts of others meet by (file, block where they began) and are joined in order.

Quotes count as the parser takes them: only one that opens a field starts quoting, and a doubled
one inside stays inside. A record is a row and has to fit into memory as such; a quote that is never
closed makes the rest of its file one record, as in any reader of line breaks. Compressed files
are one block each. Files of no bytes have no records.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickcohort.session import ensure_checkpoint_dir

# The scanning functions travel with the tasks, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BROADCAST_BLOCKS = 400_000
_BLOCK = "path string, start bigint"


def ends_inside(line: str, inside: bool, delimiter: str = ",", quote: str = '"') -> bool:
    """Whether a line that begins outside (a record) or inside (a quoted field) ends inside."""
    if quote not in line:
        return inside
    at = 0
    while True:
        if inside:
            at = line.find(quote, at)
            if at < 0:
                return True
            if line.startswith(quote, at + 1):
                at += 2
                continue
            inside = False
        elif line.startswith(quote, at):
            inside, at = True, at + 1
            continue
        at = line.find(delimiter, at) + 1
        if not at:
            return False


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"), "value")


def _by_block(batches: Iterator[pa.RecordBatch], columns: Sequence[str]):
    """(values of ``columns``, lines, whether the block goes on) of each run of equal blocks."""
    for found in batches:
        keys = list(zip(*[found.column(c).to_pylist() for c in columns]))
        lines = found.column("value").to_pylist()
        at = 0
        while at < len(lines):
            stop = at + 1
            while stop < len(lines) and keys[stop] == keys[at]:
                stop += 1
            yield keys[at], lines[at:stop]
            at = stop


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a block: how it is left, and whether it ends a record, for both ways to enter."""
    out: dict[tuple, list[bool]] = {}
    for block, lines in _by_block(batches, ("path", "start")):
        state = out.setdefault(block, [False, False, True, False])
        for line in lines:
            for i in (0, 2):
                state[i] = ends_inside(line, state[i])
                state[i + 1] |= not state[i]
    if out:
        yield pa.record_batch(
            [pa.array([p for p, _ in out]), pa.array([s for _, s in out], pa.int64()),
             *[pa.array([v[i] for v in out.values()]) for i in range(4)]],
            names=["path", "start", "left_out", "ends_out", "left_in", "ends_in"])


def _chain(table: pa.Table) -> pa.Table:
    """Blocks of one file in order: how each is entered, and where its first record began."""
    rows = sorted(table.to_pylist(), key=lambda r: r["start"])
    inside, began, out = False, rows[0]["start"], []
    for row in rows:
        way = "in" if inside else "out"
        left = row[f"left_{way}"]
        out.append((row["path"], row["start"], inside, began if inside else None, left))
        if row[f"ends_{way}"] or not inside:
            began = row["start"]    # the last record of this block begins in it
        inside = left
    kinds = (pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_())
    return pa.table([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                    names=["path", "start", "inside", "began", "left"])


def _assemble(whole: bool):
    """Records that lie in one block, or the parts of those that do not."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, inside, held, began = None, False, [], None
        out: list[tuple] = []
        first = False

        def close_block() -> None:
            # What is left over is a record's beginning, or a part from the middle.
            if held and not whole:
                out.append((now[0], now[1] if began is None else began, now[1], "\n".join(held),
                            first))

        def batch() -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                   names=["path", "began", "start", "record", "is_header"])
        for (path, start, entered, owner), lines in _by_block(
                batches, ("path", "start", "inside", "began")):
            if (path, start) != now:
                close_block()
                now, inside, held, began = (path, start), entered, [], owner
                first = start == 0
            for line in lines:
                held.append(line)
                inside = ends_inside(line, inside)
                if inside:
                    continue
                if began is None:
                    if whole:
                        out.append((path, start, start, "\n".join(held), first))
                elif not whole:
                    out.append((path, began, start, "\n".join(held), False))
                held, began, first = [], None, False
            if len(out) >= 4096:
                yield batch()
                out = []
        close_block()
        if out:
            yield batch()
    return read


def read_records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, record, is_header): every record's text; the first of each file is its header.

    Reads the text twice, and a third time if a record crosses blocks.
    """
    ensure_checkpoint_dir(spark)
    effects = _lines(spark, paths).mapInArrow(
        _effects, _BLOCK + ", left_out boolean, ends_out boolean, left_in boolean, ends_in boolean")
    # A row a block of the files; one array of a file's blocks is put in order at a time.
    blocks = effects.groupBy("path").applyInArrow(
        _chain, _BLOCK + ", inside boolean, began bigint, left boolean").checkpoint()
    entered = blocks.where("inside").select("path", "start", "inside", "began")
    crossed, open_ends = blocks.agg(F.count_if("inside"), F.count_if("left")).first()
    lines = _lines(spark, paths)
    if not crossed:
        lines = lines.withColumns({"inside": F.lit(False), "began": F.lit(None).cast("long")})
    elif crossed <= BROADCAST_BLOCKS:
        # Lines stay in order: only the few blocks entered inside quotes are looked up.
        lines = lines.join(F.broadcast(entered), ["path", "start"], "left")
    else:
        lines = (lines.withColumn("line", F.monotonically_increasing_id())
                 .join(entered, ["path", "start"], "left").repartition("path", "start")
                 .sortWithinPartitions("path", "start", "line"))
    lines = lines.withColumn("inside", F.coalesce("inside", F.lit(False)))
    shape = _BLOCK.replace("start", "began") + ", start bigint, record string, is_header boolean"
    records = lines.mapInArrow(_assemble(True), shape).select("path", "record", "is_header")
    if crossed or open_ends:
        parts = lines.mapInArrow(_assemble(False), shape).groupBy("path", "began").agg(
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "record"))),
                                     lambda p: p["record"]), "\n").alias("record"),
            F.bool_or("is_header").alias("is_header"))
        records = records.unionByName(parts.select("path", "record", "is_header"))
    return records


def parse_records(records: DataFrame, names: Sequence[str]) -> DataFrame:
    """Text columns ``names`` and source_file of all records but headers and blank lines."""
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    text = F.regexp_replace("record", "\r$", "")
    cells = records.where(~F.col("is_header") & (text != "")).select(
        "path", F.from_csv(text, schema, {"escape": '"', "maxCharsPerColumn": "-1"}).alias("_r"))
    return cells.select(*[F.col(f"_r.c{i}").alias(f"c{i}") for i in range(len(names))],
                        F.col("path").alias("source_file")).toDF(*names, "source_file")
