"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns `vnodes` points of a ring of 64-bit hashes; a row belongs to the first
point clockwise from the hash of its key. No shard takes more than (1 + slack) times the
mean load: what does not fit goes on clockwise to the shards that still have room.

The rule is worked out on sums. Rows are grouped by (size class, arc of the ring); larger
classes are placed first. Loads of groups, of which there are at most classes x shards x
vnodes whatever the input, are shared out on the driver: a group goes to its own shard as
far as there is room, the rest clockwise, which cuts the group's rows, in hash order, at
few points. A row across a cut (at most one for each class and shard) goes whole to the
next shard clockwise that has room for it, largest first, or where no shard has, to the
least loaded. Loads therefore lie between 1 - (shards - 1) x slack and 1 + slack times the
mean, but for the rows across cuts.

Size of a row: UTF-8 bytes of the text (null: none) plus `overhead`. Null keys hash like any
value; rows that repeat are placed one by one; slots number the rows of a shard without
gaps from 0. An empty table gives no rows. `assign` keeps all columns and adds shard and
slot; a column of one of these names is replaced.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from clickcohort.llm.common import stored

OVERHEAD = 16
VNODES = 128
SLACK = 0.001
_SEED = 20_240_101


def row_size(text: Column, overhead: int = OVERHEAD) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long")


def text_crc(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def ring(shards: int, vnodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted points and the shard that owns each. A shard's points don't depend on others."""
    points = []
    for shard in range(shards):
        for node in range(vnodes):
            raw = hashlib.blake2b(f"{_SEED}/{shard}/{node}".encode(), digest_size=8).digest()
            points.append((int.from_bytes(raw, "little", signed=True), shard))
    points.sort()
    return (np.array([p for p, _ in points], dtype=np.int64),
            np.array([s for _, s in points], dtype=np.int32))


def _arc(position: Column, points: np.ndarray) -> Column:
    """Number of points before the position, by binary search over a literal array."""
    edges = F.split(F.lit(",".join(map(str, points.tolist()))), ",").cast("array<bigint>")
    steps = [1 << bit for bit in range(len(points).bit_length() - 1, -1, -1)]
    found = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, step: F.when(
        F.coalesce(F.get(edges, at + step - 1) < position, F.lit(False)), at + step).otherwise(at))
    return found % len(points)


def _located(docs: DataFrame, points: np.ndarray, overhead: int) -> DataFrame:
    """The rows with size, crc, position on the ring, arc and size class (powers of four)."""
    size = row_size(F.col("text"), overhead)
    return (docs.withColumn("_size", size)
            .withColumn("_crc", text_crc(F.col("text")))
            .withColumn("_at", F.xxhash64(F.lit(_SEED), F.col("doc_id")))
            .withColumn("_arc", _arc(F.col("_at"), points))
            .withColumn("_class", F.floor(F.log2(F.greatest("_size", F.lit(1))) / 2).cast("int")))


def share_out(loads: dict[tuple[int, int], int], owner: np.ndarray, shards: int,
              slack: float) -> tuple[dict[tuple[int, int], list[tuple[int, int]]], float]:
    """Segments (end, shard) of each group's running load, and the bound on a shard's load."""
    bound = sum(loads.values()) / shards * (1 + slack)
    room = [bound] * shards
    segments: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
    placed: dict[tuple[int, int], float] = defaultdict(float)
    by_class: dict[int, list[int]] = defaultdict(list)
    for size_class, arc in loads:
        by_class[size_class].append(arc)
    for size_class in sorted(by_class, reverse=True):
        waiting = [(arc, arc) for arc in sorted(by_class[size_class])]  # (group, next point)
        while waiting:
            left = []
            for arc, point in waiting:
                group, shard = (size_class, arc), int(owner[point])
                part = min(loads[group] - placed[group], room[shard])
                if part > 0:
                    room[shard] -= part
                    placed[group] += part
                    segments[group].append((int(placed[group]), shard))
                if loads[group] - placed[group] >= 1 and max(room) > 0:
                    left.append((arc, (point + 1) % len(owner)))
            waiting = left
    for group, load in loads.items():
        found = segments[group] or [(0, int(owner[group[1]]))]
        segments[group] = [*found[:-1], (load, found[-1][1])]
    return segments, bound


def _placed(located: DataFrame, segments: DataFrame) -> DataFrame:
    """Rank and running load inside the group; shard, null for a row across a cut."""
    order = Window.partitionBy("_class", "_arc").orderBy("_at", "doc_id", "_size", "_crc")
    running = located.withColumn("_rank", F.row_number().over(order)).withColumn(
        "_end", F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    joined = running.join(F.broadcast(segments), ["_class", "_arc"])
    begin = F.col("_end") - F.col("_size")
    across = F.exists("_cuts", lambda c: (c > begin) & (c < F.col("_end")))
    index = F.size(F.filter("_cuts", lambda c: c <= begin))
    return joined.withColumn(
        "_shard", F.when(~across, F.get("_owners", index)))


def assign(docs: DataFrame, shards: int, vnodes: int = VNODES, slack: float = SLACK,
           overhead: int = OVERHEAD) -> DataFrame:
    """The rows with size, text_crc32, shard and slot, which replace columns of these names; all
    other columns are kept, whatever they are called."""
    spark = docs.sparkSession
    points, owner = ring(shards, vnodes)
    kept = [c for c in docs.columns if c not in ("size", "text_crc32", "shard", "slot")]
    # The rows travel as one column, so their names cannot meet those used here.
    docs = docs.select("doc_id", "text", F.struct(*kept).alias("_row"))
    narrow = stored(_located(docs.select("doc_id", "text"), points, overhead).drop("text"),
                    "ring-rows")
    loads = {(r["_class"], r["_arc"]): int(r["load"]) for r in
             narrow.groupBy("_class", "_arc").agg(F.sum("_size").alias("load")).collect()}
    found, bound = share_out(loads, owner, shards, slack)
    segments = spark.createDataFrame(
        [(c, a, [e for e, _ in s[:-1]], [o for _, o in s]) for (c, a), s in found.items()],
        "_class int, _arc int, _cuts array<bigint>, _owners array<int>")

    placed = stored(_placed(narrow, segments).select(
        "_class", "_arc", "_rank", "_size", "_shard"), "ring-placed")
    load = dict.fromkeys(range(shards), 0) | {
        r["_shard"]: int(r["load"]) for r in placed.where("_shard is not null")
        .groupBy("_shard").agg(F.sum("_size").alias("load")).collect()}
    moved = []
    # At most one row for each cut, and each cut fills a shard or ends a class.
    for row in sorted(placed.where("_shard is null").collect(),
                      key=lambda r: (-r["_size"], r["_class"], r["_arc"], r["_rank"])):
        clockwise = dict.fromkeys(int(owner[(row["_arc"] + k) % len(owner)])
                                  for k in range(len(owner)))
        fits = [s for s in clockwise if load[s] + row["_size"] <= bound]
        shard = fits[0] if fits else min(clockwise, key=lambda s: load[s])
        load[shard] += row["_size"]
        moved.append((row["_class"], row["_arc"], row["_rank"], shard))
    moves = spark.createDataFrame(moved, "_class int, _arc int, _rank int, _moved int")

    def settled(frame: DataFrame) -> DataFrame:
        return frame.join(F.broadcast(moves), ["_class", "_arc", "_rank"], "left").withColumn(
            "shard", F.coalesce("_shard", "_moved"))

    counts = settled(placed).groupBy("shard", "_class", "_arc").count()
    before = Window.partitionBy("shard").orderBy("_class", "_arc")
    firsts = counts.select(
        "shard", "_class", "_arc", (F.sum("count").over(before) - F.col("count")).alias("_first"))
    inside = Window.partitionBy("_class", "_arc", "shard").orderBy("_rank")
    whole = settled(_placed(_located(docs, points, overhead), segments))
    return (whole.withColumn("_in", F.row_number().over(inside) - 1)
            .join(F.broadcast(firsts), ["shard", "_class", "_arc"])
            .select("_row.*", F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"),
                    "shard", (F.col("_first") + F.col("_in")).alias("slot")))
