"""Isolation forest (Liu, Ting, Zhou 2008) on Spark, grown by levels and kept as a table.

``max_samples`` is the one rule for what a tree sees, at any number of cohorts: a whole number is
the rows per tree, as in the published method, a fraction is that share of all cohorts. Hashes of
(seed, tree, cohort) order the cohorts, and a tree takes exactly so many of the first. Constant
offsets cancel in the final min-max scaling, so a contamination share has no effect and is not a
parameter; per-feature scaling does not change the uniform split distribution, so no scaler is
fitted.

Growing. A node's split is a function of (seed, tree, node) and the ranges of its rows: of the
features that vary there, the one with the greatest hash is cut at a hashed place of its range.
Nothing else decides, so the forest is the same under any partitioning, and however its nodes
are dealt to tasks:

* While a node has more than ``cell_rows`` rows it is split by its level: tasks walk their rows
  through the splits found so far and hand on one partial (count, least, greatest) per open node
  and feature, which a group-by puts together. Rows stay where they are and carry no state.
* A node of at most ``cell_rows`` rows is a *cell*: its rows meet in one task, which grows the rest
  below it. If all rows fit into a cell there are no levels; then each task gets the rows once
  for all its trees, not once a tree. Otherwise trees are taken in turns, ``TURN_BYTES`` of copied
  rows at a time.

The forest is one row of arrays a cell (and one a tree for the levels above its cells), written to
the shared folder. The driver sees counts, one cut-off a tree and the splits above the cells, about
2 * samples / ``cell_rows`` a tree, of which a turn holds at most ``OPEN_NODES``.

Scoring. Cells and rows are streams that meet in sorted partitions, cells first: trees in groups of
``GROUP_BYTES``, rows in parts of ``PART_ROWS``. A task holds one group and adds up path lengths
per row. Where trees have levels, rows go through these first and then to the cell that they enter,
again by turns; a cell that very many rows enter is copied to several parts. Path lengths are
multiples of 2**-32, so their sums do not depend on the order.

Every cohort is scored. Null and NaN features count as 0. No rows or no numeric column: no forest
and scores of 0; constant scores give 0.
"""

from __future__ import annotations

import math
import sys
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from clickcohort.operators.tallies import KEY
from clickcohort.params import Params
from clickcohort.session import ensure_checkpoint_dir

# The tree functions travel with the tasks, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EULER_GAMMA = 0.5772156649015329

# Numeric columns that are results or labels, never inputs.
NOT_FEATURES = ("rule_score", "iso_score", "botness")

CELL_ROWS = 32_768
TURN_BYTES = 20_000_000_000
OPEN_NODES = 200_000
GROUP_BYTES = 32_000_000
PART_ROWS = 16_384
_NODE_BYTES = 36

#: A flat view of the forest; ``left`` and ``right`` are node numbers inside the cell.
NODE_SCHEMA = ("tree_id int, cell bigint, node_id int, feature int, threshold double, "
               "left int, right int, path_len double, enters bigint")
_ARRAYS = ("feature", "threshold", "left", "right", "path_len", "enters")
#: A cell is named by its top node, numbered 1 at the root, 2i and 2i + 1 below node i. ``enters``
#: is the cell that a row goes on in, or 0.
CELL_SCHEMA = ("tree_id int, cell bigint, feature array<int>, threshold array<double>, "
               "left array<int>, right array<int>, path_len array<double>, enters array<bigint>")


def feature_columns(frame: DataFrame) -> list[str]:
    """Numeric columns in a fixed (sorted) order; booleans and times are left out."""
    return sorted(f.name for f in frame.schema
                  if isinstance(f.dataType, T.NumericType) and f.name not in NOT_FEATURES
                  and f.name != "row_id")


def average_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    out[n == 2] = 1.0
    big = n > 2
    out[big] = 2 * (np.log(n[big] - 1) + EULER_GAMMA) - 2 * (n[big] - 1) / n[big]
    return out


def path_length(depth: int, size: np.ndarray) -> np.ndarray:
    """Length at a leaf, on a grid on which sums are exact."""
    return np.round((depth + average_path(size)) * 2.0 ** 32) / 2.0 ** 32


# -- splits --------------------------------------------------------------------------

def hash_longs(*parts) -> np.ndarray:
    """``xxhash64`` of long columns as Spark computes it, for arrays that broadcast."""
    def rotated(x: np.ndarray, by: int) -> np.ndarray:
        return x << np.uint64(by) | x >> np.uint64(64 - by)

    # The primes of the published hash.
    p1, p2, p3, p4, p5 = (np.uint64(p) for p in (
        0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63,
        0x27D4EB2F165667C5))
    out = np.uint64(42)
    with np.errstate(over="ignore"):
        for part in parts:
            value = np.asarray(part, dtype=np.int64).view(np.uint64)
            out = out + p5 + np.uint64(8) ^ rotated(value * p2, 31) * p1
            out = rotated(out, 27) * p1 + p4
            out = (out ^ out >> np.uint64(33)) * p2
            out = (out ^ out >> np.uint64(29)) * p3
            out = out ^ out >> np.uint64(32)
    return np.asarray(out).view(np.int64)


def cut_place(seed: int, tree, node, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Where the range of the chosen feature is cut: from ``low`` to under ``high``."""
    share = (hash_longs(seed, tree, node, -1).view(np.uint64) >> np.uint64(11)) / 2.0 ** 53
    cut = low + share * (high - low)
    return np.where(cut >= high, low, cut)


def grow(x: np.ndarray, tree: int, top: int, depth: int, max_depth: int, seed: int
         ) -> dict[str, np.ndarray]:
    """Nodes of one cell, all open nodes of a level together; the order of rows has no effect."""
    out = {name: [np.zeros(0)] for name in _ARRAYS}
    heap = np.array([top], dtype=np.int64)
    member = np.zeros(len(x), dtype=np.int64)      # index into ``heap``, rows grouped by it
    made = 1
    while True:
        starts = np.flatnonzero(np.r_[True, member[1:] != member[:-1]])
        sizes = np.diff(np.r_[starts, len(member)])
        low, high = (f.reduceat(x, starts, axis=0) for f in (np.minimum, np.maximum))
        varied = high > low
        split = varied.any(axis=1) & (sizes > 1) & (depth < max_depth)
        at, pick, cut = np.flatnonzero(split), np.zeros(len(heap), np.int64), np.zeros(len(heap))
        rank = hash_longs(seed, tree, heap[at, None], np.arange(x.shape[1])[None, :])
        pick[at] = np.where(varied[at], rank, np.iinfo(np.int64).min).argmax(axis=1)
        cut[at] = cut_place(seed, tree, heap[at], low[at, pick[at]], high[at, pick[at]])
        left = np.where(split, made + 2 * (np.cumsum(split) - 1), -1)
        for name, values in (("feature", np.where(split, pick, -1)),
                             ("threshold", cut), ("left", left),
                             ("right", np.where(split, left + 1, -1)),
                             ("path_len", np.where(split, 0.0, path_length(depth, sizes))),
                             ("enters", np.zeros(len(heap)))):
            out[name].append(values)
        if not split.any():
            return {name: np.concatenate(values) for name, values in out.items()}
        keep = split[member]
        x, member = x[keep], member[keep]
        below = x[np.arange(len(x)), pick[member]] > cut[member]
        child = 2 * (np.cumsum(split) - 1)[member] + below
        order = np.argsort(child, kind="stable")
        x, member = x[order], child[order]
        heap = np.stack([2 * heap[split], 2 * heap[split] + 1], axis=1).ravel()
        made += 2 * int(split.sum())
        depth += 1


def walk(cell: Sequence[np.ndarray], x: np.ndarray) -> np.ndarray:
    """Number of the node at which each row ends."""
    feature, threshold, left, right = cell[:4]
    node = np.zeros(len(x), dtype=np.int64)
    moving = np.arange(len(x)) if feature[0] >= 0 else np.zeros(0, dtype=np.int64)
    while len(moving):
        at = node[moving]
        nxt = np.where(x[moving, feature[at]] <= threshold[at], left[at], right[at])
        node[moving] = nxt
        moving = moving[feature[nxt] >= 0]
    return node


def _matrix(lists: pa.Array) -> np.ndarray:
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    width = len(lists[0]) if len(lists) else 0
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), width)


def _cell_batch(cells: list[tuple[int, int, dict[str, np.ndarray]]]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.float64(), pa.int64())
    return pa.record_batch(
        [pa.array([t for t, _, _ in cells], pa.int32()),
         pa.array([c for _, c, _ in cells], pa.int64()),
         *[pa.array([nodes[name].astype(kind.to_pandas_dtype()) for _, _, nodes in cells],
                    pa.list_(kind)) for name, kind in zip(_ARRAYS, kinds)]],
        names=["tree_id", "cell", *_ARRAYS])


# -- the forest as a table -----------------------------------------------------------

@dataclass(frozen=True)
class Forest:
    """A grown forest: a table of cells, its input columns, trees and rows per tree."""

    cells: DataFrame
    columns: list[str]
    samples: int
    n_trees: int

    def to_table(self) -> DataFrame:
        return self.cells.withColumns({
            "samples": F.lit(self.samples), "n_trees": F.lit(self.n_trees),
            "columns": F.array(*[F.lit(c) for c in self.columns])})

    @staticmethod
    def from_table(table: DataFrame) -> Forest:
        """The inverse of ``to_table``; only one row's names and numbers reach the driver."""
        head = table.select("columns", "samples", "n_trees").first()
        cells = table.select("tree_id", "cell", *_ARRAYS)
        return Forest(cells, list(head["columns"]), int(head["samples"]), int(head["n_trees"]))

    def nodes(self) -> DataFrame:
        """One row a node, NODE_SCHEMA."""
        return self.cells.select("tree_id", "cell", F.posexplode(F.arrays_zip(*_ARRAYS)).alias(
            "node_id", "_n")).select("tree_id", "cell", "node_id", "_n.*")

    def normality(self, frame: DataFrame, key: str = KEY) -> DataFrame:
        """(key, normality): minus the anomaly score, high for ordinary rows."""
        norm = float(average_path(np.array([self.samples]))[0]) or 1.0
        depth = -F.col("path") / F.lit(self.n_trees * norm)
        return path_sums(frame, self, key).select(
            key, (-F.pow(F.lit(2.0), depth)).alias("normality"))


def forest_of_nodes(spark: SparkSession, nodes: Sequence[tuple], columns: Sequence[str],
                    samples: int) -> Forest:
    """A forest of given (tree, node, feature, threshold, left, right, path length), numbered
    from 0 in each tree."""
    trees: dict[int, list] = {}
    for tree, *node in sorted(nodes):
        trees.setdefault(tree, []).append(node)
    rows = []
    for tree, found in trees.items():
        _, feature, threshold, left, right, path = map(list, zip(*found))
        rows.append((tree, 1, feature, threshold, left, right, path, [0] * len(feature)))
    return Forest(spark.createDataFrame(rows, CELL_SCHEMA), list(columns), samples, len(trees))


def _stored(frame: DataFrame, label: str) -> DataFrame:
    spark = frame.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{label}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def _vector(columns: Sequence[str]) -> Column:
    def filled(name: str) -> Column:
        value = F.col(name).cast("double")
        return F.coalesce(F.when(~F.isnan(value), value), F.lit(0.0))
    return F.array(*[filled(c) for c in columns])


# -- which rows a tree sees ----------------------------------------------------------

def rows_per_tree(n: int, max_samples: int | float) -> int:
    """A whole number counts rows, a fraction is a share of them; at least one row."""
    wanted = max_samples if isinstance(max_samples, int) else int(max_samples * n)
    return max(1, min(wanted, n))


def _draw(tree: Column, seed: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64("key", tree, F.lit(seed)), 1)


def cut_offs(rows: DataFrame, n: int, samples: int, n_trees: int, seed: int) -> list[int]:
    """The greatest draw that each tree takes: its ``samples``-th smallest.

    Draws well under the expected place are only counted. Those around it, of the order of the
    square root of the rows, are sorted per tree; if they miss the place, a wider range is taken.
    """
    if samples >= n:
        return [2 ** 63 - 1] * n_trees
    share, wide = samples / n, 8.0
    while True:
        spread = wide * (math.sqrt(share * (1 - share) / n) + 1 / n)
        low, high = (int(min(max(s, 0.0), 1.0) * 2 ** 63) for s in (share - spread, share + spread))
        low, high = min(low, 2 ** 63 - 1), min(high, 2 ** 63 - 1)
        trees = F.sequence(F.lit(0), F.lit(n_trees - 1))
        near = F.transform(trees, lambda t: F.struct(t.alias("tree"), _draw(t, seed).alias("draw")))
        drawn = rows.select(F.explode(F.filter(near, lambda d: d["draw"] <= high)).alias("d")).select(
            "d.*")
        under = F.col("draw") < low
        found = drawn.groupBy("tree").agg(
            F.count_if(under).alias("sure"),
            F.array_sort(F.collect_list(F.when(~under, F.col("draw")))).alias("around")).select(
            "tree", F.get("around", (F.lit(samples - 1) - F.col("sure")).cast("int"))).collect()
        cuts = {tree: cut for tree, cut in found if cut is not None}
        if len(cuts) == n_trees:
            return [cuts[t] for t in range(n_trees)]
        wide *= 4


# -- growing -------------------------------------------------------------------------

def fit_forest(features: DataFrame, columns: Sequence[str] | None = None,
               params: Params = Params(), key: str = KEY, cell_rows: int = CELL_ROWS,
               turn_bytes: int = TURN_BYTES) -> Forest | None:
    """Grow the forest; None when there is no row or no numeric column.

    Reads ``features`` several times, so pass a stored or checkpointed frame.
    """
    columns = list(columns) if columns is not None else feature_columns(features)
    n = features.count()
    if not columns or n == 0:
        return None
    samples = rows_per_tree(n, params.max_samples)
    max_depth = math.ceil(math.log2(max(samples, 2)))
    rows = features.select(F.col(key).alias("key"), _vector(columns).alias("x"))
    cuts = cut_offs(rows.select("key"), n, samples, params.n_trees, params.seed)
    # Equal draws would let a tree see a few rows more.
    if n <= cell_rows:
        cells = _stored(_grow_whole(rows, cuts, max_depth, params.seed), "forest")
    else:
        copied = 8 * len(columns) * samples
        turn = max(1, min(params.n_trees, turn_bytes // copied,
                          OPEN_NODES * cell_rows // (2 * samples)))
        parts = [_grow_turn(rows, range(at, min(at + turn, params.n_trees)), cuts, max_depth,
                            params.seed, cell_rows)
                 for at in range(0, params.n_trees, turn)]
        cells = parts[0]
        for part in parts[1:]:
            cells = cells.unionByName(part)
    return Forest(cells, columns, samples, params.n_trees)


def _inside(trees: Sequence[int], cuts: Sequence[int], seed: int) -> Column:
    """Whether each of the trees takes the row."""
    given = F.array(*[F.struct(F.lit(t).alias("tree"), F.lit(cuts[t]).alias("cut"))
                      for t in trees])
    return F.transform(given, lambda g: _draw(g["tree"], seed) <= g["cut"])


def _grow_whole(rows: DataFrame, cuts: Sequence[int], max_depth: int, seed: int) -> DataFrame:
    """All trees of a table that fits into one cell: each task gets the rows and some trees."""
    n_trees = len(cuts)
    tasks = min(n_trees, 4 * rows.sparkSession.sparkContext.defaultParallelism)
    dealt = rows.select("x", _inside(range(n_trees), cuts, seed).alias("inside")).select(
        F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("task"), "x", "inside")

    def grow_some(table: pa.Table) -> pa.Table:
        task = table.column("task")[0].as_py()
        x, inside = _matrix(table.column("x")), _matrix(table.column("inside"))
        # Some trees at a time, so that the cells go out in batches of a bounded size.
        out = [(t, 1, grow(x[inside[:, t]], t, 1, 0, max_depth, seed))
               for t in range(task, n_trees, tasks) if inside[:, t].any()]
        return pa.Table.from_batches([_cell_batch(out)])
    return dealt.repartition(tasks, "task").groupBy("task").applyInArrow(grow_some, CELL_SCHEMA)


class _Top:
    """The levels of one tree above its cells, as they are found."""

    def __init__(self):
        self.heap, self.depth = [1], [0]
        self.nodes = {"feature": [-1], "threshold": [0.0], "left": [-1], "right": [-1],
                      "path_len": [0.0], "enters": [0]}
        self.open = {1: 0}      # heap number -> node number

    def settle(self, tree: int, found: list, max_depth: int, cell_rows: int, seed: int) -> None:
        """``found``: (heap, rows, feature or null, low, high) of every open node."""
        was_open, self.open = self.open, {}
        for heap, size, feature, low, high in found:
            at = was_open[heap]
            depth = self.depth[at]
            if feature is None or size < 2 or depth >= max_depth:
                self.nodes["path_len"][at] = float(path_length(depth, np.array([size]))[0])
            elif size <= cell_rows:
                self.nodes["enters"][at] = heap
            else:
                cut = cut_place(seed, tree, np.array([heap]), np.array([low]), np.array([high]))
                for name, value in (("feature", feature), ("threshold", float(cut[0])),
                                    ("left", len(self.heap)), ("right", len(self.heap) + 1)):
                    self.nodes[name][at] = value
                for child in (2 * heap, 2 * heap + 1):
                    self.open[child] = len(self.heap)
                    self.heap.append(child)
                    self.depth.append(depth + 1)
                    for name, value in (("feature", -1), ("threshold", 0.0), ("left", -1),
                                        ("right", -1), ("path_len", 0.0), ("enters", 0)):
                        self.nodes[name].append(value)

    def arrays(self) -> dict[str, np.ndarray]:
        return {name: np.array(values) for name, values in self.nodes.items()}


def _grow_turn(rows: DataFrame, trees: Sequence[int], cuts: Sequence[int], max_depth: int,
               seed: int, cell_rows: int) -> DataFrame:
    """Some trees of a table that is larger than a cell."""
    spark = rows.sparkSession
    base = _stored(rows.select("x", _inside(trees, cuts, seed).alias("inside")), "forest-rows")
    tops = {t: _Top() for t in trees}
    while any(top.open for top in tops.values()):
        ranges = _ranges(base, tops)
        # Of the features that vary, the one with the greatest hash.
        rank = F.xxhash64(F.lit(seed).cast("long"), F.col("tree").cast("long"), "node",
                          F.col("feature").cast("long"))
        chosen = ranges.groupBy("tree", "node").agg(
            F.max("size").alias("size"),
            F.max_by(F.when(F.col("high") > F.col("low"), F.struct("feature", "low", "high")),
                     F.when(F.col("high") > F.col("low"), rank)).alias("best"))
        found: dict[int, list] = {}
        for tree, node, size, best in chosen.collect():
            found.setdefault(tree, []).append((node, size, *(best or (None, None, None))))
        for tree, top in tops.items():
            top.settle(tree, found.get(tree, []), max_depth, cell_rows, seed)
    above = {t: top.arrays() for t, top in tops.items()}
    shared = spark.sparkContext.broadcast(above)
    order = list(trees)

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in batches:
            if not len(found):
                continue
            x, inside = _matrix(found.column("x")), _matrix(found.column("inside"))
            for i, tree in enumerate(order):
                mine = np.flatnonzero(inside[:, i])
                top = shared.value[tree]
                cell = top["enters"][walk([top[a] for a in _ARRAYS], x[mine])]
                mine, cell = mine[cell > 0], cell[cell > 0]
                yield pa.record_batch(
                    [pa.array(np.full(len(mine), tree, np.int32)), pa.array(cell, pa.int64()),
                     found.column("x").take(pa.array(mine))], names=["tree_id", "cell", "x"])

    def grow_cell(table: pa.Table) -> pa.Table:
        tree, top = table.column("tree_id")[0].as_py(), table.column("cell")[0].as_py()
        nodes = grow(_matrix(table.column("x")), tree, top, top.bit_length() - 1, max_depth, seed)
        return pa.Table.from_batches([_cell_batch([(tree, top, nodes)])])
    cells = (base.mapInArrow(enter, "tree_id int, cell bigint, x array<double>")
             .groupBy("tree_id", "cell").applyInArrow(grow_cell, CELL_SCHEMA))
    first = spark.createDataFrame(pa.Table.from_batches([_cell_batch(
        [(t, 1, nodes) for t, nodes in above.items()])]), CELL_SCHEMA)
    # A tree whose root is a cell has no levels.
    return _stored(first.where(F.get("enters", F.lit(0)) != 1).unionByName(cells), "forest")


def _ranges(base: DataFrame, tops: dict[int, _Top]) -> DataFrame:
    """(tree, node, feature, size, low, high) of the open nodes."""
    shared = base.sparkSession.sparkContext.broadcast(
        [(t, top.arrays(), np.array(top.heap), np.isin(np.arange(len(top.heap)),
                                                       list(top.open.values())))
         for t, top in tops.items()])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}
        for found in batches:
            if not len(found):
                continue
            x, inside = _matrix(found.column("x")), _matrix(found.column("inside"))
            for i, (tree, top, heap, is_open) in enumerate(shared.value):
                if not is_open.any():
                    continue
                mine = x[inside[:, i]]
                at = walk([top[a] for a in _ARRAYS], mine)
                mine, at = mine[is_open[at]], at[is_open[at]]
                if not len(at):
                    continue
                order = np.argsort(at, kind="stable")
                mine, at = mine[order], at[order]
                starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
                for node, size, low, high in zip(
                        heap[at[starts]].tolist(), np.diff(np.r_[starts, len(at)]).tolist(),
                        np.minimum.reduceat(mine, starts), np.maximum.reduceat(mine, starts)):
                    known = held.get((tree, node))
                    if known is None:
                        held[tree, node] = [size, low, high]
                    else:
                        known[0] += size
                        np.minimum(known[1], low, out=known[1])
                        np.maximum(known[2], high, out=known[2])
        if held:
            yield pa.record_batch(
                [pa.array([t for t, _ in held], pa.int32()), pa.array([c for _, c in held]),
                 pa.array([v[0] for v in held.values()], pa.int64()),
                 pa.array([v[1] for v in held.values()], pa.list_(pa.float64())),
                 pa.array([v[2] for v in held.values()], pa.list_(pa.float64()))],
                names=["tree", "node", "size", "lows", "highs"])
    found = base.mapInArrow(
        partial, "tree int, node bigint, size bigint, lows array<double>, highs array<double>")
    each = found.select("tree", "node", "size", F.posexplode(F.arrays_zip("lows", "highs")).alias(
        "feature", "_r"))
    return each.groupBy("tree", "node", "feature").agg(
        F.sum("size").alias("size"), F.min("_r.lows").alias("low"), F.max("_r.highs").alias("high"))


# -- scoring -------------------------------------------------------------------------

def _meet(rows: DataFrame, cells: DataFrame, part: Sequence[str], deep: bool) -> DataFrame:
    """(key, path[, x, trees, cells]) of rows walked through the cells of their part.

    Both frames have the columns of ``part``; cells of a part come before its rows.
    """
    kinds = dict(zip(_ARRAYS, ("array<int>", "array<double>", "array<int>", "array<int>",
                               "array<double>", "array<bigint>")))
    none = {name: F.lit(None).cast(kind) for name, kind in kinds.items()}
    both = cells.select(*part, F.lit(0).alias("kind"), F.lit(None).cast("string").alias("key"),
                        F.lit(None).cast("array<double>").alias("x"), "tree_id", *_ARRAYS).unionAll(
        rows.select(*part, F.lit(1), "key", "x", F.lit(None).cast("int"),
                    *[none[a] for a in _ARRAYS]))
    names = list(part)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for found in batches:
            here = list(zip(*[found.column(c).to_pylist() for c in (*names, "kind")]))
            at = 0
            while at < len(here):
                stop = at + 1
                while stop < len(here) and here[stop] == here[at]:
                    stop += 1
                if here[at][:-1] != now:
                    held, now = [], here[at][:-1]
                run = found.slice(at, stop - at)
                if here[at][-1] == 0:
                    arrays = [run.column(a) for a in _ARRAYS]
                    for i, tree in enumerate(run.column("tree_id").to_pylist()):
                        held.append((tree, [a[i].values.to_numpy(zero_copy_only=False)
                                            for a in arrays]))
                elif held:
                    yield walked(run, held)
                at = stop

    def walked(run: pa.RecordBatch, held: list) -> pa.RecordBatch:
        x = _matrix(run.column("x"))
        path = np.zeros(len(x))
        on = []
        for tree, cell in held:
            end = walk(cell, x)
            path += cell[4][end]
            entered = cell[5][end]
            if deep and entered.any():
                on.append((tree, entered))
        out = [run.column("key"), pa.array(path)]
        if deep:
            trees = [[t for t, e in on if e[i]] for i in range(len(x))]
            cells_ = [[int(e[i]) for _, e in on if e[i]] for i in range(len(x))]
            out += [run.column("x"), pa.array(trees, pa.list_(pa.int32())),
                    pa.array(cells_, pa.list_(pa.int64()))]
        return pa.record_batch(out, names=["key", "path", "x", "trees", "cells"][:len(out)])
    shape = "key string, path double" + (
        ", x array<double>, trees array<int>, cells array<bigint>" if deep else "")
    return (both.repartition(*part).sortWithinPartitions(*part, "kind")
            .mapInArrow(go, shape))


def path_sums(frame: DataFrame, forest: Forest, key: str = KEY, group_bytes: int = GROUP_BYTES,
              part_rows: int = PART_ROWS, turn_bytes: int = TURN_BYTES) -> DataFrame:
    """(key, path): path lengths over all trees added up, one row a key; keys are distinct."""
    kind = frame.schema[key].dataType
    rows = frame.select(F.col(key).cast("string").alias("key"),
                        _vector(forest.columns).alias("x"))
    first = forest.cells.where(F.col("cell") == 1)
    size = F.size("feature") * F.lit(_NODE_BYTES)
    n, (total, deep) = frame.count(), forest.cells.agg(
        F.sum(F.when(F.col("cell") == 1, size)), F.coalesce(F.max("cell") > 1, F.lit(False))).first()
    parts = max(1, -(-n // part_rows))
    groups = max(1, -(-(total or 0) // group_bytes))
    if groups > 1:
        # One number a tree passes through one task.
        upto = F.sum(size).over(Window.orderBy("tree_id")) - size
        first = first.withColumn("group", F.floor(upto / group_bytes).cast("int"))
    else:
        first = first.withColumn("group", F.lit(0))
    first = first.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    dealt = rows.withColumns({
        "part": F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int"),
        "group": F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))})
    met = _meet(dealt, first, ["group", "part"], deep)
    if deep:
        met = _stored(met, "forest-entered")
        sums = met.select("key", "path")
        turn = max(1, min(forest.n_trees, turn_bytes // max(1, 8 * len(forest.columns) * n)))
        for at in range(0, forest.n_trees, turn):
            entered = met.select("key", "x", F.explode(F.arrays_zip("trees", "cells")).alias("e")).select(
                "key", "x", F.col("e.trees").alias("tree_id"), F.col("e.cells").alias("cell")).where(
                F.col("tree_id").between(at, at + turn - 1))
            counts = entered.groupBy("tree_id", "cell").agg(
                F.ceil(F.count("*") / part_rows).cast("int").alias("parts"))
            some = forest.cells.join(counts, ["tree_id", "cell"]).withColumns({
                "tree": F.col("tree_id"),
                "part": F.explode(F.sequence(F.lit(0), F.col("parts") - 1))})
            mine = entered.join(counts, ["tree_id", "cell"]).withColumns({
                "tree": F.col("tree_id"),
                "part": F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")})
            sums = sums.unionAll(_stored(
                _meet(mine, some, ["tree", "cell", "part"], False), "forest-paths"))
        met = sums
    if deep or groups > 1:
        met = met.groupBy("key").agg(F.sum("path").alias("path"))
    return met.select(F.col("key").cast(kind).alias(key), "path")


def iso_scores(features: DataFrame, forest: Forest | None, orientation: str = "normality",
               key: str = KEY) -> DataFrame:
    """(cohort_key, iso_score) scaled to [0, 1] over all rows; constant scores give 0.

    ``normality`` keeps ordinary cohorts high, the direction published scores have;
    ``anomaly`` turns it round.
    """
    if orientation not in ("normality", "anomaly"):
        raise ValueError(f"unknown orientation: {orientation}")
    if forest is None:
        return features.select(key, F.lit(0.0).alias("iso_score"))
    # Written once: the trees are walked before the scale is known and not again after.
    ensure_checkpoint_dir(features.sparkSession)
    raw = forest.normality(features, key).checkpoint()
    low, high = raw.agg(F.min("normality"), F.max("normality")).first()
    if low is None or not high > low:
        return features.select(key, F.lit(0.0).alias("iso_score"))
    scaled = (F.col("normality") - F.lit(low)) / F.lit(high - low)
    return raw.select(key, (scaled if orientation == "normality" else 1 - scaled)
                      .alias("iso_score"))
