"""Mixing sources to target weights by min-cost flow over membership patterns.

A document may belong to several sources. Documents are summed up by membership pattern
(the sorted set of their sources); a pattern offers its words once at no cost and again at
rising, convex costs, and each source wants its quota of words. A min-cost flow from
patterns to sources, solved on the driver over the few sums, says how many words a
pattern gives: the cheapest way repeats as little as possible. Inside a pattern every
document is taken as often as fits, and the rest of the words goes to documents in the
order of a seeded hash; the document on the edge gives only the words still wanted.

The driver sees one row for each pattern and the hash bins that hold an edge, never
documents. Size: words of the text, 0 for null. A null source counts as a source of its own,
ordered last. Empty texts give nothing. Rows that repeat are taken one by one. An empty
table gives no rows. Only doc_id, text and the source column are read by `mix`.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickcohort.llm.common import stored, word_count

#: A source by its name; null is a source, too.
Source = str | None
REPEATS = 3
_SEED = "mix-1"
_BIN = 3  # hex digits: 4,096 bins a level


def ordered(sources: Sequence[Source]) -> list[Source]:
    return sorted(sources, key=lambda s: (s is None, s or ""))


def targets(sizes: dict[Source, int], weights: Sequence[int],
            repeats: int = REPEATS) -> dict[Source, float]:
    """Words wanted of each source: its weight's share of all words, at most `repeats` times
    its size, what is above shared again by weight."""
    names = ordered(list(sizes))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, share, out = sum(sizes.values()), sum(weight.values()), {}
    for s in sorted(names, key=lambda s: Fraction(repeats * sizes[s], weight[s])):
        if left * weight[s] > repeats * sizes[s] * share:
            out[s] = float(repeats * sizes[s])
            left, share = left - repeats * sizes[s], share - weight[s]
        else:
            out[s] = left * weight[s] / share if share else 0.0
    return out


def min_cost_flow(capacity: dict[tuple[Source, ...], int], quota: dict[Source, int],
                  repeats: int = REPEATS) -> dict[tuple[Source, ...], dict[Source, int]]:
    """Words of each pattern for each source: most words at the least cost, where the k-th
    use of a word costs k - 1. Shortest augmenting paths with node potentials."""
    patterns, sources = list(capacity), list(quota)
    nodes = {("p", p): 1 + i for i, p in enumerate(patterns)}
    nodes |= {("s", s): 1 + len(patterns) + i for i, s in enumerate(sources)}
    sink = 1 + len(nodes)
    graph: list[list[int]] = [[] for _ in range(sink + 1)]
    edges: list[list] = []  # to, room, cost

    def edge(a: int, b: int, room: int, cost: int) -> int:
        graph[a].append(len(edges))
        edges.append([b, room, cost])
        graph[b].append(len(edges))
        edges.append([a, 0, -cost])
        return len(edges) - 2

    total = sum(quota.values())
    carried = {}
    for p in patterns:
        for again in range(repeats):
            edge(0, nodes["p", p], capacity[p], again)
        for s in p:
            if s in quota:
                carried[p, s] = edge(nodes["p", p], nodes["s", s], total, 0)
    for s in sources:
        edge(nodes["s", s], sink, quota[s], 0)
    potential = [0] * (sink + 1)
    while True:
        far, via, queue = [None] * (sink + 1), [-1] * (sink + 1), [(0, 0)]
        far[0] = 0
        while queue:
            d, a = heapq.heappop(queue)
            if d > far[a]:
                continue
            for e in graph[a]:
                b, room, cost = edges[e]
                if room > 0:
                    step = d + cost + potential[a] - potential[b]
                    if far[b] is None or step < far[b]:
                        far[b], via[b] = step, e
                        heapq.heappush(queue, (step, b))
        if far[sink] is None:
            break
        potential = [p + (f if f is not None else far[sink]) for p, f in zip(potential, far)]
        path, at = [], sink
        while at:
            path.append(via[at])
            at = edges[via[at] ^ 1][0]
        amount = min(edges[e][1] for e in path)
        for e in path:
            edges[e][1] -= amount
            edges[e ^ 1][1] += amount
    out: dict[tuple[Source, ...], dict[Source, int]] = defaultdict(dict)
    for (p, s), e in carried.items():
        out[p][s] = edges[e ^ 1][1]
    return out


def _edge(bins: DataFrame, label: str, wanted: DataFrame) -> DataFrame:
    """The one bin of each pattern in which its remaining words run out, and what is left."""
    order = Window.partitionBy("_pattern").orderBy("bin")
    before = F.sum("words").over(order) - F.col("words")
    return (bins.join(F.broadcast(wanted), "_pattern").withColumn("before", before)
            .where((F.col("before") <= F.col("rest"))
                   & (F.col("rest") < F.col("before") + F.col("words")))
            .select("_pattern", F.col("bin").alias(label),
                    (F.col("rest") - F.col("before")).alias("rest")))


def _sized(docs: DataFrame, seed: str) -> DataFrame:
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = docs.withColumns({
        "_pattern": F.array_sort(F.array_distinct("_member")),
        "_size": word_count(F.col("text")), "_order": F.md5(key)})
    return rows.withColumns({"_bin1": F.substring("_order", 1, _BIN),
                             "_bin2": F.substring("_order", 1 + _BIN, _BIN)})


def _taken(docs: DataFrame, weights: Sequence[int], repeats: int, seed: str) -> DataFrame:
    """Rows of doc_id, text, _member (and _row) with _size, _source_size, _target and _taken.
    No text is shuffled. Other columns of documents never get here by their names."""
    spark = docs.sparkSession
    rows = _sized(docs, seed)
    sums = stored(rows.groupBy("_pattern", "_bin1").agg(F.sum("_size").alias("words")),
                  "mix-sums")
    capacity = {tuple(r["_pattern"]): int(r["words"]) for r in
                sums.groupBy("_pattern").agg(F.sum("words").alias("words")).collect()
                if r["_pattern"]}
    sizes: dict[Source, int] = defaultdict(int)
    for pattern, size in capacity.items():
        for source in pattern:
            sizes[source] += size
    wanted = targets(sizes, weights, repeats)
    flows = min_cost_flow(capacity, {s: int(t + 0.5) for s, t in wanted.items()}, repeats)

    plan = spark.createDataFrame(
        [(list(p), sizes[p[0]], wanted[p[0]],
          *(divmod(sum(flows[p].values()), c) if c else (0, 0))) for p, c in capacity.items()],
        "_pattern array<string>, _source_size bigint, _target double, times bigint, rest bigint")
    first = _edge(sums.withColumnRenamed("_bin1", "bin"), "edge1",
                  plan.select("_pattern", "rest")).collect()
    edge1 = spark.createDataFrame(first, "_pattern array<string>, edge1 string, rest bigint")
    inside = rows.join(F.broadcast(edge1.drop("rest")), "_pattern").where("_bin1 = edge1")
    second = _edge(inside.groupBy("_pattern", F.col("_bin2").alias("bin"))
                   .agg(F.sum("_size").alias("words")), "edge2", edge1.drop("edge1")).collect()
    edges = edge1.drop("rest").join(spark.createDataFrame(
        second, "_pattern array<string>, edge2 string, left bigint"), "_pattern")

    known = (rows.join(F.broadcast(plan), "_pattern", "left")
             .join(F.broadcast(edges), "_pattern", "left"))
    place, edge = F.concat("_bin1", "_bin2"), F.concat("edge1", "edge2")
    full = F.coalesce(F.col("times") * F.col("_size"), F.lit(0))
    clear = known.where(F.coalesce(place != edge, F.lit(True))).withColumn(
        "_taken", full + F.when(place < edge, F.col("_size")).otherwise(F.lit(0)))
    along = Window.partitionBy("_pattern").orderBy("_order", "doc_id", "_size").rowsBetween(
        Window.unboundedPreceding, 0)
    before = F.sum("_size").over(along) - F.col("_size")
    cut = known.where(place == edge).withColumn("_taken", full + F.greatest(
        F.lit(0), F.least("_size", F.col("left") - before)))
    return clear.unionByName(cut)


def mix(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), repeats: int = REPEATS,
        sources: Column | None = None, seed: str = _SEED) -> DataFrame:
    """doc_id, size, source_size, target and taken of every document.

    sources: array of a document's sources; by default its one `source`. source_size and
    target are those of the first of them; a document of no source (an empty array) gives
    nothing and has neither.
    """
    member = F.array("source") if sources is None else sources
    rows = docs.select("doc_id", "text", member.alias("_member"))
    return _taken(rows, weights, repeats, seed).select(
        "doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"), F.col("_taken").cast("long").alias("taken"))


def mixed_copies(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), repeats: int = REPEATS,
                 seed: str = _SEED) -> DataFrame:
    """The documents, all columns, each as often as the mix takes it (half a copy rounds up)."""
    copies = F.floor(F.col("_taken") / F.col("_size") + 0.5).cast("int")
    # The rows travel as one column, so their names cannot meet those used here.
    rows = docs.select("doc_id", "text", F.array("source").alias("_member"),
                       F.struct(*docs.columns).alias("_row"))
    chosen = _taken(rows, weights, repeats, seed).where((F.col("_size") > 0) & (copies > 0))
    return chosen.select("_row", F.explode(F.sequence(F.lit(1), copies))).select("_row.*")
