"""Exact top-k inner products through a pivot-distance index.

Components become integers, floor(scale * x); the score is their integer inner product.
With one more component, sqrt(M - |x|^2) for candidates (M the largest squared length) and 0
for queries, a larger inner product is a smaller Euclidean distance: d^2 = |q|^2 + M - 2 q.x.
So the triangle inequality applies.

Index: every vector is keyed by its nearest pivot and the distance to it; vectors are sorted
by (pivot, distance, id) and packed into blocks, each an annulus of one pivot. Search expands
twice. First a query is compared with the annuli that hold its own distance around its
nearest pivot; its k-th best score there bounds the distance of anything better. Then it
goes, around every pivot, through the annuli within that bound and no others, as
|d(q, p) - d(x, p)| <= d(q, x). Queries travel in blocks, so an annulus is read once for
many. The bounds get a slack for rounding; the scores themselves are exact.

Pivots are centres of a sample of at most `sample` vectors, the first by a hash of the id
(a bounded sample only shapes the index; every vector is indexed and results are exact).

Vectors so long (|x| of 2**31 or more after scaling) that scores may not fit 64 bits stay out of
the index: as candidates they are compared with all queries, as queries with all rows, in blocks
and in Python's whole numbers. They are ranked by their exact scores; a score beyond 64 bits is
given as the nearest number of 64 bits. Where there are none, nothing is done for them.

Vectors that are null or hold a null, NaN or infinite component take no part, nor do rows
without an id. Shorter vectors are read as if they ended in zeros. Equal scores are ranked by
id. Rows of one id are one entry, which has the best of their scores. An id never finds
itself. With fewer than k other entries all are listed. Without vectors there are no rows.
"""

from __future__ import annotations

import heapq
import math
import operator
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from clickcohort.llm.common import stored

SCALE, PIVOTS, SAMPLE = 1024, 32, 2048
_BLOCK, _QUERIES = 2048, 256
_LIMIT = 2.0 ** 62


def entries(frame: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """vec_id, x (as given) and v (whole numbers, at most 64 bits) of the rows that take part."""
    finite = F.forall(vector, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = frame.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & finite).select(
        F.col(key).cast("bigint").alias("vec_id"),
        F.transform(vector, lambda x: x.cast("double")).alias("x"))
    return rows.withColumn("v", F.transform("x", lambda x: F.floor(x * scale)))


def _squared(name: str) -> Column:
    return F.aggregate(name, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), dtype=np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def _lift(v: np.ndarray, most: float) -> np.ndarray:
    """Candidates with the component that makes all of them equally long."""
    x = v.astype(np.float64)
    rest = np.sqrt(np.maximum(0.0, most - (x * x).sum(axis=1)))
    return np.concatenate([x, rest[:, None]], axis=1)


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1) - 2 * x @ pivots.T
    return np.sqrt(np.maximum(0.0, square))


def choose_pivots(sample: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Centres of the sample: farthest-first starts, then a few rounds of k-means."""
    start = [0]
    far = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(start) < min(count, len(sample)) and far.max() > 0:
        start.append(int(far.argmax()))
        far = np.minimum(far, ((sample - sample[start[-1]]) ** 2).sum(axis=1))
    centres = sample[start]
    for _ in range(rounds):
        near = _distances(sample, centres).argmin(axis=1)
        centres = np.stack([sample[near == c].mean(axis=0) if (near == c).any() else centres[c]
                            for c in range(len(centres))])
    return centres


class _Space:
    """What every task needs to place vectors: width, largest squared length, pivots.

    long is the number of vectors that stay out of the index.
    """

    def __init__(self, every: DataFrame, pivots: int, sample: int):
        square, short = _squared("v"), _squared("v") < _LIMIT
        facts = every.agg(F.max(F.when(short, F.size("v"))), F.max(F.when(short, square)),
                          F.count_if(~short)).first()
        self.width, self.most = int(facts[0] or 0), float(facts[1] or 0.0)
        self.long = facts[2]
        rows = every.where(short).select("vec_id", "v").orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(sample).collect()
        dense = np.zeros((len(rows), self.width), dtype=np.int64)
        for i, row in enumerate(rows):
            dense[i, :len(row["v"])] = row["v"]
        self.pivots = choose_pivots(_lift(dense, self.most), pivots) if rows else \
            np.zeros((1, self.width + 1))

    def keyed(self, vectors: DataFrame, query: bool) -> DataFrame:
        """vec_id, pivot, distance and the vector as bytes."""
        space = self

        def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                v = _matrix(batch.column("v"), space.width)
                x = np.concatenate([v.astype(np.float64), np.zeros((len(v), 1))], axis=1) \
                    if query else _lift(v, space.most)
                d = _distances(x, space.pivots)
                near = d.argmin(axis=1)
                yield pa.record_batch(
                    [batch.column("vec_id"), pa.array(near.astype(np.int32)),
                     pa.array(d[np.arange(len(d)), near]),
                     pa.array([r.tobytes() for r in v], pa.binary())],
                    names=["vec_id", "pivot", "distance", "v"])
        return vectors.mapInArrow(key, "vec_id bigint, pivot int, distance double, v binary")


_PACKED = ("block string, pivot int, low double, high double, ids binary, distances binary, "
           "vectors binary")


def _pack(limit: int):
    """Sorted rows packed into blocks of one pivot; rows that repeat are packed once."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, number, held = TaskContext.get().partitionId(), 0, []

        def packed():
            pivots, distances, ids, vectors = zip(*held)
            return pa.record_batch(
                [pa.array([f"{part}/{number}"]), pa.array([pivots[0]], pa.int32()),
                 pa.array([min(distances)]), pa.array([max(distances)]),
                 pa.array([np.array(ids, dtype=np.int64).tobytes()], pa.binary()),
                 pa.array([np.array(distances).tobytes()], pa.binary()),
                 pa.array([b"".join(vectors)], pa.binary())],
                names=["block", "pivot", "low", "high", "ids", "distances", "vectors"])
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist()
                             for c in ("pivot", "distance", "vec_id", "v"))):
                if held and row == held[-1]:
                    continue
                if held and (len(held) == limit or row[0] != held[0][0]):
                    yield packed()
                    number, held = number + 1, []
                held.append(row)
        if held:
            yield packed()
    return pack


def _blocks(keyed: DataFrame, limit: int, label: str) -> DataFrame:
    order = ["pivot", "distance", "vec_id", "v"]
    return stored(keyed.repartitionByRange(*order).sortWithinPartitions(*order)
                  .mapInArrow(_pack(limit), _PACKED), label)


def _arrays(ids: bytes, distances: bytes, vectors: bytes):
    ids = np.frombuffer(ids, dtype=np.int64)
    return ids, np.frombuffer(distances), np.frombuffer(vectors, dtype=np.int64).reshape(
        len(ids), -1)


def _scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact integer inner products; on floats where every partial sum fits 53 bits."""
    a, b = (x.astype(np.float64) for x in (queries, vectors))
    bound = np.sqrt((a * a).sum(axis=1).max(initial=0) * (b * b).sum(axis=1).max(initial=0))
    if bound < 2.0 ** 52:
        return (a @ b.T).astype(np.int64)
    return queries @ vectors.T


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of distinct ids, ties to the smaller id."""
    if len(np.unique(ids)) == len(ids) and len(ids) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        kept = scores >= edge
        scores, ids = scores[kept], ids[kept]
    order = np.lexsort((ids, -scores))
    scores, ids = scores[order], ids[order]
    _, first = np.unique(ids, return_index=True)
    first = np.sort(first)[:k]
    return scores[first], ids[first]


_FOUND = "query_id bigint, vec_id bigint, score bigint"


def _compare(space: _Space, k: int, bounded: bool):
    """Rows of a query block beside a data block: the k best of each query."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q_ids, _, q = _arrays(row["q_ids"], row["q_distances"], row["q_vectors"])
                ids, distance, v = _arrays(row["ids"], row["distances"], row["vectors"])
                scores = _scores(q, v)
                begin, end = np.zeros(len(q), int), np.full(len(q), len(ids))
                if bounded:
                    reach = np.frombuffer(row["q_reach"])
                    lifted = np.concatenate([q.astype(np.float64), np.zeros((len(q), 1))], axis=1)
                    away = _distances(lifted, space.pivots[[row["pivot"]]])[:, 0]
                    begin = np.searchsorted(distance, away - reach, side="left")
                    end = np.searchsorted(distance, away + reach, side="right")
                out = []
                for i, (x, y) in enumerate(zip(begin, end)):
                    other = ids[x:y] != q_ids[i]
                    found, names = _best(scores[i, x:y][other], ids[x:y][other], k)
                    out.append((np.full(len(found), q_ids[i]), names, found))
                yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*out)],
                                      names=["query_id", "vec_id", "score"])
    return compare


def _ranked(found: DataFrame, k: int) -> DataFrame:
    one = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return one.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _reaches(space: _Space):
    """Per query block: how far each query must look, and per pivot the range of distances."""
    def reaches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, _, q = _arrays(row["q_ids"], row["q_distances"], row["q_vectors"])
                known = dict(zip(row["bound_ids"] or [], row["bound_scores"] or []))
                x = q.astype(np.float64)
                base = (x * x).sum(axis=1) + space.most
                score = np.array([known.get(i, -np.inf) for i in ids.tolist()], dtype=np.float64)
                # Rounding of roots and products stays far below this share of the lengths.
                slack = 1e-6 * np.sqrt(base) + 1e-3
                reach = np.sqrt(np.maximum(0.0, base - 2 * score)) + slack
                lifted = np.concatenate([x, np.zeros((len(x), 1))], axis=1)
                away = _distances(lifted, space.pivots)
                low = (away - reach[:, None]).min(axis=0)
                high = (away + reach[:, None]).max(axis=0)
                count = len(space.pivots)
                yield pa.record_batch(
                    [pa.array([row["q_block"]] * count), pa.array(np.arange(count, dtype=np.int32)),
                     pa.array(low), pa.array(high), pa.array([reach.tobytes()] * count, pa.binary())],
                    names=["q_block", "pivot", "q_low", "q_high", "q_reach"])
    return reaches


def top_k(frame: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding",
          k: int = 10, scale: int = SCALE, pivots: int = PIVOTS,
          sample: int = SAMPLE) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k best other entries of each query.

    is_query: a condition on vec_id.
    """
    every = entries(frame, key, vector, scale)
    space = _Space(every, pivots, sample)
    vectors = every.where(_squared("v") < _LIMIT).select("vec_id", "v")
    data = _blocks(space.keyed(vectors, query=False), _BLOCK, "pivot-index")
    asked = _blocks(space.keyed(vectors.where(is_query), query=True), _QUERIES, "pivot-queries")
    asked = asked.select(F.col("block").alias("q_block"), F.col("pivot").alias("q_pivot"),
                         F.col("low").alias("q_low"), F.col("high").alias("q_high"),
                         F.col("ids").alias("q_ids"), F.col("distances").alias("q_distances"),
                         F.col("vectors").alias("q_vectors"))
    wide = ["q_block", "q_ids", "q_distances", "q_vectors"]
    rings = data.select("block", "pivot", "low", "high")

    # First expansion: the annuli that hold the queries' own distances.
    home = asked.select("q_block", F.col("q_pivot").alias("pivot"), "q_low", "q_high").join(
        rings, "pivot").where("low <= q_high and high >= q_low").select("q_block", "block")
    near = home.join(data, "block").join(asked.select(*wide), "q_block").mapInArrow(
        _compare(space, k, bounded=False), _FOUND)
    worst = _ranked(near, k).groupBy("query_id").agg(
        F.min("score").alias("score"), F.count("*").alias("n")).where(F.col("n") == k)

    # Second expansion: around every pivot as far as something better may be.
    members = asked.select("q_block", "q_ids").mapInArrow(
        _members, "q_block string, query_id bigint")
    bounds = members.join(worst, "query_id").groupBy("q_block").agg(
        F.collect_list("query_id").alias("bound_ids"),
        F.collect_list("score").alias("bound_scores"))
    ranges = stored(asked.select(*wide).join(bounds, "q_block", "left").mapInArrow(
        _reaches(space), "q_block string, pivot int, q_low double, q_high double, "
        "q_reach binary"), "pivot-ranges")
    todo = ranges.join(rings, "pivot").where("low <= q_high and high >= q_low").select(
        "q_block", "block", "q_reach")
    found = todo.join(data, "block").join(asked.select(*wide), "q_block").mapInArrow(
        _compare(space, k, bounded=True), _FOUND)
    best = _ranked(found, k)
    if space.long:
        best = _with_long(best, every, is_query, k, scale)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, ids in zip(batch.column("q_block").to_pylist(),
                              batch.column("q_ids").to_pylist()):
            names = np.frombuffer(ids, dtype=np.int64)
            yield pa.record_batch([pa.array([block] * len(names)), pa.array(names)],
                                  names=["q_block", "query_id"])


# -- vectors whose scores may not fit 64 bits ---------------------------------------------

_EXACT = "query_id bigint, vec_id bigint, score bigint, place string"
_DIGITS = "0123456789"


def _whole(x: list[float], scale: int) -> list[int]:
    return [math.floor(c * scale) if math.isfinite(c * scale) else int(c) * scale for c in x]


def _place(score: int) -> str:
    """A text that sorts like the number: sign, number of digits, digits."""
    digits = str(abs(score))
    if score >= 0:
        return f"1{len(digits):04d}{digits}"
    return f"0{9999 - len(digits):04d}{digits.translate(str.maketrans(_DIGITS, _DIGITS[::-1]))}"


def _place_of(score: Column) -> Column:
    digits = F.abs(score).cast("string")
    size = F.length(digits)
    return F.when(score >= 0, F.concat(
        F.lit("1"), F.lpad(size.cast("string"), 4, "0"), digits)).otherwise(F.concat(
            F.lit("0"), F.lpad((9999 - size).cast("string"), 4, "0"),
            F.translate(digits, _DIGITS, _DIGITS[::-1])))


def _dealt(rows: DataFrame, size: int, name: str) -> tuple[DataFrame, int]:
    """Different rows in numbered blocks of about `size`, and the number of blocks."""
    rows = stored(rows.select("vec_id", "x").dropDuplicates(), "pivot-long")
    blocks = max(1, -(-rows.count() // size))
    number = F.pmod(F.xxhash64("vec_id", "x"), F.lit(blocks)).cast("int")
    return rows.groupBy(number.alias(name)).agg(
        F.collect_list(F.struct("vec_id", "x")).alias(f"{name}_rows")), blocks


def _compare_exactly(k: int, scale: int) -> Callable:
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.select(["asked_rows", "held_rows"]).to_pylist():
                held = [(r["vec_id"], _whole(r["x"], scale)) for r in row["held_rows"]]
                out = []
                for r in row["asked_rows"]:
                    q, best = _whole(r["x"], scale), {}
                    for name, v in held:
                        if name != r["vec_id"]:
                            score = sum(map(operator.mul, q, v))
                            best[name] = max(best.get(name, score), score)
                    out += [(r["vec_id"], name, max(-2 ** 63, min(2 ** 63 - 1, score)),
                             _place(score)) for name, score in heapq.nsmallest(
                                 k, best.items(), key=lambda e: (-e[1], e[0]))]
                yield pa.record_batch(
                    [pa.array(c, t) for c, t in zip(
                        zip(*out) if out else [[]] * 4,
                        (pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                    names=["query_id", "vec_id", "score", "place"])
    return compare


def _exact(queries: DataFrame, candidates: DataFrame, k: int, scale: int) -> DataFrame:
    """The k best candidates of each query in each block, all queries against all candidates."""
    asked, blocks = _dealt(queries, _QUERIES, "asked")
    held, _ = _dealt(candidates, _BLOCK, "held")
    each = held.withColumn("asked", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return each.join(asked, "asked").mapInArrow(_compare_exactly(k, scale), _EXACT)


def _with_long(best: DataFrame, every: DataFrame, is_query: Column, k: int,
               scale: int) -> DataFrame:
    """The k best of each query once long vectors take part."""
    is_long = _squared("v") >= _LIMIT
    long, short = every.where(is_long), every.where(~is_long)
    found = best.select("query_id", "vec_id", "score",
                        _place_of(F.col("score")).alias("place")).unionByName(
        _exact(every.where(is_query), long, k, scale)).unionByName(
        _exact(long.where(is_query), short, k, scale))
    one = found.groupBy("query_id", "vec_id").agg(
        F.max("score").alias("score"), F.max("place").alias("place"))
    order = Window.partitionBy("query_id").orderBy(F.desc("place"), "vec_id")
    return one.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
