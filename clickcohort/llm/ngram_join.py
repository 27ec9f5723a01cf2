"""Jaccard self-join on word n-grams by vertical partitioning, and its groups.

Two documents link when the Jaccard similarity of their n-gram sets is at least num / den.

All n-grams are put in one global order, rare before frequent (by the document frequency of
their hash bucket, counted over all documents, then by hash). Documents of equal sets are one
class and are worked on once. The order is cut into `fragments` of about equal mass; a set
falls into one segment a fragment. The overlap of two sets is counted in each fragment by
itself and summed up per pair, so no task ever holds whole sets of long texts.

Which pairs are counted: two sets that link share an n-gram among the first
n - ceil(n * num / den) + 1 of both (prefix), have similar lengths, and their parity sketches
(one bit a bucket, flipped by each n-gram) differ in no more bits than the sets may differ in
n-grams. None of these tests loses a link. Rows of one prefix n-gram form a run; runs are
cut into salted blocks and each pair of blocks is compared in a task with numpy, so a run of
any size is spread. First every class is paired with its nearest partner in each run; these
pairs are counted and joined to components. As long as that joins any, every class is then
paired with its nearest partner in another component. What is left is looked through for all
pairs across components, so no link between components is lost, and a group of thousands
of near copies is not spelled out as pairs. A pair is counted once: pairs that did not link are
left out of later rounds, and only sets that a round asks for are moved in it.

Null and blank texts have empty sets, which link with nothing. Documents with fewer words
than an n-gram have their whole sequence as one. Rows of one doc_id are rows of their own. A
null doc_id is never the smallest, so a group of null ids only has a null component. Only
doc_id and text are read, so other columns cannot clash; an empty table gives no rows.

Rows are known by 128 bits of doc_id and text. Sets are known by 64 bits; those whose 64 bits
another set has too are found by a second 64 and known by these instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickcohort.llm.common import row_key, small, stored, unused
from clickcohort.llm.components import components
from clickcohort.llm.shingles import U, runs, shingle_sets, texts_of

_BUCKET_BITS = 20
_CHUNK = 4096  # buckets a row when counts are moved
_SKETCH_BITS = 10
_BLOCK = 2048


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("row_key"), "text")


def _digests(found: np.ndarray) -> tuple[int, int]:
    """Two independent numbers of a set: its name, and the one used if another has its name."""
    raw = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
    return (int.from_bytes(raw[:8], "little", signed=True),
            int.from_bytes(raw[8:], "little", signed=True))


def _class_of(digests: tuple[int, int], doubtful: frozenset[int]) -> int:
    return digests[1] if digests[0] in doubtful else digests[0]


def _sketch(found: np.ndarray) -> bytes:
    odd = np.bincount((found >> U(64 - _SKETCH_BITS)).astype(np.int64),
                      minlength=1 << _SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _bucket(found: np.ndarray) -> np.ndarray:
    return (found >> U(64 - _BUCKET_BITS)).astype(np.int64)


# -- sets, classes and the global order ------------------------------------------------

_SETS = ("doc_id bigint, row_key binary, n int, class bigint, second bigint, sketch binary, "
         "chunk int, counts binary")


def _describe(k: int) -> Callable:
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("row_key", pa.binary()), ("n", pa.int32()),
                            ("class", pa.int64()), ("second", pa.int64()),
                            ("sketch", pa.binary()), ("chunk", pa.int32()),
                            ("counts", pa.binary())])
        total, seen = np.zeros(1 << _BUCKET_BITS, dtype=np.int64), set()
        for batch in batches:
            n, names, sketches = [], [], []
            for run in runs(texts_of(batch.column("text"))):
                for found in shingle_sets(run, k):
                    name = _digests(found) if len(found) else (None, None)
                    n.append(len(found))
                    names.append(name)
                    sketches.append(_sketch(found) if len(found) else None)
                    if len(found) and name not in seen:
                        seen.add(name)
                        np.add.at(total, _bucket(found), 1)
            none = pa.nulls(len(n))
            yield pa.record_batch([batch.column("doc_id"), batch.column("row_key"),
                                   pa.array(n, pa.int32()),
                                   *(pa.array([x[i] for x in names], pa.int64()) for i in (0, 1)),
                                   pa.array(sketches, pa.binary()), none.cast(pa.int32()),
                                   none.cast(pa.binary())], schema=schema)
        table = total.reshape(-1, _CHUNK)
        kept = np.flatnonzero(table.any(axis=1))
        for at in range(0, len(kept), 64):
            part = kept[at:at + 64]
            none = pa.nulls(len(part))
            yield pa.record_batch(
                [none.cast(f.type) for f in list(schema)[:6]]
                + [pa.array(part, pa.int32()),
                   pa.array([table[c].tobytes() for c in part], pa.binary())], schema=schema)
    return describe


def _add_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, raw in zip(batch.column("chunk").to_pylist(), batch.column("counts")):
            counts = np.frombuffer(raw.as_buffer(), dtype=np.int64)
            sums[chunk] = sums[chunk] + counts if chunk in sums else counts
    yield pa.record_batch([pa.array(list(sums), pa.int32()),
                           pa.array([s.tobytes() for s in sums.values()], pa.binary())],
                          names=["chunk", "counts"])


def _order(described: DataFrame, fragments: int) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each hash bucket in the global order, and the first rank of each fragment.

    The result has 2**20 entries whatever the input.
    """
    total = np.zeros((1 << _BUCKET_BITS, ), dtype=np.int64).reshape(-1, _CHUNK)
    for row in (described.where("chunk is not null").select("chunk", "counts")
                .repartition("chunk").mapInArrow(_add_chunks, "chunk int, counts binary")
                .collect()):
        total[row["chunk"]] = np.frombuffer(row["counts"], dtype=np.int64)
    counts = total.ravel()
    order = np.argsort(counts, kind="stable")
    rank = np.empty(len(order), dtype=np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    mass = np.cumsum(counts[order])
    cuts = np.searchsorted(mass, mass[-1] * np.arange(1, fragments) / fragments)
    return rank, cuts


def _ordered(found: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The set's n-grams renamed so that number order is the global order."""
    low = U(64 - _BUCKET_BITS)
    return np.sort((rank[_bucket(found)].astype(U) << low) | (found & ((U(1) << low) - U(1))))


# -- prefixes and runs --------------------------------------------------------------------

_PREFIX = "gram bigint, class bigint, n int, at int"


def _prefixes(k: int, num: int, den: int, shared) -> Callable:
    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (rank, _, doubtful), seen = shared.value, set()
        for batch in batches:
            for run in runs(texts_of(batch.column("text"))):
                grams, classes, sizes = [], [], []
                for found in shingle_sets(run, k):
                    name = _class_of(_digests(found), doubtful) if len(found) else None
                    if name is None or name in seen:
                        continue
                    seen.add(name)
                    length = len(found) - -(-len(found) * num // den) + 1
                    grams.append(_ordered(found, rank)[:length])
                    classes.append(name)
                    sizes.append(len(found))
                if not grams:
                    continue
                each = np.array([len(g) for g in grams])
                at = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
                yield pa.record_batch(
                    [pa.array(np.concatenate(grams).view(np.int64)),
                     pa.array(np.repeat(np.array(classes, dtype=np.int64), each)),
                     pa.array(np.repeat(np.array(sizes, dtype=np.int32), each)),
                     pa.array(at.astype(np.int32))], names=["gram", "class", "n", "at"])
    return prefixes


def _in_company(num: int, den: int) -> Callable:
    """Of rows sorted by (gram, n, class): those next to another class of similar size."""
    def in_company(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row and whether it is known to have company
        for batch in batches:
            rows = {c: batch.column(c).to_numpy() for c in ("gram", "class", "n", "at")}
            close = np.zeros(len(batch), dtype=bool)
            if held is not None:
                rows = {c: np.concatenate([held[0][c], v]) for c, v in rows.items()}
                close = np.concatenate([held[1], close])
            if not len(close):
                continue
            same = rows["gram"][1:] == rows["gram"][:-1]
            fresh = np.concatenate([[True], ~(same & (rows["class"][1:] == rows["class"][:-1]))])
            known = close[fresh]
            rows = {c: v[fresh] for c, v in rows.items()}
            near = ((rows["gram"][1:] == rows["gram"][:-1])
                    & (rows["n"][:-1].astype(np.int64) * den
                       >= rows["n"][1:].astype(np.int64) * num))
            known[1:] |= near
            known[:-1] |= near
            held = {c: v[-1:] for c, v in rows.items()}, known[-1:]
            kept = np.flatnonzero(known[:-1])
            yield pa.record_batch([pa.array(rows[c][kept]) for c in rows], names=list(rows))
        if held is not None and held[1][0]:
            yield pa.record_batch([pa.array(v) for v in held[0].values()], names=list(held[0]))
    return in_company


def _blocks(rows: DataFrame) -> DataFrame:
    """Rows once for each pair of blocks (i, j) of their run that they take part in."""
    heavy = rows.groupBy("gram").count().where(F.col("count") > _BLOCK).select(
        "gram", F.ceil(F.col("count") / _BLOCK).cast("int").alias("blocks"))
    cut = rows.join(small(heavy), "gram", "left").withColumn(
        "blocks", F.coalesce("blocks", F.lit(1))).withColumn(
        "block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    each = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: F.struct(
        F.least("block", other).alias("i"), F.greatest("block", other).alias("j")))
    # Sorted by size inside a pair of blocks, so that partners of similar size are close.
    return (cut.withColumn("pair", F.explode(each)).select("*", "pair.*").drop("pair", "blocks")
            .repartition("gram", "i", "j").sortWithinPartitions("gram", "i", "j", "n", "class"))


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Batches of sorted rows cut anew so that no group of equal keys is split."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        if not table.num_rows:
            continue
        table = table.combine_chunks()
        last = np.ones(table.num_rows, dtype=bool)
        for key in keys:
            column = table.column(key).to_numpy()
            last &= column == column[-1]
        first = int(np.flatnonzero(last)[0])
        if first:
            yield table.slice(0, first)
        held = table.slice(first)
    if held is not None and held.num_rows:
        yield held


def _pairs(num: int, den: int, nearest: bool) -> Callable:
    """Pairs of classes of different components in the same group that pass the tests on size,
    position and sketch. nearest: for each row only its closest partner."""
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, ["gram", "i", "j"]):
            columns = {c: table.column(c).to_numpy() for c in table.column_names if c != "sketch"}
            raw = b"".join(table.column("sketch").to_pylist())
            sketch = np.frombuffer(raw, dtype=U).reshape(len(table), -1)
            n, at = columns["n"].astype(np.int64), columns["at"].astype(np.int64)
            found, left, step = [], np.arange(len(n) - 1), 0
            while len(left):
                step += 1
                left = left[left + step < len(n)]
                a, b = left, left + step
                go_on = ((columns["gram"][a] == columns["gram"][b])
                         & (columns["i"][a] == columns["i"][b])
                         & (columns["j"][a] == columns["j"][b]) & (n[a] * den >= n[b] * num))
                left = a = a[go_on]
                b = a + step
                across = (columns["i"][a] == columns["j"][a]) | (
                    columns["block"][a] != columns["block"][b])
                across &= columns["component"][a] != columns["component"][b]
                a, b = a[across], b[across]
                need = -(-(n[a] + n[b]) * num // (den + num))
                room = 1 + np.minimum(n[a] - at[a], n[b] - at[b]) - 1
                a, b, need = (x[room >= need] for x in (a, b, need))
                apart = np.bitwise_count(sketch[a] ^ sketch[b]).sum(axis=1, dtype=np.int64)
                near = apart <= n[a] + n[b] - 2 * need
                found.append(np.stack([a[near], b[near], apart[near]]))
            if not found:
                continue
            a, b, apart = np.concatenate(found, axis=1)
            names = columns["class"]
            if nearest:
                one, other = np.concatenate([a, b]), np.concatenate([b, a])
                order = np.lexsort((names[other], np.concatenate([apart, apart]), one))
                one, other = one[order], other[order]
                first = np.concatenate([[True], one[1:] != one[:-1]]) if len(one) else []
                a, b = one[first], other[first]
            low = np.minimum(names[a], names[b])
            high = np.maximum(names[a], names[b])
            both = np.unique(np.stack([low, high]), axis=1)
            yield pa.record_batch([pa.array(both[0]), pa.array(both[1])], names=["a", "b"])
    return pairs


# -- overlaps by fragment -------------------------------------------------------------------

_SEGMENT = "class bigint, n int, fragment int, grams binary"


def _segments(k: int, shared) -> Callable:
    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, cuts, doubtful = shared.value
        for batch in batches:
            for run in runs(texts_of(batch.column("text"))):
                out = []
                for found in shingle_sets(run, k):
                    name = _class_of(_digests(found), doubtful)
                    grams = _ordered(found, rank)
                    place = np.searchsorted(
                        cuts, (grams >> U(64 - _BUCKET_BITS)).astype(np.int64), side="right")
                    bounds = np.searchsorted(place, np.arange(len(cuts) + 2))
                    out += [(name, len(found), f, grams[x:y].tobytes()) for f, (x, y) in
                            enumerate(zip(bounds[:-1], bounds[1:])) if y > x]
                yield pa.record_batch(
                    [pa.array(c, t) for c, t in zip(
                        zip(*out) if out else [[]] * 4,
                        (pa.int64(), pa.int32(), pa.int32(), pa.binary()))],
                    names=["class", "n", "fragment", "grams"])
    return segments


def _count_overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = []
        for x, y in zip(batch.column("grams"), batch.column("others")):
            one = np.frombuffer(x.as_buffer(), dtype=U)
            two = np.frombuffer(y.as_buffer(), dtype=U)
            place = np.minimum(np.searchsorted(two, one), len(two) - 1)
            counts.append(int((two[place] == one).sum()))
        yield pa.record_batch(
            [batch.column(c) for c in ("a", "b", "n", "m")] + [pa.array(counts, pa.int64())],
            names=["a", "b", "n", "m", "overlap"])


def _verified(pairs: DataFrame, segments: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose overlaps, summed over fragments, reach the similarity."""
    asked = small(pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct())
    segments = segments.join(asked, "class", "left_semi")
    first = segments.select(F.col("class").alias("a"), "n", "fragment", "grams")
    second = segments.select(F.col("class").alias("b"), F.col("n").alias("m"), "fragment",
                             F.col("grams").alias("others"))
    lined = first.join(small(pairs), "a").join(second, ["b", "fragment"])
    counted = lined.select("a", "b", "n", "m", "grams", "others").mapInArrow(
        _count_overlaps, "a bigint, b bigint, n int, m int, overlap bigint")
    total = counted.groupBy("a", "b", "n", "m").agg(F.sum("overlap").alias("overlap"))
    return total.where((F.col("n") + F.col("m") - F.col("overlap")) * num
                       <= F.col("overlap") * den).select("a", "b")


def _merged(known: DataFrame, links: DataFrame) -> DataFrame:
    """class, sketch and component once linked components are one."""
    one = known.select(F.col("class").alias("a"), F.col("component").alias("x"))
    two = known.select(F.col("class").alias("b"), F.col("component").alias("y"))
    # Links join components, not their members again.
    roots = components(links.join(one, "a").join(two, "b").select(
        F.col("x").alias("a"), F.col("y").alias("b"))).select(
        F.col("node").alias("component"), "root")
    return stored(known.join(roots, "component", "left").select(
        "class", "sketch", F.coalesce("root", "component").alias("component")), "ngram-known")


def _open(shared: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of the runs that meet more than one component, with sketch and component."""
    mixed = (shared.join(known.drop("sketch"), "class").groupBy("gram")
             .agg(F.min("component").alias("low"), F.max("component").alias("high"))
             .where("low <> high").select("gram"))
    return stored(shared.join(mixed, "gram", "left_semi").join(known, "class"), "ngram-open")


def _paired(rows: DataFrame, num: int, den: int, nearest: bool,
            tried: DataFrame | None = None) -> DataFrame:
    """Pairs to count; those tried before did not link, as their components differ."""
    found = _blocks(rows).mapInArrow(
        _pairs(num, den, nearest), "a bigint, b bigint").distinct()
    if tried is not None:
        found = found.join(small(tried), ["a", "b"], "left_anti")
    return stored(found, "ngram-pairs")


def _classes(sets: DataFrame) -> tuple[DataFrame, DataFrame, frozenset[int]]:
    """The sets, one row for all sets of a class, and the names that more than one set had.

    Of m sets about m * m / 2**65 share a name: 270 of 10**11.
    """
    def gathered(named: DataFrame) -> DataFrame:
        return stored(named.where("class is not null").groupBy("class").agg(
            F.min("row_key").alias("row_key"), F.min("doc_id").alias("smallest"),
            F.first("sketch").alias("sketch"), F.min("second").alias("low"),
            F.max("second").alias("high")), "ngram-classes")
    classes = gathered(sets)
    shared = classes.where("low <> high").select("class")
    doubtful = frozenset(r["class"] for r in shared.collect())
    if doubtful:
        sets = sets.join(small(shared.select("class", F.lit(True).alias("doubtful"))), "class",
                         "left").withColumn("class", F.when(
                             F.col("doubtful"), F.col("second")).otherwise(F.col("class")))
        classes = gathered(sets)
    return sets, classes, doubtful


# -- the join -----------------------------------------------------------------------------------

def near_groups(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5,
                fragments: int = 4) -> DataFrame:
    """doc_id, row_key, n_shingles, component_id and group of every row.

    group names the component also where it has no doc_id; it is null for empty sets.
    """
    spark: SparkSession = docs.sparkSession
    rows = _keyed(docs)
    described = stored(rows.mapInArrow(_describe(k), _SETS), "ngram-sets")
    sets = described.where("chunk is null")
    sets, classes, doubtful = _classes(sets)
    # 2**20 entries, whatever the input, and the few names that more than one set had.
    order = spark.sparkContext.broadcast((*_order(described, fragments), doubtful))

    prefixes = docs.select("text").mapInArrow(_prefixes(k, num, den, order), _PREFIX)
    shared = stored(
        prefixes.repartition("gram").sortWithinPartitions("gram", "n", "class")
        .mapInArrow(_in_company(num, den), _PREFIX), "ngram-shared")
    every = classes.select("class", "sketch", F.col("class").alias("component"))
    close = _paired(shared.join(every, "class"), num, den, nearest=True)
    taking_part = close.select(F.col("a").alias("class")).union(close.select("b")).distinct()
    chosen = stored(classes.join(small(taking_part), "class", "left_semi")
                    .select("class", "row_key", "sketch"), "ngram-chosen")
    texts = rows.select("row_key", "text").join(
        small(chosen.select("row_key")), "row_key", "left_semi")
    segments = stored(texts.select("text").mapInArrow(_segments(k, order), _SEGMENT)
                      .dropDuplicates(["class", "fragment"]), "ngram-segments")

    # A class that met no partner in any run links with nothing, so its rows are done with.
    shared = stored(shared.join(small(chosen.select("class")), "class", "left_semi"),
                    "ngram-kept")
    known = chosen.select("class", "sketch", F.col("class").alias("component"))
    nearest, tried = True, close
    while True:
        links = stored(_verified(close, segments, num, den), "ngram-links")
        found = bool(links.limit(1).count())
        if found:
            known = _merged(known, links)
        if not nearest:  # all pairs across the components have been looked at
            break
        nearest = found
        close = _paired(_open(shared, known), num, den, nearest, tried)
        tried = tried.union(close)

    rooted = classes.select("class", "smallest").join(
        known.select("class", "component"), "class", "left").select(
        "class", "smallest", F.coalesce("component", "class").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("smallest").alias("component_id"))
    component = stored(rooted.join(ids, "root").select(
        "class", F.col("root").alias("group"), "component_id"), "ngram-components")
    return sets.join(component, "class", "left").select(
        "doc_id", "row_key", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(
            F.col("component_id")).alias("component_id"), "group")


def without_near_copies(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """One document, all columns, of each group: the one with the smallest doc_id.

    Of rows with that doc_id the one with the smallest row key stays, once. Documents
    without words are no group and all stay.
    """
    groups = stored(near_groups(docs, k, num, den), "ngram-groups").where("n_shingles > 0")
    rule = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row_key")))
    best = groups.groupBy("group").agg(rule.alias("best"))
    kept = best.select(F.col("best.row_key").alias("row_key"))
    gone_key, again_key = unused(docs, "gone"), unused(docs, "again")
    gone = stored(groups.select("row_key").distinct().join(kept, "row_key", "left_anti"),
                  "ngram-gone").select(F.col("row_key").alias(gone_key))
    key = row_key(F.col("doc_id"), F.col("text"))
    left = docs.join(small(gone), key == F.col(gone_key), "left_anti")
    again = stored(groups.groupBy("row_key").count().where("count > 1").join(
        kept, "row_key", "left_semi").select(F.col("row_key").alias(again_key)), "ngram-again")
    if not again.limit(1).count():
        return left
    repeated = left.join(small(again), key == F.col(again_key), "left_semi")
    return left.join(small(again), key == F.col(again_key), "left_anti").unionByName(
        repeated.withColumn(again_key, key).dropDuplicates([again_key]).drop(again_key))
