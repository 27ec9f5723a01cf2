"""Ranked lexical search: no random access (NRA) over impact-sorted posting lists.

Terms are the maximal runs of ASCII letters, digits and anything beyond ASCII, with only A-Z
lower-cased. A document's score for an item is the sum, over the item's terms with repeats, of
the term's weight times its saturated count (`Weights`), all in 64-bit integers but for the
logarithm.

1. `forward_index` reads every whole text once and keeps, per document, its number of terms and
   the counts of those terms that any item asks for. It is written once, and numbers of documents
   and terms and document frequencies are summed over it.
2. Each task of `search` reads documents of the index as runs of a bounded number of postings. A
   run's postings are put into one list a term, sorted by impact. An item reads its lists from the
   top, deeper in each round. A document's lower bound is the sum of impacts read so far; its upper
   bound adds, for each list it was not met in, the impact at which that list now stands. Reading
   goes on until no document outside the best k can reach them and the intervals of the best have
   closed, so that membership, order, ties and scores are settled. Nothing is looked up by document.
3. The k best scores an item has met so far bound the next run of the task from below. A task hands
   on at most k rows an item, of which a window takes the k best.

No shuffle carries postings and no list is put together over tasks, so a term that every document
holds costs each task a share. Documents are spread by the files alone. Items are taken in blocks
of at most `block_terms` different (item, term) pairs, found from counted rows; each block is one
pass over the documents, and its terms reach the tasks as one object of that bounded size. One
item with more different terms is a block of its own.

Every row is a document and every row of items is an item: repeated rows rank one by one, and
repeated items (also with a null item_id) each have their result. Null texts have no terms; such
documents count nowhere and such items find nothing. Equal scores go by ascending doc_id, null
last; rows equal in both get successive ranks. Empty tables give no rows. Only doc_id, item_id and
text are read, so other columns cannot clash.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from clickcohort.llm.common import stored

K = 20
BLOCK_TERMS = 200_000
_RUN_POSTINGS = 1_500_000
_FIRST_DEPTH, _DEEPER = 64, 4

#: Letters and digits of ASCII (lower-cased) and bytes beyond it stay, all others part terms.
_TABLE = bytes(b if chr(b).isalnum() and b < 128 or b > 127 else 32
               for b in bytes(range(256)).lower())

_INDEX = "doc_id bigint, n bigint, terms array<int>, counts array<int>"
_FOUND = "item bigint, doc_id bigint, score bigint"


def terms_of(text: str | None) -> list[bytes]:
    """UTF-8 terms; a byte beyond ASCII is always part of a character that is a term's."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


@dataclass(frozen=True)
class Weights:
    """Numbers of documents and terms, and the document frequency of each item term."""

    documents: int
    terms: int
    frequencies: np.ndarray

    def of_terms(self) -> np.ndarray:
        return np.array([math.floor(1000 * math.log((2 * self.documents + 2) / (2 * df + 1)))
                         for df in self.frequencies.tolist()], dtype=np.int64)

    def saturated(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = 100 - 25 + (25 * n * self.documents) // max(self.terms, 1)
        return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def forward_index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, number of terms, and ids and counts of the terms in `vocabulary`, a row a
    document that has any term."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value
        for found in batches:
            ids, sizes, terms, counts = [], [], [], []
            for doc_id, text in zip(found.column("doc_id").to_pylist(),
                                    found.column("text").to_pylist()):
                held = Counter(terms_of(text))
                if not held:
                    continue
                asked = held.keys() & number.keys()
                ids.append(doc_id)
                sizes.append(held.total())
                terms.append([number[t] for t in asked])
                counts.append([held[t] for t in asked])
            yield pa.record_batch([
                pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32())),
            ], names=["doc_id", "n", "terms", "counts"])
    return docs.select("doc_id", "text").mapInArrow(read, _INDEX)


def measure(index: DataFrame, n_terms: int) -> Weights:
    """Two sums and one count a term of the vocabulary, which is bounded by its block."""
    documents, terms = index.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    frequencies = np.zeros(n_terms, dtype=np.int64)
    for term, df in index.select(F.explode("terms").alias("term")).groupBy("term").agg(
            F.count("*")).collect():
        frequencies[term] = df
    return Weights(documents, terms, frequencies)


class Run:
    """Impact-sorted posting lists of some documents."""

    def __init__(self, n: np.ndarray, starts: np.ndarray, terms: np.ndarray, counts: np.ndarray,
                 weights: Weights, of_terms: np.ndarray):
        doc = np.repeat(np.arange(len(n)), np.diff(starts))
        impact = of_terms[terms] * weights.saturated(counts.astype(np.int64), n[doc])
        order = np.lexsort((-impact, terms))
        self.doc, self.impact = doc[order], impact[order]
        self.bounds = np.searchsorted(terms[order], np.arange(len(of_terms) + 1))
        self.size = len(n)

    def best(self, terms: np.ndarray, repeats: np.ndarray, k: int, floor: int
             ) -> tuple[np.ndarray, np.ndarray]:
        """Documents with the k highest scores of at least `floor` (and all that tie with the
        last of them) and these scores."""
        begin, end = self.bounds[terms], self.bounds[terms + 1]
        some = end > begin
        begin, end, repeats = begin[some], end[some], repeats[some]
        lower = np.zeros(self.size, dtype=np.int64)
        at, depth = begin.copy(), _FIRST_DEPTH
        alive: np.ndarray | None = None     # None while unseen documents may still enter
        while True:
            frontier = np.zeros(len(begin), dtype=np.int64)
            for i in range(len(begin)):
                stop = min(int(end[i]), int(begin[i]) + depth)
                docs, impact = self.doc[at[i]:stop], self.impact[at[i]:stop]
                lower[docs] += repeats[i] * impact      # a list has a document once
                at[i] = stop
                if stop < end[i]:
                    frontier[i] = repeats[i] * self.impact[stop]
            still_open = np.flatnonzero(frontier)
            above = np.full(self.size, frontier.sum())  # upper bound less lower bound
            for i in still_open:
                above[self.doc[begin[i]:at[i]]] -= frontier[i]
            seen = np.flatnonzero(lower) if alive is None else alive
            kth = floor
            if len(seen) >= k:
                kth = max(floor, int(np.partition(lower[seen], -k)[-k]))
            # A document that can still reach the k-th lower bound stays, ties included.
            stays = seen[lower[seen] + above[seen] >= kth]
            if alive is not None or frontier.sum() < kth:
                if not above[stays].any():
                    return stays, lower[stays]
                alive = stays
            depth *= _DEEPER


class Best:
    """The k best documents an item has met, worst first."""

    def __init__(self, k: int):
        self.k, self.floor = k, 1
        self.doc: list = []
        self.score = np.zeros(0, dtype=np.int64)

    def add(self, doc_ids: list, scores: np.ndarray) -> None:
        both = [*zip(self.score.tolist(), self.doc), *zip(scores.tolist(), doc_ids)]
        both.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        both = both[:self.k]
        self.score = np.array([s for s, _ in both], dtype=np.int64)
        self.doc = [d for _, d in both]
        if len(both) == self.k:
            self.floor = max(1, both[-1][0])


def _runs(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[list[pa.RecordBatch]]:
    held, postings = [], 0
    for batch in batches:
        at = 0
        ends = batch.column("terms").offsets.to_numpy()
        while at < len(batch):
            room = max(limit - postings, 0)
            stop = int(np.searchsorted(ends, ends[at] + room, side="right")) - 1
            stop = min(len(batch), max(stop, at if held else at + 1))
            if stop > at:
                held.append(batch.slice(at, stop - at))
                postings += int(ends[stop] - ends[at])
            if stop < len(batch):
                yield held
                held, postings = [], 0
            at = stop
    if held:
        yield held


def search(index: DataFrame, items: dict[int, tuple[np.ndarray, np.ndarray]], weights: Weights,
           k: int = K, run_postings: int = _RUN_POSTINGS) -> DataFrame:
    """item, doc_id and score: at most k rows an item and task, all of the best k among them.

    `items` has the numbers of an item's different terms and how often it has each.
    """
    shared = index.sparkSession.sparkContext.broadcast((items, weights))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weighed = shared.value
        of_terms = weighed.of_terms()
        best = {item: Best(k) for item in asked}
        for held in _runs(batches, run_postings):
            whole = pa.Table.from_batches(held).combine_chunks()
            terms, counts = (whole.column(c).chunk(0) for c in ("terms", "counts"))
            offsets = terms.offsets.to_numpy()
            run = Run(whole.column("n").to_numpy(), offsets - offsets[0],
                      terms.flatten().to_numpy(), counts.flatten().to_numpy(), weighed, of_terms)
            doc_ids = whole.column("doc_id")
            for item, (numbers, repeats) in asked.items():
                docs, scores = run.best(numbers, repeats, k, best[item].floor)
                if len(docs):
                    best[item].add(doc_ids.take(pa.array(docs)).to_pylist(), scores)
        rows = [(item, d, s) for item, b in best.items() for d, s in zip(b.doc, b.score.tolist())]
        if rows:
            yield pa.record_batch([pa.array(list(c), pa.int64()) for c in zip(*rows)],
                                  names=["item", "doc_id", "score"])
    return index.where(F.size("terms") > 0).mapInArrow(read, _FOUND)


def _item_rows(items: DataFrame) -> DataFrame:
    """Numbered items with their different terms and how often each has them, written once."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in batches:
            held = [Counter(terms_of(t)) for t in found.column("text").to_pylist()]
            yield pa.record_batch([
                found.column("item"), found.column("item_id"),
                pa.array([list(h) for h in held], pa.list_(pa.binary())),
                pa.array([list(h.values()) for h in held], pa.list_(pa.int64())),
            ], names=["item", "item_id", "terms", "repeats"])
    # Numbers are fixed by the write; they need not be dense.
    kind = items.schema["item_id"].dataType.simpleString()
    numbered = items.select(F.monotonically_increasing_id().alias("item"), "item_id", "text")
    return stored(numbered.mapInArrow(
        read, f"item bigint, item_id {kind}, terms array<binary>, repeats array<bigint>"), "items")


def _blocks(items: DataFrame, limit: int) -> list[tuple[int, int]]:
    """Ranges of item numbers with at most `limit` terms together, or of a single item."""
    sizes = items.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    if sizes <= limit:
        return [(0, 1 << 62)]
    # One row an item reaches one task, without its terms; the blocks are few.
    total = F.sum(F.size("terms")).over(Window.orderBy("item").rowsBetween(
        Window.unboundedPreceding, -1))
    cut = items.select("item", F.floor(F.coalesce(total, F.lit(0)) / limit).alias("block"))
    found = cut.groupBy("block").agg(F.min("item"), F.max("item")).orderBy("block").collect()
    return [(low, high) for _, low, high in found]


def rank(docs: DataFrame, items: DataFrame, k: int = K, block_terms: int = BLOCK_TERMS,
         run_postings: int = _RUN_POSTINGS) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents of every item."""
    numbered = _item_rows(items)
    parts = []
    for low, high in _blocks(numbered, block_terms):
        rows = numbered.where(F.col("item").between(low, high)).select(
            "item", "terms", "repeats").collect()  # bounded by the block
        vocabulary: dict[bytes, int] = {}
        asked = {}
        for item, terms, repeats in rows:
            if terms:
                numbers = [vocabulary.setdefault(bytes(t), len(vocabulary)) for t in terms]
                asked[item] = np.array(numbers), np.array(repeats, dtype=np.int64)
        index = stored(forward_index(docs, vocabulary), "forward-index")
        weights = measure(index, len(vocabulary))
        parts.append(stored(search(index, asked, weights, k, run_postings), "found"))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(numbered.select("item", "item_id"), "item").select(
        "item_id", "rank", "doc_id", "score")
