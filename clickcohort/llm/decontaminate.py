"""Benchmark decontamination by spaced seeds.

A seed is a hash over the words at the set positions of a fixed mask; the positions the
mask leaves out may differ. Seeds of all positions of documents and benchmark items are
joined; a hit names a document, an item and the diagonal on which both lie (document
position minus item position). Around each hit the words on the diagonal are compared one
by one, so substituted words are tolerated and chance hits fall away.

An item leaks into a document when, on one diagonal, `similarity` of all its words or of
some `window` words in a row are equal. The four masks find nearly every such passage
(all of 600 random ones and all of 8 to 13 words, see the tests); an inserted or lost word
only moves the rest to another diagonal. Words are runs without white space, lower-cased.

Items shorter than the longest mask (8 words) count with `short_items` only, as they cannot be
told from common phrases. Their masks are all choices of as many words as have to be equal, so
none is missed; only masks for lengths that occur are laid out. Of an item's places in a
document only the best goes on, however common the item is.

Null and empty texts hold no words and leak nothing. Items of equal words count as the one
with the smallest item_id. Rows that repeat give one result row for each pair of doc_id and
item; a null doc_id is kept as it is. Only id and text columns are read, and columns of any
other name are kept; rows are known by 128 bits of doc_id and text. Long texts are cut into overlapping pieces before positions are laid out, so no row grows with the square
of a text.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from clickcohort.llm.common import row_key, small, stored, unused, words

#: Set positions of each mask; positions in between are ignored.
MASKS = ((0, 1, 3, 4, 7), (0, 2, 3, 4, 5), (0, 3, 5, 6, 7), (0, 1, 2, 3, 6))
SPAN = 1 + max(mask[-1] for mask in MASKS)
_PIECE = 1024


def tokens(text: Column) -> Column:
    return words(F.lower(text))


def pieces(items: Column, size: int, overlap: int) -> Column:
    """An array cut into pieces (number, items) of `size` that run on over the next."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(items) - 1, F.lit(0)), F.lit(size))
    return F.transform(starts, lambda s: F.struct(
        (s / size).cast("int").alias("piece"),
        F.slice(items, s + 1, F.lit(size + overlap)).alias("items")))


def short_masks(length: int, similarity: float) -> set[tuple[int, ...]]:
    """Every choice of as many of `length` words as have to be equal, moved to begin at 0."""
    least = max(1, -(-length * round(similarity * 100) // 100))
    return {tuple(k - kept[0] for k in kept) for kept in combinations(range(length), least)}


def seeds(frame: DataFrame, key: str, masks: Sequence[tuple[int, ...]] = MASKS) -> DataFrame:
    """key, at (position) and seed of every position and mask of `frame`'s column tokens."""
    hashed = frame.where(F.size("tokens") > min(mask[-1] for mask in masks)).select(
        key, F.transform("tokens", lambda w: F.xxhash64(w)).alias("h"))
    cut = hashed.select(key, F.explode(pieces(F.col("h"), _PIECE, SPAN - 1)).alias("p")).select(
        key, (F.col("p.piece") * _PIECE).alias("base"), F.col("p.items").alias("h"))
    shifted = [F.col("h") if k == 0 else F.slice("h", k + 1, F.lit(_PIECE)) for k in range(SPAN)]
    named = [c.alias(f"w{k}") for k, c in enumerate(shifted)]
    laid = cut.select(key, "base", F.posexplode(F.arrays_zip(*named)).alias("at", "w"))
    laid = laid.where(F.col("at") < _PIECE).select(
        key, (F.col("base") + F.col("at")).alias("at"),
        *[F.col(f"w.w{k}").alias(f"w{k}") for k in range(SPAN)])
    each = F.array(*[
        F.when(F.col(f"w{mask[-1]}").isNotNull(),
               F.xxhash64(F.lit(sum(2 ** k for k in mask)), *[F.col(f"w{k}") for k in mask]))
        for mask in masks])
    return laid.select(key, "at", F.explode(each).alias("seed")).where("seed is not null")


def benchmark_items(benchmark: DataFrame, least: int = SPAN) -> DataFrame:
    """item_id and tokens of items of at least `least` words, one row for all of equal words."""
    return (benchmark.select("item_id", tokens(F.col("text")).alias("tokens"))
            .groupBy("tokens").agg(F.min("item_id").alias("item_id"))
            .where(F.size("tokens") >= least))


def overlaps(docs: DataFrame, benchmark: DataFrame, window: int = 13,
             similarity: float = 0.8, short_items: bool = False) -> DataFrame:
    """doc_id, item_id, doc_start, n_words and matched of every leak, on its best diagonal."""
    return _leaks(docs, benchmark, window, similarity, short_items).groupBy("doc_id", "item_id").agg(F.max_by(
        F.struct("doc_start", "n_words", "matched"),
        F.struct("matched", -F.col("doc_start"))).alias("b")).select("doc_id", "item_id", "b.*")


def without_leaks(docs: DataFrame, benchmark: DataFrame, window: int = 13,
                  similarity: float = 0.8, short_items: bool = False) -> DataFrame:
    """The documents, all columns, that no benchmark item leaks into."""
    name = unused(docs, "leaked")
    leaked = stored(_leaks(docs, benchmark, window, similarity, short_items).select(
        "row_key").distinct(), "leaked").withColumnRenamed("row_key", name)
    return docs.join(small(leaked), row_key(F.col("doc_id"), F.col("text")) == F.col(name),
                     "left_anti")


def _leaks(docs: DataFrame, benchmark: DataFrame, window: int, similarity: float,
           short_items: bool) -> DataFrame:
    items = benchmark_items(benchmark, 1 if short_items else SPAN)
    longest = items.agg(F.max(F.size("tokens"))).first()[0] or SPAN
    rows = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("row_key"),
                       tokens(F.col("text")).alias("tokens"))
    found = _hits(rows, items.where(F.size("tokens") >= SPAN), MASKS).distinct()
    lengths = sorted(r["n"] for r in items.select(F.size("tokens").alias("n"))
                     .where(F.col("n") < SPAN).distinct().collect())
    for n in lengths:
        masks = sorted(short_masks(n, similarity))
        places = _hits(rows, items.where(F.size("tokens") == n), masks).groupBy(
            "row_key", "item_id", "diagonal").count()
        # More equal words meet more masks; the first place of the most is the best.
        found = found.unionByName(places.groupBy("row_key", "item_id").agg(
            F.max_by("diagonal", F.struct("count", -F.col("diagonal"))).alias("diagonal")))
    hits = stored(found, "seed-hits")
    hits = hits.withColumn("piece", (F.greatest("diagonal", F.lit(0)) / _PIECE).cast("int"))

    touched = rows.join(small(hits.select("row_key").distinct()), "row_key", "left_semi")
    cut = touched.select("row_key", "doc_id", F.explode(
        pieces(F.col("tokens"), _PIECE, longest)).alias("p")).select(
        "row_key", "doc_id", "p.piece", F.col("p.items").alias("here"))
    lined = (cut.join(hits, ["row_key", "piece"])
             .join(small(items.withColumnRenamed("tokens", "there")), "item_id"))
    return _verified(lined, window, similarity)


def _hits(rows: DataFrame, items: DataFrame, masks: Sequence[tuple[int, ...]]) -> DataFrame:
    """row_key, item_id and diagonal of every seed that both have."""
    there = seeds(items, "item_id", masks).withColumnRenamed("at", "item_at")
    here = seeds(rows.select("row_key", "tokens"), "row_key", masks)
    return here.join(small(there), "seed").select(
        "row_key", "item_id", (F.col("at") - F.col("item_at")).alias("diagonal"))


def _verified(lined: DataFrame, window: int, similarity: float) -> DataFrame:
    begin = F.greatest("diagonal", F.lit(0))
    skipped = F.greatest(-F.col("diagonal"), F.lit(0))
    on_item = F.slice("there", skipped + 1, F.size("there"))
    on_doc = F.slice("here", begin - F.col("piece") * _PIECE + 1, F.size("there") - skipped)
    equal = F.zip_with(on_doc, on_item, lambda a, b: F.coalesce(a == b, F.lit(False)).cast("int"))
    scored = lined.select("row_key", "doc_id", "item_id", begin.alias("doc_start"),
                          F.size("there").alias("length"), equal.alias("equal"))
    total = F.aggregate("equal", F.lit(0), lambda s, x: s + x)
    scored = scored.withColumn("matched", total)
    share = round(similarity * 100)
    whole = F.col("matched") * 100 >= F.col("length") * share
    runs = F.exists(
        F.sequence(F.lit(1), F.greatest(F.size("equal") - window + 1, F.lit(1))),
        lambda s: F.aggregate(F.slice("equal", s, window), F.lit(0), lambda t, x: t + x) * 100
        >= window * share)
    enough = F.col("matched") * 100 >= window * share
    return scored.where(whole | (enough & runs)).select(
        "row_key", "doc_id", "item_id", "doc_start", F.size("equal").alias("n_words"), "matched")
