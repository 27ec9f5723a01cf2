"""Spelling variants through a bit-sliced position index.

Words at one edit (a code point inserted, deleted or replaced) are found by bitsets: for each
position and letter, the words with that letter there. `Slice.one_error` walks a word over the
bitsets once and keeps two sets of vocabulary words, all as whole-word bit operations: those that
agree so far without an error, and those with one. With positions aligned the error is a
replacement; with the vocabulary's positions shifted by one it is a letter that the vocabulary
word has more. Deletions are the same pairs seen from the other word.

The vocabulary is cut into slices of one length that agree in one half, as a single edit leaves
one half of the longer (or equal) word untouched: a word lies in the slice of its first and in
that of its second half, and asks the slices of its own length and of the next by the halves it
could share. A pair that shares both halves counts in the first one only. Slices are streamed
from sorted partitions. One with more than `slice_words` words, or asked by more, is dealt to a
grid of parts: words of the index by one hash, asking words by the other; the parts are counted
first, and every pair meets in exactly one part.

A task hands on, per word, the number of near words and the best of them, never pairs.
Forms point to words at least twice as frequent, so their chains are short (at most the binary
logarithm of the greatest frequency); they are followed by pointer jumping over the words that
are someone's form, in as many rounds as the logarithm of that.

Null and empty texts have no words, a null doc_id is hashed as the empty string, repeated rows
count again, ties go to the smallest word in code-point order, and an empty table or one without
frequent words gives no rows. Texts of any length are read whole. Only doc_id and text are read,
so other columns cannot clash.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickcohort.llm.common import small, stored

#: Fixed values of the query.
RUN = r"[A-Za-zÀ-ÿ]+"
ONE_IN, LEAST_LETTERS, LEAST_COUNT, TIMES = 97, 5, 3, 2

SLICE_WORDS = 4096
_HELD_WORDS = 200_000


def run_pattern() -> re.Pattern:
    return re.compile(RUN)


def damaged(run: bytes, crc: int, one_in: int) -> bytes:
    """A Latin-1 run without one letter if its checksum says so."""
    if crc % one_in:
        return run
    at = crc % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, one_in: int = ONE_IN, least_letters: int = LEAST_LETTERS,
                least_count: int = LEAST_COUNT) -> DataFrame:
    """word and n: occurrences of every frequent word over all documents."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern, held = run_pattern(), Counter()
        for found in batches:
            for doc_id, text in zip(found.column("doc_id").to_pylist(),
                                    found.column("text").to_pylist()):
                if not text:
                    continue
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                # Runs are Latin-1, and bytes are lower-cased by ASCII alone.
                own = Counter(pattern.findall(text))
                for run, times in own.items():
                    low = run.encode("latin-1").lower()
                    crc = zlib.crc32(low if low.isascii() else low.decode("latin-1").encode(),
                                     start)
                    word = damaged(low, crc, one_in)
                    if len(word) >= least_letters:
                        held[word] += times
                if len(held) > _HELD_WORDS:
                    yield counted(held)
                    held = Counter()
        if held:
            yield counted(held)

    def counted(held: Counter) -> pa.RecordBatch:
        return pa.record_batch([
            pa.array([w.decode("latin-1") for w in held]),
            pa.array(list(held.values()), pa.int64())], names=["word", "n"])
    partial = docs.select("doc_id", "text").mapInArrow(read, "word string, n bigint")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


class Slice:
    """Bitsets of words of one length, one for each position and letter."""

    def __init__(self, words: list[str]):
        self.words, self.all = words, (1 << len(words)) - 1
        self.length = len(words[0])
        self.sets: list[dict[str, int]] = [{} for _ in range(self.length)]
        for number, word in enumerate(words):
            bit = 1 << number
            for have, letter in zip(self.sets, word):
                have[letter] = have.get(letter, 0) | bit

    def one_error(self, word: str) -> Iterator[str]:
        """Words of the slice at exactly one edit; `word` has its length or one letter less."""
        exact, sets = self.all, self.sets
        if len(word) == self.length:
            one = 0
            for have, letter in zip(sets, word):
                match = have.get(letter, 0)
                one, exact = one & match | exact & ~match, exact & match
                if not one | exact:
                    return
        else:
            # `one` has passed over a letter of its own: its next letter is a position on.
            one = self.all
            for i, letter in enumerate(word):
                exact &= sets[i].get(letter, 0)
                one = one & sets[i + 1].get(letter, 0) | exact
                if not one:
                    return
        while one:
            low = one & -one
            yield self.words[low.bit_length() - 1]
            one ^= low


_ASKS, _HAS = 1, 0


def _entries(words: DataFrame) -> DataFrame:
    """Rows (length, side, half, role, word, n): slices that a word is in and that it asks."""
    size = F.char_length("word")

    def entry(length, side: int, role: int):
        cut = F.floor(length / 2).cast("int")
        half = (F.substring(F.col("word"), F.lit(1), cut) if side == 0
                else F.substring(F.col("word"), size - (length - cut) + 1, length - cut))
        return F.struct(length.alias("length"), F.lit(side).alias("side"), half.alias("half"),
                        F.lit(role).alias("role"))
    all_ = F.array(*[entry(length, side, role) for side in (0, 1)
                     for length, role in ((size, _HAS), (size, _ASKS), (size + 1, _ASKS))])
    return words.select(F.explode(all_).alias("e"), "word", "n").select("e.*", "word", "n")


def _dealt(entries: DataFrame, slice_words: int) -> DataFrame:
    """Entries with the part (row, column) of their slice; large slices have a grid of parts."""
    key = ["length", "side", "half"]
    sizes = entries.groupBy(*key).agg(
        F.count(F.when(F.col("role") == _HAS, 1)).alias("has"),
        F.count(F.when(F.col("role") == _ASKS, 1)).alias("asks"))
    large = sizes.where((F.col("has") > 0) & (F.greatest("has", "asks") > slice_words)).select(
        *key, F.ceil(F.col("has") / slice_words).cast("int").alias("rows"),
        F.ceil(F.col("asks") / slice_words).cast("int").alias("columns"))
    large = small(stored(large, "large-slices"))
    found = entries.join(large, key, "left").withColumns({
        "rows": F.coalesce("rows", F.lit(1)), "columns": F.coalesce("columns", F.lit(1))})
    own = F.xxhash64("word")
    has = F.col("role") == _HAS
    # A word of the index has one row and all columns of the grid; an asking word, the reverse.
    return found.withColumns({
        "row": F.when(has, F.array(F.pmod(own, F.col("rows")).cast("int"))).otherwise(
            F.sequence(F.lit(0), F.col("rows") - 1)),
        "column": F.when(~has, F.array(F.pmod(own, F.col("columns")).cast("int"))).otherwise(
            F.sequence(F.lit(0), F.col("columns") - 1)),
    }).withColumn("row", F.explode("row")).withColumn("column", F.explode("column")).drop(
        "rows", "columns")


class _Found:
    """Number of near words and the best of them, for each word of a part."""

    def __init__(self):
        self.count: Counter = Counter()
        self.best: dict[str, tuple[int, str]] = {}

    def add(self, word: str, near: str, n: int) -> None:
        self.count[word] += 1
        rank = (-n, near)
        if word not in self.best or rank < self.best[word]:
            self.best[word] = rank

    def batch(self) -> pa.RecordBatch:
        return pa.record_batch([
            pa.array(list(self.count)), pa.array(list(self.count.values()), pa.int64()),
            pa.array([-self.best[w][0] for w in self.count], pa.int64()),
            pa.array([self.best[w][1] for w in self.count])],
            names=["word", "n_near", "near_n", "near"])


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Asks each part's bitsets; rows come sorted by part, words of the index first."""
    found, now, words, index = _Found(), None, [], None
    counts: dict[str, int] = {}
    for batch in batches:
        columns = [batch.column(c).to_pylist()
                   for c in ("length", "side", "half", "row", "column", "role", "word", "n")]
        for length, side, half, row, column, role, word, n in zip(*columns):
            part = (length, side, half, row, column)
            if part != now:
                now, words, index, counts = part, [], None, {}
            if role == _HAS:
                words.append(word)
                counts[word] = n
                continue
            if not words:
                continue
            index = index or Slice(words)
            for near in index.one_error(word):
                if side and word.startswith(near[:length // 2]):
                    continue  # they share the first half as well and met there
                found.add(word, near, counts[near])
                if len(word) < length:
                    found.add(near, word, n)
        if len(found.count) > _HELD_WORDS:
            yield found.batch()
            found = _Found()
    if found.count:
        yield found.batch()


def near_words(words: DataFrame, slice_words: int = SLICE_WORDS) -> DataFrame:
    """word, n_near, near_n and near: the number of near words and the best, where any."""
    part = ["length", "side", "half", "row", "column"]
    met = (_dealt(_entries(words), slice_words).repartition(*part)
           .sortWithinPartitions(*part, "role")
           .mapInArrow(_meet, "word string, n_near bigint, near_n bigint, near string"))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    return met.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_best")).select(
        "word", "n_near", (-F.col("_best.less")).alias("near_n"),
        F.col("_best.near").alias("near"))


def _roots(words: DataFrame) -> DataFrame:
    """word and root of the words that are someone's form."""
    links = stored(words.select(F.col("form").alias("word")).where("word is not null").distinct()
                   .join(words.select("word", F.coalesce("form", "word").alias("root")), "word"),
                   "forms")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        jumped = stored(links.join(small(onward), "root").select(
            "word", F.col("_next").alias("root"), (F.col("_next") != F.col("root")).alias("moved")),
            "forms")
        if not jumped.where("moved").limit(1).count():
            return jumped.select("word", "root")
        links = jumped.select("word", "root")


def variants(docs: DataFrame, one_in: int = ONE_IN, least_letters: int = LEAST_LETTERS,
             least_count: int = LEAST_COUNT, times: int = TIMES,
             slice_words: int = SLICE_WORDS) -> DataFrame:
    """word, form, root, n, n_near and form_n of every frequent word."""
    if least_letters < 2:
        raise ValueError("a word needs two halves")
    words = stored(word_counts(docs, one_in, least_letters, least_count), "words")
    near = near_words(words, slice_words)
    is_form = F.col("near_n") >= times * F.col("n")
    known = stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("near")).alias("form"),
        F.when(is_form, F.col("near_n")).alias("form_n")), "word-forms")
    roots = _roots(known).select(F.col("word").alias("form"), "root")
    return known.join(small(roots), "form", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
