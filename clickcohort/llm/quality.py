"""Quality classifier: regularised quadratic discriminant over document statistics.

Each text becomes a vector of statistics of its words and characters, with shares passed
through arcsin(sqrt(x)) and counts through log(1 + x). Both classes are Gaussian: a mean and
a covariance that is shrunk towards the pooled one and towards a multiple of the identity.
The score is the logistic function of the difference of the two log densities (Mahalanobis
distances from the Cholesky factors, which are computed once and sent to the tasks, log
determinants and priors), divided by the number of statistics so that it does not saturate.

Statistics are kept as multiples of 1/1024 and the moments are summed as whole numbers, so a
model does not depend on the order of rows. Fitting uses all labelled rows it is given:
sums of one row for each task are added up in Spark, and only the sums reach the driver.

Null and empty texts have all statistics 0 and get a score like any other. Labels that are
null or neither 0 nor 1 are left out; a document with several rows of labels counts once for
each. Rows that repeat are scored each. Without labels of both classes every score is 0.5.
Only doc_id and text are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from clickcohort.llm.common import bounded_batches, small, stored
from clickcohort.llm.shingles import runs, texts_of, word_hashes

UNIT = 1024
_ROWS = 256
POOLED, ROUND = 0.3, 0.05

_KIND = np.zeros((5, 256), dtype=bool)  # letters, capitals, digits, sentence marks, symbols
_KIND[0, 65:91] = _KIND[0, 97:123] = _KIND[0, 128:256] = True
_KIND[1, 65:91] = True
_KIND[2, 48:58] = True
_KIND[3, [ord(c) for c in ".,;:!?'\"()-"]] = True
_KIND[4, 33:127] = ~(_KIND[0] | _KIND[2] | _KIND[3])[33:127]

NAMES = ("words", "word_length", "length_spread", "letters", "capitals", "digits",
         "sentence_marks", "symbols", "distinct_words", "repeated_words", "top_word", "lines",
         "wordless", "marked_ends", "symbol_ends", "capitalised")


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.arcsin(np.sqrt(np.clip(part / np.maximum(whole, 1), 0, 1)))


def _word_statistics(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct words, words equal to the one before, and the top word's count of each text."""
    count = len(bounds) - 1
    distinct, repeated, top = (np.zeros(count) for _ in range(3))
    for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
        if b > a:
            own = hashes[a:b]
            _, each = np.unique(own, return_counts=True)
            distinct[i], top[i] = len(each), each.max()
            repeated[i] = (own[1:] == own[:-1]).sum()
    return distinct, repeated, top


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of whole numbers (multiples of 1/UNIT) a text."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    hashes, start = word_hashes(raw)
    ends = np.cumsum([len(t) + 1 for t in texts])
    bounds = np.concatenate([[0], np.searchsorted(start, ends)])
    first = ends - np.array([len(t) + 1 for t in texts])
    inside = np.add.reduceat  # sums between bounds; every text has its line feed

    def per_text(flags: np.ndarray) -> np.ndarray:
        return inside(flags, first, dtype=np.int64).astype(np.float64)

    def per_word(values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
        return total[bounds[1:]] - total[bounds[:-1]]
    letters, capitals, digits, marks, symbols = (per_text(k[raw]) for k in _KIND)
    lines = per_text(raw == 10) - 1
    space = per_text((raw >= 9) & (raw <= 13) | (raw == 32))
    solid = np.array([len(t) + 1 for t in texts]) - space
    words = np.diff(bounds).astype(np.float64)

    gap = np.concatenate([start[1:], [len(raw)]]).astype(np.int64) if len(start) else start
    blank = np.concatenate([[0], np.cumsum((raw >= 9) & (raw <= 13) | (raw == 32))])
    length = (gap - start) - (blank[gap] - blank[start]) if len(start) else np.zeros(0)
    last = raw[start + length - 1] if len(start) else np.zeros(0, np.uint8)
    lettered = np.concatenate([[0], np.cumsum(_KIND[0][raw] | _KIND[2][raw])])
    wordless = lettered[start + length] == lettered[start] if len(start) else np.zeros(0)
    mean = per_word(length) / np.maximum(words, 1)
    spread = np.sqrt(np.maximum(0, per_word(length.astype(np.float64) ** 2)
                                / np.maximum(words, 1) - mean ** 2))
    distinct, repeated, top = _word_statistics(hashes, bounds)
    columns = (
        np.log1p(words), np.log1p(mean), np.log1p(spread), _share(letters, solid),
        _share(capitals, solid), _share(digits, solid), _share(marks, solid),
        _share(symbols, solid), np.log1p(distinct) / np.maximum(np.log1p(words), 1e-9),
        _share(repeated, words), _share(top, words), _share(lines, words),
        _share(per_word(wordless), words), _share(per_word(_KIND[3][last]), words),
        _share(per_word(_KIND[4][last]), words),
        _share(per_word(_KIND[1][raw[start]] if len(start) else start), words))
    return np.rint(np.stack(columns, axis=1) * UNIT).astype(np.int64)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [statistics(run) for run in runs(texts_of(batch.column("text")))]
        if not found:
            continue
        flat = np.concatenate(found).ravel()
        values = pa.ListArray.from_arrays(
            pa.array(np.arange(len(batch) + 1, dtype=np.int32) * len(NAMES)), pa.array(flat))
        columns = [batch.column(c) for c in batch.schema.names if c != "text"]
        yield pa.record_batch([*columns, values],
                              names=[c for c in batch.schema.names if c != "text"] + ["x"])


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and x, the statistics, of every row."""
    return docs.select("doc_id", "text").mapInArrow(_measure, "doc_id bigint, x array<bigint>")


@dataclass
class Model:
    """means, inverse Cholesky factors, log determinants and log priors of classes 0 and 1."""

    means: np.ndarray
    factors: np.ndarray
    determinants: np.ndarray
    priors: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        values = x / UNIT
        density = []
        for c in (0, 1):
            z = (values - self.means[c]) @ self.factors[c].T
            density.append(self.priors[c] - 0.5 * self.determinants[c] - 0.5 * (z * z).sum(axis=1))
        margin = np.clip((density[1] - density[0]) / len(NAMES), -500, 500)
        return 1 / (1 + np.exp(-margin))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    d = len(NAMES)
    total = np.zeros((2, 1 + d + d * d), dtype=np.int64)
    for batch in batches:
        x = batch.column("x").flatten().to_numpy().reshape(-1, d)
        label = batch.column("label").to_numpy()
        for c in (0, 1):
            own = x[label == c]
            total[c] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
    for c in (0, 1):
        yield pa.record_batch(
            [pa.array(np.full(total.shape[1], c, dtype=np.int32)),
             pa.array(np.arange(total.shape[1], dtype=np.int32)), pa.array(total[c])],
            names=["label", "entry", "value"])


def fit(labelled: DataFrame, pooled: float = POOLED, rounding: float = ROUND) -> Model | None:
    """labelled: x and label (0 or 1). None unless both classes occur."""
    d = len(NAMES)
    sums = np.zeros((2, 1 + d + d * d))
    for row in (labelled.where("label in (0, 1)").select("x", F.col("label").cast("int"))
                .mapInArrow(_moments, "label int, entry int, value bigint")
                .groupBy("label", "entry").agg(F.sum(F.col("value").cast("decimal(38,0)"))
                                               .alias("value")).collect()):
        sums[row["label"], row["entry"]] = float(row["value"])
    counts = sums[:, 0]
    if not counts.all():
        return None
    means = sums[:, 1:1 + d] / counts[:, None] / UNIT
    second = sums[:, 1 + d:].reshape(2, d, d) / counts[:, None, None] / UNIT ** 2
    own = second - means[:, :, None] * means[:, None, :]
    share = counts / counts.sum()
    both = (own * share[:, None, None]).sum(axis=0)
    scale = np.sqrt(np.maximum(np.diag(both), 1e-6))
    factors, determinants = [], []
    for c in (0, 1):
        covariance = ((1 - pooled) * own[c] + pooled * both) / np.outer(scale, scale)
        covariance = (1 - rounding) * covariance + rounding * max(
            np.trace(covariance) / d, 1e-6) * np.eye(d)
        factor = np.linalg.cholesky(covariance)
        factors.append(np.linalg.inv(factor) / scale)
        determinants.append(2 * np.log(np.diag(factor)).sum())
    return Model(means, np.array(factors), np.array(determinants), np.log(share))


def _scorer(model: Model | None):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(-1, len(NAMES))
            scores = np.full(len(x), 0.5) if model is None else model.score(x)
            yield pa.record_batch([batch.column("doc_id"), pa.array(scores)],
                                  names=["doc_id", "score"])
    return score


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from; a null id is not held out."""
    name = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(name.cast("binary")) % 3 == 1


def trained(facts: DataFrame, labels: DataFrame) -> Model | None:
    learned = labels.where(~held_out(F.col("doc_id"))).select(
        F.col("doc_id"), F.col("quality").alias("label"))
    return fit(facts.join(learned, "doc_id"))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    facts = stored(measured(docs), "quality-statistics")
    scores = facts.mapInArrow(_scorer(trained(facts, labels)), "doc_id bigint, score double")
    return scores.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _passes(model: Model | None):
    def passes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            # A few rows at a time, so that a worker holds little besides the batch itself.
            good = [s >= 0.5 for at in range(0, len(texts), _ROWS)
                    for run in runs(texts_of(texts.slice(at, _ROWS)))
                    for s in (np.full(len(run), 0.5) if model is None
                              else model.score(statistics(run)))]
            pa.default_memory_pool().release_unused()
            yield pa.array(good, pa.bool_())
    passes.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(passes, "boolean")


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, all columns, that the classifier does not reject.

    Only texts go to Python and only a flag comes back; rows stay where they are.
    """
    bounded_batches(docs.sparkSession)
    known = labels.select("doc_id").distinct()
    model = trained(measured(docs.join(small(known), "doc_id", "left_semi")), labels)
    return docs.where(_passes(model)(F.col("text")))
