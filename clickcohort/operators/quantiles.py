"""Exact quantiles of whole columns in two scans, without sorting or collecting them.

The first scan counts each column and takes a mergeable sketch of it, whose error in rank is
bounded; that gives a bracket for every wanted quantile. The second counts the different values
inside the brackets, and how many lie below each, and writes them. The rest works on that table:
values are counted in equal-width bins of the open brackets, and per wanted rank the one bin that
holds it is kept, with that bin's true minimum and maximum as the next bracket, until its ends are
equal. Should a bracket miss its rank, that column is counted again from end to end, so results do
not rest on the sketch. Short columns, and those with infinite values, are bracketed by their ends.

Infinite values are counted at both ends and set aside, so every bracket is finite and shrinks.
Bins are picked in Spark: the driver sees one row for each wanted rank.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickcohort.session import ensure_checkpoint_dir

BINS = 4096
#: The sketch's accuracy; brackets reach twice its bound to either side.
ACCURACY = 2_000
SHORT = 20_000


def _number(name: str) -> Column:
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def exact_quantiles(frame: DataFrame, columns: Sequence[str],
                    probs: Sequence[float]) -> dict[str, list[float] | None]:
    """Linearly interpolated quantiles per column; None for a column without values."""
    values = frame.select(*[_number(c).alias(f"c{i}") for i, c in enumerate(columns)])
    infinite = float("inf")

    def finite(i: int) -> Column:
        return F.when(F.abs(f"c{i}") < infinite, F.col(f"c{i}"))

    aside = [min(max(p + d, 0.0), 1.0) for p in probs for d in (-2 / ACCURACY, 2 / ACCURACY)]
    ends = values.agg(*[
        part for i in range(len(columns))
        for part in (F.count(f"c{i}"), F.min(finite(i)), F.max(finite(i)),
                     F.count_if(F.col(f"c{i}") == -infinite),
                     F.count_if(F.col(f"c{i}") == infinite),
                     F.percentile_approx(finite(i), aside, ACCURACY))
    ]).first()
    sizes = {i: ends[6 * i] for i in range(len(columns))}
    spans: list[tuple[int, float, float]] = []
    wanted: dict[tuple[int, int], int] = {}     # (column, rank) -> span
    found: dict[tuple[int, int], float] = {}
    for i, n in sizes.items():
        _, least, most, below, above, near = ends[6 * i:6 * i + 6]
        for k, p in enumerate(probs if n else ()):
            for rank in {math.floor(p * (n - 1)), math.ceil(p * (n - 1))}:
                if rank < below:
                    found[i, rank] = -infinite
                elif rank >= n - above:
                    found[i, rank] = infinite
                else:
                    whole = n <= SHORT or below or above
                    span = (i, least, most) if whole else (i, near[2 * k], near[2 * k + 1])
                    if span not in spans:
                        spans.append(span)
                    wanted[i, rank] = spans.index(span)
    before = {i: ends[6 * i + 3] for i in range(len(columns))}
    missed = _resolve(values, spans, wanted, before, found)
    if missed:
        again = sorted({(i, ends[6 * i + 1], ends[6 * i + 2]) for i, _ in missed})
        of = {i: s for s, (i, _, _) in enumerate(again)}
        _resolve(values, again, {m: of[m[0]] for m in missed}, before, found)
    out: dict[str, list[float] | None] = {}
    for i, name in enumerate(columns):
        n = sizes[i]
        if not n:
            out[name] = None
            continue
        out[name] = []
        for p in probs:
            place = p * (n - 1)
            low, high = found[i, math.floor(place)], found[i, math.ceil(place)]
            out[name].append(_between(low, high, place - math.floor(place)))
    return out


def _between(low: float, high: float, part: float) -> float:
    if low == high or not part:
        return low
    if math.isinf(high - low):
        return low * (1 - part) + high * part
    return low + (high - low) * part


def _resolve(values: DataFrame, spans: list[tuple[int, float, float]],
             wanted: dict[tuple[int, int], int], before: dict[int, int],
             found: dict[tuple[int, int], float]) -> list[tuple[int, int]]:
    """Puts the value of every wanted (column, rank) into ``found``; returns those that do not lie
    in their span. ``before`` has the values of a column that sort before all finite ones."""
    if not wanted:
        return []
    inside, under = _counted(values, spans)
    sizes = {s: (b, n) for s, b, n in under}
    bracket, missed = {}, []
    for (i, rank), span in wanted.items():
        below, size = sizes.get(span, (0, 0))
        place = rank - before[i] - below
        if 0 <= place < size:
            bracket[i, rank] = (span, *spans[span][1:], place)
        else:
            missed.append((i, rank))
    while True:
        still = {k: v for k, v in bracket.items() if v[1] < v[2]}
        if not still:
            break
        ranges = sorted({v[:3] for v in still.values()})
        bins = _bins_of(inside, ranges, sorted({(ranges.index(v[:3]), v[3])
                                                for v in still.values()}))
        for k, (span, low, high, place) in still.items():
            skipped, lo, hi = bins[ranges.index((span, low, high)), place]
            bracket[k] = (span, lo, hi, place - skipped)
    found.update({k: v[1] for k, v in bracket.items()})
    return missed


def _counted(values: DataFrame, spans: list[tuple[int, float, float]]
             ) -> tuple[DataFrame, list]:
    """(span, v, n) of the values inside each span, written; and (span, values below, inside)."""
    def cell(span: int, i: int, low: float, high: float) -> Column:
        v = F.col(f"c{i}")
        below = (v < low) & (v > -float("inf"))
        kept = F.struct(F.lit(span).alias("span"), F.when(~below, v).alias("v"))
        return F.when(below | v.between(low, high), kept)

    cells = F.array(*[cell(s, *span) for s, span in enumerate(spans)])
    ensure_checkpoint_dir(values.sparkSession)
    # All values below a span are one row of it.
    counts = (values.select(F.explode(cells).alias("_c")).where(F.col("_c").isNotNull())
              .groupBy("_c.span", "_c.v").agg(F.count("*").alias("n")).checkpoint())
    under = counts.groupBy("span").agg(
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)),
        F.coalesce(F.sum(F.when(F.col("v").isNotNull(), F.col("n"))), F.lit(0))).collect()
    return counts.where("v is not null"), under


def _bins_of(counts: DataFrame, ranges: list[tuple[int, float, float]],
             ranks: list[tuple[int, int]]) -> dict[tuple[int, int], tuple[int, float, float]]:
    """(range, rank inside it) -> (values of the range before the rank's bin, the bin's ends).

    Bins are counted and picked in Spark; one row for each rank reaches the driver.
    """
    spark = counts.sparkSession
    given = F.broadcast(spark.createDataFrame(
        [(k, *r) for k, r in enumerate(ranges)], "range int, span int, low double, high double"))
    v, low, high = F.col("v"), F.col("low"), F.col("high")
    # Halved only where the width itself would overflow.
    half = F.when(high - low == float("inf"), 0.5).otherwise(1.0)
    place = (v * half - low * half) / (high * half - low * half) * BINS
    binned = (
        counts.join(given, "span").where(v.between(low, high))
        .groupBy("range", F.least(F.floor(place), F.lit(BINS - 1)).cast("int").alias("bin"))
        .agg(F.sum("n").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    )
    # A range has at most BINS rows here.
    order = Window.partitionBy("range").orderBy("bin")
    placed = binned.withColumn("before", F.sum("n").over(order) - F.col("n"))
    wanted = F.broadcast(spark.createDataFrame(ranks, "range int, rank long"))
    rows = (
        placed.join(wanted, "range")
        .where((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n")))
        .select("range", "rank", "before", "lo", "hi").collect()
    )
    return {(r["range"], r["rank"]): (r["before"], r["lo"], r["hi"]) for r in rows}
