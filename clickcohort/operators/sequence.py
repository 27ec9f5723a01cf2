"""Ordered measures of a cohort: gaps between events, dense runs, error bursts.

Ordinary cohorts are ordered by one window per cohort, and everything they need
comes out of a single shuffle. A cohort above ``hot_cohort_rows`` would put its
whole history into one task, so such cohorts take another way to the same numbers:

1. identical rows collapse to one row with a count;
2. a range partitioning on (cohort, time, row id) puts hot cohorts in order, runs of
   half ``hot_cohort_rows`` rows in that order are the pieces, and the cut is
   checkpointed so that every later step sees the same. A task holds one large piece
   or many small ones, so tasks follow the rows and not the number of pieces;
3. windows run inside a piece, and what crosses a cut is stitched from one summary
   row per piece, which has its first and last times and the dense gaps at both ends of
   its piece as bits. The rows themselves are joined with nothing.

Gap percentiles are exact on both ways. Gaps add up to the time a cohort spans, so
k different gaps (in microseconds) need a span of k*k/2. The percentile buffer of a
cohort grows with the root of its time span, not with its rows: 416 thousand entries
for a day, 2.3 million for a month.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickcohort.operators.layout import HotCohorts, find_hot, split_hot
from clickcohort.operators.tallies import KEY, Block, joint_block, tallies
from clickcohort.params import Params
from clickcohort.session import ensure_checkpoint_dir

SECOND = 1_000_000
FRAME = 10          # gaps per sliding frame
EDGE = FRAME - 1    # gaps on either side of a cut that a frame across it can reach
COPY_CAP = FRAME + 1  # more copies than this cannot change a sliding frame
TASK_ROWS = 100_000  # rows put in order by one task, where pieces are smaller


def is_error(code: Column) -> Column:
    """Outside 2xx. A code that is not a number is no error and ends a burst."""
    number = code.cast("string").try_cast("double")
    outside = ((number < 200) | (number >= 300)) & ~F.isnan(number)
    return F.coalesce(outside, F.lit(False))


def _ordered_columns(events: DataFrame) -> dict[str, Column]:
    has = set(events.columns)
    ts = F.unix_micros("timestamp") if "timestamp" in has else F.lit(None).cast("long")
    err = is_error(F.col("status_code")) if "status_code" in has else F.lit(False)
    return {"ts": ts, "err": err}


def _narrow(events: DataFrame, key: str) -> DataFrame:
    ordered = _ordered_columns(events)
    return events.select(key, ordered["ts"].alias("ts"), F.col("row_id"),
                         ordered["err"].alias("err"))


def sequence_and_tallies(events: DataFrame, params: Params, key: str, hot: HotCohorts | None
                         ) -> DataFrame:
    """``tallies`` and ``sequence_features`` side by side.

    Without a hot cohort both come out of one scan and one shuffle.
    """
    if hot is not None:
        return tallies(events, params=params, key=key).join(
            sequence_features(events, params, key, hot), key, "left")
    joint = joint_block(events.columns, params=params)
    measured = _by_window(events.withColumns(_ordered_columns(events)), params, key, joint)
    return _finish(measured, params, key, joint)


def _names(percentiles: Sequence[int]) -> list[str]:
    return [f"gap_p{p}" for p in percentiles]


def sequence_features(events: DataFrame, params: Params = Params(), key: str = KEY,
                      hot: HotCohorts | None | str = "find") -> DataFrame:
    """gap_p*, gap_p95_over_p50, max_run_lt_1s, share_lt_2s, error_bursts per cohort.

    A cohort without a gap has percentiles 0 and nulls in the other gap columns.
    Pass ``hot`` when the hot cohorts are known already.
    """
    rows = _narrow(events, key)
    if hot == "find":
        hot = find_hot(rows, params.hot_cohort_rows, key)
    if hot is None:
        measured = _by_window(rows, params, key)
    else:
        size = max(1, params.hot_cohort_rows // 2)
        tasks = math.ceil(hot.rows / max(size, TASK_ROWS))
        ordinary, large = split_hot(rows, hot, key)
        measured = _by_pieces(large, tasks, size, params, key)
        if ordinary is not None:
            measured = _by_window(ordinary, params, key).unionByName(measured)
    return _finish(measured, params, key)


def _finish(measured: DataFrame, params: Params, key: str, also: Block | None = None
            ) -> DataFrame:
    none = F.col("gaps") == 0
    names = _names(params.gap_percentiles)
    measured = measured.withColumns({
        name: F.when(none, F.lit(0.0)).otherwise(F.get("quantiles", F.lit(i)) / SECOND)
        for i, name in enumerate(names)
    })
    outputs = [F.col(key), *[F.col(name) for name in names]]
    if also is not None:
        measured = measured.withColumns(also.steps)
        outputs += also.outputs
    if "gap_p50" in names and "gap_p95" in names:
        outputs.append(
            F.when(~none, F.when(F.col("gap_p50") > 0, F.col("gap_p95") / F.col("gap_p50"))
                   .otherwise(F.lit(0.0))).alias("gap_p95_over_p50"))
    outputs += [
        F.when(~none, F.coalesce("run", F.lit(0))).cast("long").alias("max_run_lt_1s"),
        F.when(~none, F.col("under_2s") / F.col("gaps")).alias("share_lt_2s"),
        F.coalesce("burst", F.lit(0)).cast("long").alias("error_bursts"),
    ]
    return measured.select(*outputs)


def _by_window(rows: DataFrame, params: Params, key: str, also: Block | None = None
               ) -> DataFrame:
    order = Window.partitionBy(key).orderBy(F.asc_nulls_first("ts"), "row_id", "err")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    frame = order.rowsBetween(1 - FRAME, 0)
    gap = F.col("gap")
    probs = [p / 100 for p in params.gap_percentiles]
    return (
        rows.withColumns({
            "gap": F.col("ts") - F.lag("ts").over(order),
            "pos": F.row_number().over(order),
        })
        .withColumns({
            "gap_no": F.count("gap").over(so_far),
            "dense": F.sum((gap < SECOND).cast("int")).over(frame),
            "last_ok": F.max(F.when(~F.col("err"), F.col("pos"))).over(so_far),
        })
        .groupBy(key)
        .agg(
            F.count("gap").alias("gaps"),
            F.percentile("gap", probs).alias("quantiles"),
            F.count_if(gap < 2 * SECOND).alias("under_2s"),
            F.max(F.when(F.col("gap_no") >= FRAME, F.col("dense"))).alias("run"),
            F.max(F.when(F.col("err"), F.col("pos") - F.coalesce("last_ok", F.lit(0))))
            .cast("long").alias("burst"),
            *(also.aggregates if also is not None else []),
        )
    )


def _by_pieces(rows: DataFrame, tasks: int, size: int, params: Params, key: str) -> DataFrame:
    ensure_checkpoint_dir(rows.sparkSession)
    order = [key, "ts", "row_id", "err"]
    cut = (
        rows.groupBy(*order).agg(F.count("*").alias("copies"))
        .repartitionByRange(tasks, *order).sortWithinPartitions(*order)
        # Ids follow the order and go on 2**33 above in the next task: no piece spans two.
        .withColumn("piece", F.expr(f"monotonically_increasing_id() div {size}"))
        .checkpoint()
    )
    # Copies beyond COPY_CAP only lengthen a run of zero gaps that already fills a
    # frame; their number stays in ``weight``.
    rows = cut.withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(COPY_CAP)).cast("int")))
    ).withColumn(
        "weight", F.when(F.col("copy") == COPY_CAP, F.col("copies") - (COPY_CAP - 1))
        .otherwise(F.lit(1)))

    # The gap before a piece, one row each.
    crossing = (
        cut.where(F.col("ts").isNotNull()).groupBy(key, "piece")
        .agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
        .select(key, (F.col("first_ts") - F.lag("last_ts").over(
            Window.partitionBy(key).orderBy("piece"))).alias("gap"),
            F.lit(1).cast("long").alias("weight"))
    )
    inside = Window.partitionBy(key, "piece").orderBy(
        F.asc_nulls_first("ts"), "row_id", "err", "copy")
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    frame = inside.rowsBetween(1 - FRAME, 0)
    whole = Window.partitionBy(key, "piece")
    gap = F.col("gap")
    ordered = (
        rows.withColumns({
            "gap": F.col("ts") - F.lag("ts").over(inside),
            "walked": F.sum("weight").over(so_far),
        })
        .withColumns({
            "fast": (gap < SECOND).cast("int"),
            "gap_no": F.count("gap").over(so_far),
            "gaps_here": F.count("gap").over(whole),
            "dense": F.sum((gap < SECOND).cast("int")).over(frame),
            "last_ok": F.max(F.when(~F.col("err"), F.col("walked"))).over(so_far),
        })
    )
    probs = [p / 100 for p in params.gap_percentiles]
    gaps = (
        ordered.select(key, "gap", "weight").unionByName(crossing).where(gap.isNotNull())
        .groupBy(key, "gap").agg(F.sum("weight").alias("w"))
        .groupBy(key)
        .agg(
            F.sum("w").alias("gaps"),
            F.percentile("gap", probs, F.col("w")).alias("quantiles"),
            F.sum(F.when(gap < 2 * SECOND, F.col("w")).otherwise(F.lit(0))).alias("under_2s"),
        )
    )
    burst_here = F.when(F.col("err"), F.col("walked") - F.coalesce("last_ok", F.lit(0)))
    # The first and the last gaps inside a piece, up to EDGE of them, the latest as the lowest bit.
    from_first = F.least("gaps_here", F.lit(EDGE)) - F.col("gap_no")
    from_last = F.col("gaps_here") - F.col("gap_no")
    summaries = (
        ordered.groupBy(key, "piece")
        .agg(
            F.max(F.when(F.col("gap_no") >= FRAME, F.col("dense"))).alias("run"),
            F.sum("weight").alias("total"),
            F.max("last_ok").alias("last_ok"),
            F.coalesce(F.max(burst_here), F.lit(0)).alias("best"),
            F.coalesce(F.max(F.when(F.col("last_ok").isNull(), burst_here)), F.lit(0)).alias("head"),
            F.least(F.count("gap"), F.lit(EDGE)).cast("int").alias("edge"),
            _bits(F.col("fast"), from_first).alias("first_gaps"),
            _bits(F.col("fast"), from_last).alias("last_gaps"),
            F.min("ts").alias("first_ts"),
            F.max("ts").alias("last_ts"),
        )
        .groupBy(key)
        .agg(
            F.max("run").alias("run_inside"),
            F.sort_array(F.collect_list(F.struct(
                "piece", "total", "last_ok", "best", "head", "edge", "first_gaps", "last_gaps",
                "first_ts", "last_ts")))
            .alias("pieces"),
        )
        .select(key, "run_inside", _stitch_bursts(F.col("pieces")).alias("burst"),
                _stitch_runs(F.col("pieces")).alias("run_across"))
    )
    return (
        summaries.join(gaps, key, "left")
        .select(
            key,
            F.coalesce("gaps", F.lit(0)).alias("gaps"),
            "quantiles",
            F.coalesce("under_2s", F.lit(0)).alias("under_2s"),
            F.greatest("run_inside", "run_across").alias("run"),
            "burst",
        )
    )


def _bits(fast: Column, place: Column) -> Column:
    """The flags of up to EDGE gaps as a number; a gap's place is its bit."""
    bit = F.call_function("shiftleft", fast, place.cast("int"))
    return F.coalesce(F.sum(F.when((place >= 0) & (place < EDGE), bit)), F.lit(0)).cast("int")


def _stitch_runs(pieces: Column) -> Column:
    """Most dense gaps in a frame that crosses a cut; null if no frame does."""
    zero = F.lit(0)
    start = F.struct(zero.alias("bits"), zero.alias("known"), F.lit(None).cast("int").alias("run"),
                     F.lit(None).cast("long").alias("last_ts"))

    def step(acc, piece):
        # The gap over the cut; there is none before the first time of a cohort.
        gap = piece["first_ts"] - acc["last_ts"]
        crosses = gap.isNotNull().cast("int")
        before = F.call_function("shiftleft", acc["bits"], crosses).bitwiseOR(
            F.coalesce((gap < SECOND).cast("int"), zero))
        bits = F.call_function("shiftleft", before, piece["edge"]).bitwiseOR(
            piece["first_gaps"])
        known = acc["known"] + crosses + piece["edge"]
        # Neither side has a whole frame, so each frame of both crosses the cut.
        most = F.when(known >= FRAME, F.array_max(F.transform(
            F.sequence(zero, known - FRAME),
            lambda i: F.bit_count(
                F.call_function("shiftright", bits, i).bitwiseAND((1 << FRAME) - 1)))))
        return F.struct(
            F.when(piece["edge"] == EDGE, piece["last_gaps"])
            .otherwise(bits.bitwiseAND((1 << EDGE) - 1)).alias("bits"),
            F.least(known, F.lit(EDGE)).alias("known"),
            F.greatest(acc["run"], most).alias("run"),
            F.coalesce(piece["last_ts"], acc["last_ts"]).alias("last_ts"))

    return F.aggregate(pieces, start, step, lambda acc: acc["run"])


def _stitch_bursts(pieces: Column) -> Column:
    """Longest error burst over pieces in order; one array entry per piece."""
    zero = F.lit(0).cast("long")
    start = F.struct(zero.alias("open"), zero.alias("best"))

    def step(acc, piece):
        longest = F.greatest(acc["best"], piece["best"], acc["open"] + piece["head"])
        still_open = F.when(
            piece["last_ok"].isNull(), acc["open"] + piece["total"]
        ).otherwise(piece["total"] - piece["last_ok"])
        return F.struct(still_open.alias("open"), longest.alias("best"))

    return F.aggregate(pieces, start, step, lambda acc: acc["best"])
