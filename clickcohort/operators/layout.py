"""Where the rows of a cohort meet.

Without a very large cohort, the (column-pruned) rows of each cohort are brought to
one task by a single shuffle, after which every group-by on the cohort is local. With
one, no cohort is brought together as rows: every group-by combines map-side and
spreads by value before it comes back to the cohort. Map-side is in the tasks that read
the rows, so rows of few such tasks are better dealt out first (``dealt_out``).
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from clickcohort.operators.tallies import KEY
from clickcohort.session import ensure_checkpoint_dir

BROADCAST_KEYS = 100_000

Compute = Callable[[DataFrame], DataFrame]


class HotCohorts(NamedTuple):
    keys: DataFrame | None  # checkpointed; None if no other row is left
    found: int              # number of keys
    rows: int               # rows of all hot cohorts together


def find_hot(events: DataFrame, limit: int, key: str = KEY, count: str | None = None
             ) -> HotCohorts | None:
    """Cohorts with more than ``limit`` rows; None if there are none.

    One pass over the key column, a second where there are some among others, so that later
    uses read the written keys; three numbers reach the driver. ``count`` names a column of row
    numbers where the rows are counted already.
    """
    size = F.count("*") if count is None else F.sum(count)
    sizes = events.groupBy(key).agg(size.alias("size"))
    large = F.col(key).isNotNull() & (F.col("size") > limit)
    found, rows, others = sizes.agg(
        F.count_if(large), F.sum(F.when(large, F.col("size"))),
        F.coalesce(F.sum(F.when(~large, F.col("size"))), F.lit(0))).first()
    if not found:
        return None
    if not others:
        return HotCohorts(None, found, rows)
    ensure_checkpoint_dir(events.sparkSession)
    return HotCohorts(sizes.where(large).select(key).checkpoint(), found, rows)


def split_hot(events: DataFrame, hot: HotCohorts, key: str = KEY
              ) -> tuple[DataFrame | None, DataFrame]:
    """(ordinary rows, hot rows); rows without a key are ordinary, None if no row is."""
    if hot.keys is None:
        return None, events
    keys = F.broadcast(hot.keys) if hot.found <= BROADCAST_KEYS else hot.keys
    return events.join(keys, key, "left_anti"), events.join(keys, key, "left_semi")


def by_cohort(events: DataFrame, hot: HotCohorts | None, compute: Compute,
              key: str = KEY) -> DataFrame:
    """``compute`` in the layout that suits the largest cohort; same result either way."""
    return compute(events.repartition(key) if hot is None else events)


def dealt_out(rows: DataFrame, key: str) -> DataFrame:
    """The rows over as many tasks as there are cores, if fewer tasks read them.

    For narrow rows as they are read, before costly columns are made of them: a file is read by a
    task for each of its blocks at most. Rows of many tasks stay where they are.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores, key)
