"""Ladder sweeps: runs of departure dates that climb one day at a time.

Dates are counted per (cohort, date) before they are put in order, so the array that orders
them has each calendar date of a cohort once: its size is bounded by the calendar, not by the
number of events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickcohort.functions.cleaning import parse_date, strip
from clickcohort.operators.tallies import KEY

MIN_DATES = 3     # fewer rows than this are never a sweep
MIN_STEPS = 2     # steps of one day in a row that make a run


def read_day_text(value: Column) -> tuple[Column, Column]:
    """The day a text names, and whether it is text that names none."""
    text = F.nullif(strip(value.cast("string")), F.lit(""))
    day = parse_date(text)
    return day, text.isNotNull() & day.isNull()


def sweep_of_days(days: Column, distinct_dates: bool = False) -> list[Column]:
    """ladder_sweep and ladder_sweep_count of (day, bad, rows) entries, sorted.

    Repeated dates are zero-day steps and break a run unless ``distinct_dates``.
    One date that cannot be read makes the whole cohort no sweep.
    """
    zero = F.lit(0).cast("long")

    def closed(acc: Column) -> Column:
        return acc["total"] + F.when(acc["steps"] >= MIN_STEPS, acc["steps"]).otherwise(zero)

    def step(acc: Column, entry: Column) -> Column:
        one_day = F.coalesce(F.datediff(entry["day"], acc["day"]) == 1, F.lit(False))
        goes_on = one_day if distinct_dates else one_day & (acc["rows"] <= 1)
        return F.struct(
            entry["day"].alias("day"), entry["rows"].alias("rows"),
            (acc["all"] + entry["rows"]).alias("all"), (acc["bad"] | entry["bad"]).alias("bad"),
            (F.when(goes_on, acc["steps"]).otherwise(zero) + one_day.cast("long")).alias("steps"),
            F.when(goes_on, acc["total"]).otherwise(closed(acc)).alias("total"))
    start = F.struct(F.lit(None).cast("date").alias("day"), zero.alias("rows"), zero.alias("all"),
                     F.lit(False).alias("bad"), zero.alias("steps"), zero.alias("total"))
    count = F.aggregate(days, start, step, lambda acc: F.when(
        (acc["all"] >= MIN_DATES) & ~acc["bad"], closed(acc)).otherwise(zero))
    return [(count > 0).alias("ladder_sweep"), count.alias("ladder_sweep_count")]


def ladder_sweep(events: DataFrame, date_col: str = "dep_date", key: str = KEY,
                 distinct_dates: bool = False) -> DataFrame:
    """ladder_sweep, ladder_sweep_count per cohort."""
    day, bad = read_day_text(F.col(date_col))
    counted = events.select(key, day.alias("day"), bad.alias("bad")).groupBy(
        key, "day", "bad").agg(F.count("*").alias("rows"))
    return counted.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(
        "day", "bad", "rows"))).alias("_days")).select(
        key, *sweep_of_days(F.col("_days"), distinct_dates))
