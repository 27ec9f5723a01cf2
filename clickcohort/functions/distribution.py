"""Measures over a short numeric array, such as the 24 hourly shares of a cohort."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

HOURS = tuple(range(24))
HOUR_COLUMNS = tuple(f"hourly_hist_{hour:02d}" for hour in HOURS)

# Fixed value: keeps log2 away from zero; part of the published results.
ENTROPY_EPSILON = 1e-10


def entropy_bits(shares: Column) -> Column:
    def term(acc, share):
        safe = share + F.lit(ENTROPY_EPSILON)
        return acc - safe * F.log2(safe)
    return F.aggregate(shares, F.lit(0.0), term)


def gini(values: Column) -> Column:
    """Inequality of the values; 0 for an empty array or a total of zero or less.

    Uses the closed form 2*sum(i*x_i)/(n*sum(x)) - (n+1)/n over ascending values,
    equal to the cumulative-sum definition.
    """
    n = F.size(values).cast("double")
    ranked = F.transform(F.array_sort(values), lambda x, i: x * (i + F.lit(1)))
    weighted = F.aggregate(ranked, F.lit(0.0), lambda a, x: a + x)
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return F.when(total > 0, 2 * weighted / (n * total) - (n + 1) / n).otherwise(F.lit(0.0))


def ewma_last(values: Column, alpha: float) -> Column:
    """Last value of the adjusted exponentially weighted mean over an ordered array."""
    keep = 1.0 - alpha
    start = F.struct(F.lit(0.0).alias("num"), F.lit(0.0).alias("den"))

    def step(acc, x):
        return F.struct(
            (acc["num"] * F.lit(keep) + x).alias("num"),
            (acc["den"] * F.lit(keep) + F.lit(1.0)).alias("den"),
        )

    return F.aggregate(
        values, start, step,
        lambda acc: F.when(acc["den"] > 0, acc["num"] / acc["den"]))
