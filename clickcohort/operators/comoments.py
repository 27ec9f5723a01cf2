"""Pairwise-complete second moments of all columns in one scan.

A partition turns each Arrow batch into masked products: with M the matrix of present
values and Z the values less the batch's column means, M'M counts the common rows of every
pair, Z'M their sums and Z'Z their products. Moments are kept about each pair's own means
and joined by the shift rule, so nothing is lost where a mean is far larger than its spread.
A partition sends one row a pair, whatever its number of rows; those rows are joined in two
levels, so that no task holds more than about the square root of all partitions for a pair.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

# Workers need not have the package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: First-level groups a pair's rows are joined in.
GROUPS = 512
#: Share of the squares about the column's mean below which a variance is taken anew.
CANCELLED = 1e-6

_SHAPE = ("part int, a int, b int, n long, mean_a double, mean_b double, "
          "var_a double, var_b double, cov double, endless boolean")
_STATE = ("n", "mean_a", "mean_b", "var_a", "var_b", "cov", "endless")


def _moments_of(values: np.ndarray) -> dict[str, np.ndarray]:
    """The moments of a batch; NaN is a missing value, an infinite one spoils its pairs."""
    present = ~np.isnan(values)
    endless = np.isinf(values)
    finite = present & ~endless
    held = present.astype(float)
    count = np.maximum(finite.sum(axis=0), 1)
    centre = np.where(finite, values, 0.0).sum(axis=0) / count
    z = np.where(finite, values - centre, 0.0)
    n = held.T @ held
    some = np.maximum(n, 1.0)
    sums = z.T @ held                      # of the row's column over rows that hold the other
    squares = (z * z).T @ held
    out = {
        "n": n,
        "mean": centre[:, None] + sums / some,
        "var": np.maximum(squares - sums * sums / some, 0.0),
        "cov": z.T @ z - sums * sums.T / some,
        "endless": (endless.astype(float).T @ held) > 0,
    }
    # Where the rows of a pair lie far from the column's mean, digits cancel: those pairs are
    # taken about their own means, which also makes a constant's spread exactly zero.
    lost = (out["var"] <= CANCELLED * squares) & (squares > 0)
    for i, j in zip(*np.nonzero(np.triu(lost | lost.T))):
        both = present[:, i] & present[:, j] & ~endless[:, i] & ~endless[:, j]
        if both.any():
            x, y = values[both, i], values[both, j]
            for k, m, v in ((i, j, x), (j, i, y)):
                out["mean"][k, m] = v[0] + (v - v[0]).mean()
                out["var"][k, m] = ((v - out["mean"][k, m]) ** 2).sum()
            out["cov"][i, j] = out["cov"][j, i] = (
                (x - out["mean"][i, j]) * (y - out["mean"][j, i])).sum()
    return out


def _joined(x: dict[str, np.ndarray] | None, y: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    if x is None:
        return y
    n = x["n"] + y["n"]
    some = np.maximum(n, 1.0)
    # A side without rows has no mean of its own.
    step = np.where((x["n"] > 0) & (y["n"] > 0), y["mean"] - x["mean"], 0.0)
    weight = x["n"] * y["n"] / some
    return {
        "n": n,
        "mean": np.where(x["n"] > 0, x["mean"] + step * (y["n"] / some), y["mean"]),
        "var": x["var"] + y["var"] + step * step * weight,
        "cov": x["cov"] + y["cov"] + step * step.T * weight,
        "endless": x["endless"] | y["endless"],
    }


def _partials(batches):
    from pyspark import TaskContext

    total = None
    with np.errstate(all="ignore"):
        for batch in batches:
            if batch.num_rows:
                values = np.column_stack([
                    c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
                total = _joined(total, _moments_of(values))
    if total is None:
        return
    a, b = np.triu_indices(len(total["n"]))
    part = TaskContext.get().partitionId()
    yield pa.RecordBatch.from_arrays([
        pa.array(np.full(len(a), part, "int32")), pa.array(a.astype("int32")),
        pa.array(b.astype("int32")), pa.array(total["n"][a, b].astype("int64")),
        pa.array(total["mean"][a, b]), pa.array(total["mean"][b, a]),
        pa.array(total["var"][a, b]), pa.array(total["var"][b, a]),
        pa.array(total["cov"][a, b]),
        pa.array(total["endless"][a, b] | total["endless"][b, a]),
    ], names=["part", "a", "b", "n", "mean_a", "mean_b", "var_a", "var_b", "cov", "endless"])


def _shifted(x: Column, y: Column) -> Column:
    """Two states of a pair as one."""
    n = x["n"] + y["n"]
    weight = x["n"].cast("double") * y["n"] / n
    da, db = y["mean_a"] - x["mean_a"], y["mean_b"] - x["mean_b"]
    return F.when(x["n"] == 0, y).when(y["n"] == 0, x).otherwise(F.struct(
        n.alias("n"),
        (x["mean_a"] + da * y["n"] / n).alias("mean_a"),
        (x["mean_b"] + db * y["n"] / n).alias("mean_b"),
        (x["var_a"] + y["var_a"] + da * da * weight).alias("var_a"),
        (x["var_b"] + y["var_b"] + db * db * weight).alias("var_b"),
        (x["cov"] + y["cov"] + da * db * weight).alias("cov"),
        (x["endless"] | y["endless"]).alias("endless")))


def _merged(states: DataFrame, *keys: str) -> DataFrame:
    # Sorted, so that equal inputs give equal last digits.
    held = F.sort_array(F.collect_list(F.struct(*_STATE)))
    nothing = F.struct(
        F.lit(0).cast("long").alias("n"), *[F.lit(0.0).alias(c) for c in _STATE[1:6]],
        F.lit(False).alias("endless"))
    return (states.groupBy(*keys).agg(F.aggregate(held, nothing, _shifted).alias("_s"))
            .select(*keys, "_s.*"))


def pair_moments(values: DataFrame) -> DataFrame:
    """(a, b, n, mean_a, mean_b, var_a, var_b, cov, endless) for each a <= b.

    ``a`` and ``b`` are positions of columns, ``var`` and ``cov`` sums of products about the
    means over the ``n`` rows that hold both; null and NaN are missing. ``endless`` says that
    one of those rows is infinite in a or b. No row without input rows. One scan.
    """
    names = values.columns
    if not names:
        raise ValueError("no columns")
    doubles = values.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}")
                              for i, c in enumerate(names)])
    parts = doubles.mapInArrow(_partials, _SHAPE)
    some = _merged(parts.withColumn("part", F.col("part") % GROUPS), "a", "b", "part")
    return _merged(some, "a", "b")


def correlation(moments: DataFrame) -> Column:
    """Of a pair's moments; null if a column is constant, NaN if a value is infinite."""
    spread = F.sqrt(moments["var_a"]) * F.sqrt(moments["var_b"])
    return (F.when(moments["n"] == 0, F.lit(None).cast("double"))
            .when(moments["endless"], F.lit(float("nan")))
            .otherwise(F.try_divide(moments["cov"], spread)))


def named_correlations(frame: DataFrame, columns: Sequence[str], both_ways: bool) -> DataFrame:
    """(column_a, column_b, correlation): pairs in the order of ``columns``.

    ``both_ways`` gives (b, a) too and the diagonal, which is 1 for a column that varies
    and else null. Pairs without common rows are there with null, also of an empty frame.
    """
    names = F.array(*[F.lit(c) for c in columns])
    found = pair_moments(frame.select(*[F.col(f"`{c}`") for c in columns]))
    value = correlation(found)
    known = found.select(
        "a", "b", F.when((F.col("a") == F.col("b")) & (F.col("var_a") > 0), F.lit(1.0))
        .when(F.col("a") != F.col("b"), value).alias("correlation"))
    # Positions of all pairs: a few rows made from the column list, not from the data.
    spark, width = frame.sparkSession, len(columns)
    cells = spark.range(width * width).select(
        F.expr(f"cast(id div {width} as int)").alias("x"),
        F.expr(f"cast(id % {width} as int)").alias("y"))
    cells = cells if both_ways else cells.where(F.col("x") < F.col("y"))
    placed = cells.withColumns({"a": F.least("x", "y"), "b": F.greatest("x", "y")})
    return placed.join(known, ["a", "b"], "left").select(
        names[F.col("x")].alias("column_a"), names[F.col("y")].alias("column_b"), "correlation")
