"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickcohort.llm.common import stored


def _jumped(parents: DataFrame) -> DataFrame:
    """Every node with the end of its chain of parents; chains are halved each time."""
    while True:
        beyond = parents.select(F.col("node").alias("root"), F.col("root").alias("beyond"))
        after = stored(parents.join(beyond, "root").select(
            "node", F.col("beyond").alias("root"), (F.col("beyond") != F.col("root")).alias("moved")),
            "parents")
        parents = after.select("node", "root")
        if not after.where("moved").limit(1).count():
            return parents


def components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node it is linked to, itself included) of every linked node.

    links: columns a and b. In each round every node takes the smallest of itself and its
    neighbours as parent, chains of parents are followed to their ends, and the links are
    carried over to these ends, where repeated ones and loops fall away; so each round works
    on a fraction of the links of the one before. Every step is a written table; the driver
    sees whether anything is left. Links that repeat, loops and links with a null end are left
    out. No links give no rows.
    """
    def tidy(ends: DataFrame) -> DataFrame:
        return stored(ends.where("a <> b").select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")

    left = tidy(links.where("a is not null and b is not null"))
    labels = None
    while True:
        both = left.union(left.select("b", "a"))
        parents = _jumped(stored(both.groupBy(F.col("a").alias("node")).agg(
            F.least("node", F.min("b")).alias("root")), "parents"))
        if labels is None:
            labels = parents
        else:
            step = parents.select(F.col("node").alias("root"), F.col("root").alias("beyond"))
            labels = stored(labels.join(step, "root", "left").select(
                "node", F.coalesce("beyond", "root").alias("root")), "roots")
        end = parents.select(F.col("node").alias("a"), F.col("root").alias("x"))
        other = parents.select(F.col("node").alias("b"), F.col("root").alias("y"))
        left = tidy(left.join(end, "a").join(other, "b").select(
            F.col("x").alias("a"), F.col("y").alias("b")))
        if not left.limit(1).count():
            return labels
