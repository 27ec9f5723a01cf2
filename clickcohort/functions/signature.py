"""Request signature and set similarity."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from clickcohort.functions.cleaning import strip

# The fields of a signature, in order.
SIGNATURE_FIELDS = (
    "origin", "destination", "dep_date", "ret_date", "pax_config", "cabin", "stops",
)


def payload_signature(columns: Iterable[str]) -> Column:
    """SHA-1 over the lower-cased, stripped fields; an absent or null one is empty.

    ``concat_ws`` drops nulls, hence the coalesce.
    """
    present = set(columns)
    parts = [
        strip(F.lower(F.coalesce(F.col(name).cast("string"), F.lit(""))))
        if name in present else F.lit("")
        for name in SIGNATURE_FIELDS
    ]
    return F.sha1(F.concat_ws("|", *parts))


def jaccard_from_sizes(common: Column, left: Column, right: Column) -> Column:
    """Similarity of two sets from their sizes and that of their intersection."""
    return (
        F.when((left == 0) & (right == 0), F.lit(1.0))
        .when((left == 0) | (right == 0), F.lit(0.0))
        .otherwise(common / (left + right - common))
    )


def jaccard_arrays(left: Column, right: Column) -> Column:
    """Similarity of two short array columns (a set held in one row)."""
    common = F.size(F.array_intersect(left, right))
    return jaccard_from_sizes(
        common, F.size(F.array_distinct(left)), F.size(F.array_distinct(right)))
