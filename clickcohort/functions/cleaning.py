"""Text cleaning, casts and timestamp parsing as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Cell texts read as null (the usual CSV null spellings).
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Texts read as true.
TRUE_TOKENS = ("true", "1", "t", "yes")

# Month-first forms accepted besides ISO text.
TIMESTAMP_FORMATS = ("M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "M/d/yyyy")

WHITESPACE = " \t\n\r\x0b\x0c"


def strip(col: Column) -> Column:
    """Trim every kind of ASCII white space; ``trim`` alone removes only blanks."""
    return F.btrim(col, F.lit(WHITESPACE))


def null_tokens_to_null(col: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    return F.when(strip(col).isin(list(tokens)), F.lit(None)).otherwise(col)


def clean_text(col: Column) -> Column:
    """Strip; the texts ``nan``, ``None`` and the empty text become null."""
    text = strip(col.cast("string"))
    return F.when(~text.isin("nan", "None", ""), text)


def clean_bool(col: Column) -> Column:
    return F.coalesce(F.lower(strip(col.cast("string"))).isin(*TRUE_TOKENS), F.lit(False))


def to_number(col: Column, default: float | None = None) -> Column:
    """Bad text becomes ``default`` (null if none); ``NaN`` counts as bad."""
    number = strip(col.cast("string")).try_cast("double")
    number = F.when(~F.isnan(number), number)
    return number if default is None else F.coalesce(number, F.lit(float(default)))


def parse_timestamp(col: Column, tz: str = "UTC",
                    formats: Sequence[str] = TIMESTAMP_FORMATS) -> Column:
    """Text to instant under a UTC session.

    Text with ``T`` or ``Z`` or its own offset is an instant as it stands; other
    text is local time in ``tz``. Text that does not parse becomes null (never the
    current time), so reruns agree and the quality checks can count it.
    """
    text = strip(col.cast("string"))
    parsed = F.try_to_timestamp(text)
    for fmt in formats:
        parsed = F.coalesce(parsed, F.try_to_timestamp(text, F.lit(fmt)))
    if tz.upper() in ("UTC", "Z", "ETC/UTC"):
        return parsed
    is_instant = text.contains("T") | text.contains("Z") | text.rlike(r"[+-]\d{2}:?\d{2}$")
    return F.when(is_instant, parsed).otherwise(F.to_utc_timestamp(parsed, tz))


def parse_date(col: Column, formats: Sequence[str] = TIMESTAMP_FORMATS) -> Column:
    """Text to calendar date, ISO or month first; null where it does not parse."""
    text = strip(col.cast("string"))
    return F.coalesce(text.try_cast("date"),
                      *[F.try_to_timestamp(text, F.lit(f)).cast("date") for f in formats])


def http_version(col: Column) -> Column:
    """``2.0`` and ``3.0`` are the same protocol as ``2`` and ``3``."""
    return F.when(col == "2.0", "2").when(col == "3.0", "3").otherwise(col)


def contains_any_word(col: Column, words: Sequence[str]) -> Column:
    """Case-insensitive "contains one of"; null is False."""
    return F.coalesce(col.rlike("(?i)" + "|".join(words)), F.lit(False))
