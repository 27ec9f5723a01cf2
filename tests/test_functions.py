import datetime as dt

import pytest
from pyspark.sql import functions as F

from clickcohort.functions import cleaning
from clickcohort.functions.distribution import entropy_bits, ewma_last, gini
from clickcohort.functions.signature import jaccard_arrays, payload_signature


def value(spark, column, **literals):
    frame = spark.range(1)
    for name, literal in literals.items():
        frame = frame.withColumn(name, literal)
    return frame.select(column.alias("v")).first()["v"]


def doubles(*xs):
    return F.array(*[F.lit(float(x)) for x in xs])


def test_entropy(spark):
    assert value(spark, entropy_bits(doubles(*[1 / 24] * 24))) == pytest.approx(
        4.584962508262598, abs=1e-9)
    assert value(spark, entropy_bits(doubles(1, *[0] * 23))) == pytest.approx(
        7.626007666637631e-08, rel=1e-6)


@pytest.mark.parametrize("xs, expected", [
    ([1, 1, 1, 1], 0.0), ([0, 0, 0, 10], 0.75), ([1] + [0] * 23, 23 / 24), ([0, 0], 0.0)])
def test_gini(spark, xs, expected):
    assert value(spark, gini(doubles(*xs))) == pytest.approx(expected, abs=1e-12)


def test_gini_of_nothing(spark):
    assert value(spark, gini(F.array().cast("array<double>"))) == 0.0


def test_ewma(spark):
    assert value(spark, ewma_last(doubles(1, 2, 4), 0.3)) == pytest.approx(2.689497716894977)
    assert value(spark, ewma_last(F.array().cast("array<double>"), 0.3)) is None


def test_jaccard(spark):
    def sets(a, b):
        return value(spark, jaccard_arrays(
            F.array(*[F.lit(x) for x in a]).cast("array<int>"),
            F.array(*[F.lit(x) for x in b]).cast("array<int>")))
    assert sets([1, 2], [2, 3]) == pytest.approx(1 / 3)
    assert sets([], []) == 1.0
    assert sets([1], []) == 0.0
    assert sets([1, 1, 2], [1, 2]) == 1.0


def test_signature(spark):
    row = {"origin": " LAX", "destination": "nyc\t", "dep_date": "2025-01-15",
           "ret_date": "2025-01-20", "pax_config": "1-0-0", "cabin": "Economy", "stops": "0"}
    frame = spark.createDataFrame([tuple(row.values())], list(row))
    found = frame.select(payload_signature(frame.columns).alias("s")).first()["s"]
    assert found == "d176caa227c47140c799d6bce25e327319516bde"


def test_signature_null_is_empty(spark):
    frame = spark.createDataFrame([("a", None), ("a", "")], "origin string, cabin string")
    assert frame.select(payload_signature(frame.columns)).distinct().count() == 1


@pytest.mark.parametrize("text, tz, expected", [
    ("2025-01-15T10:00:00Z", "UTC", "2025-01-15 10:00:00"),
    ("2025-01-15T10:00:00.250+02:00", "UTC", "2025-01-15 08:00:00.25"),
    ("2025-01-15 10:00:00", "America/New_York", "2025-01-15 15:00:00"),
    ("2025-01-15T10:00:00Z", "America/New_York", "2025-01-15 10:00:00"),
    ("2025-01-15 10:00:00+02:00", "America/New_York", "2025-01-15 08:00:00"),
    (" 1/5/2025 7:30", "UTC", "2025-01-05 07:30:00"),
    ("not a time", "UTC", None), ("nan", "UTC", None), ("", "UTC", None),
])
def test_parse_timestamp(spark, text, tz, expected):
    found = value(spark, cleaning.parse_timestamp(F.col("t"), tz).cast("string"), t=F.lit(text))
    assert found == expected


def test_unreadable_time_does_not_become_now(spark):
    found = value(spark, cleaning.parse_timestamp(F.lit("garbage")))
    assert found is None or found.year != dt.datetime.now().year


@pytest.mark.parametrize("text, expected", [
    ("true", True), (" YES ", True), ("1", True), ("false", False), ("0", False), (None, False)])
def test_bool(spark, text, expected):
    assert value(spark, cleaning.clean_bool(F.lit(text).cast("string"))) is expected


def test_text_and_numbers(spark):
    assert value(spark, cleaning.clean_text(F.lit("\t a ")), ) == "a"
    assert value(spark, cleaning.clean_text(F.lit("nan"))) is None
    assert value(spark, cleaning.to_number(F.lit("x"))) is None
    assert value(spark, cleaning.to_number(F.lit("x"), 0.0)) == 0.0
    assert value(spark, cleaning.to_number(F.lit(" 404 "))) == 404.0
    assert value(spark, cleaning.http_version(F.lit("2.0"))) == "2"
    assert value(spark, cleaning.null_tokens_to_null(F.lit("N/A"))) is None
    assert value(spark, cleaning.contains_any_word(F.lit("Android PHONE"), ["Phone", "Tablet"]))
    assert value(spark, cleaning.contains_any_word(F.lit(None).cast("string"), ["PC"])) is False
