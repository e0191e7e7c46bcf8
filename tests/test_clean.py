from datetime import datetime

import pytest
from pyspark.sql import functions as F

from opinara.functions import clean
from opinara.functions.labels import normalize_label, recode_letter


@pytest.mark.parametrize(
    ("written", "expected"),
    [
        ("2024-01-15T10:00:00Z", datetime(2024, 1, 15, 10)),
        ("2024-01-15T10:00:00.25+02:00", datetime(2024, 1, 15, 8, 0, 0, 250000)),
        ("2024-01-15T10:00:00-0500", datetime(2024, 1, 15, 15)),
        ("2024-01-15 10:00:00", datetime(2024, 1, 15, 10)),
        ("2024-01-15", datetime(2024, 1, 15)),
        ("2024-13-45T10:00:00Z", None),
        ("2024", None),
        ("12:00", None),
        ("2024-01-15T10:00:00 Europe/Paris", None),
        ("soon", None),
        ("", None),
        (None, None),
    ],
)
def test_times(spark, written, expected):
    df = spark.createDataFrame([(written,)], "t string").select(clean.to_time(F.col("t")))
    assert df.first()[0] == expected


def test_like_count(spark):
    rows = [("7",), (None,), ("many",), ("3000000000",), ("12.0",), ("9" * 30,)]
    df = spark.createDataFrame(rows, "likes string")
    found = [r[0] for r in df.select(clean.like_count(F.col("likes"))).collect()]
    assert found == [7, 0, 0, 3_000_000_000, 12, 0]


def test_further_forms_of_time(spark):
    rows = ["2024-01-31T10:00:00+02", "20240131T080000Z", "20240131", "2024-01-31T08", "20240131T0800+0200", "2024", "20241"]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    found = [r[0] and r[0].isoformat() for r in df.select(clean.to_time(F.col("t"))).collect()]
    assert found == [
        "2024-01-31T08:00:00", "2024-01-31T08:00:00", "2024-01-31T00:00:00", "2024-01-31T08:00:00",
        "2024-01-31T06:00:00", None, None,
    ]


def test_first_filled_skips_empty_and_missing_columns(spark):
    df = spark.createDataFrame([("", "b"), ("a", "b"), (None, "")], "x string, y string")
    picked = df.select(clean.first_filled(df, "x", "nowhere", "y", default="none"))
    assert [r[0] for r in picked.collect()] == ["b", "a", "none"]


def test_edited(spark):
    rows = [("2024-01-01", "2024-01-01"), ("2024-01-01", "2024-01-02"), ("2024-01-01", None)]
    df = spark.createDataFrame(rows, "published_at string, updated_at string")
    assert [r[0] for r in df.select(clean.edited(df)).collect()] == [False, True, True]
    assert not df.drop("updated_at").select(clean.edited(df.drop("updated_at"))).first()[0]


def test_age_counts_whole_days_not_midnights(spark):
    as_of = datetime(2024, 1, 10, 1)
    rows = [(datetime(2024, 1, 9, 23),), (datetime(2024, 1, 9, 1),), (datetime(2024, 1, 10, 2),)]
    df = spark.createDataFrame(rows, "t timestamp")
    age = clean.age_days(F.lit(as_of), F.col("t"))
    assert [r[0] for r in df.select(age).collect()] == [0, 1, -1]


def test_labels(spark):
    raw = ["LABEL_0", "LABEL_1", "LABEL_2", "1 star", "2 stars", "3 stars", "4 stars", "5 stars",
           "positive", "Positive", None]
    df = spark.createDataFrame([(r,) for r in raw], "l string")
    assert [r[0] for r in df.select(normalize_label(F.col("l"))).collect()] == [
        "negative", "neutral", "positive", "negative", "negative", "neutral", "positive",
        "positive", "positive", "neutral", "neutral",
    ]


def test_letters(spark):
    df = spark.createDataFrame([("n",), ("ne",), ("p",), ("mixed",), (None,)], "h string")
    assert [r[0] for r in df.select(recode_letter(F.col("h"))).collect()] == [
        "negative", "neutral", "positive", "mixed", None,
    ]
