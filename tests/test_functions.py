import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from viewtide.functions.eventtime import with_event_time, with_watch_month
from viewtide.functions.missing import missing, nan_to_null
from viewtide.functions.rounding import stable_round
from viewtide.functions.signals import alert_level, percentage, with_engagement_flags

NAN = float("nan")


def test_missing_is_null_or_nan_and_never_null(spark):
    df = spark.createDataFrame(
        [(1.0, "a", 1), (NAN, "NaN", None), (None, None, 3)], "x DOUBLE, s STRING, n INT"
    )
    found = df.select(*[missing(df, c).alias(c) for c in df.columns]).collect()
    assert [tuple(r) for r in found] == [
        (False, False, False),
        (True, False, True),
        (True, True, False),
    ]


def test_missing_accepts_awkward_names(spark):
    df = spark.createDataFrame([(None, 1.0)], "`a.b c` STRING, `x``y` DOUBLE")
    assert tuple(df.select(missing(df, "a.b c"), missing(df, "x`y")).first()) == (True, False)


def test_nan_tokens_become_null(spark):
    df = spark.createDataFrame(
        [(NAN, "NaN", 1), (0.0, '"NaN"', 2), (1.5, "Nancy", 3), (None, None, 4)],
        "x DOUBLE, s STRING, n INT",
    )
    assert [tuple(r) for r in nan_to_null(df).collect()] == [
        (None, None, 1),
        (0.0, None, 2),
        (1.5, "Nancy", 3),
        (None, None, 4),
    ]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-12-31 23:59:59", dt.datetime(2024, 12, 31, 23, 59, 59)),
        ("2024-12-31", None),
        ("31.12.2024 10:00:00", None),
        ("2024-02-30 00:00:00", None),
        (None, None),
    ],
)
def test_event_time_is_strict_and_does_not_throw(spark, text, expected):
    df = spark.createDataFrame([(text,)], "timestamp STRING")
    assert with_event_time(df).first()["event_time"] == expected


def test_watch_month_accepts_text_dates_and_timestamps(spark):
    df = spark.sql(
        "SELECT '2024-03-05 01:02:03' AS t, DATE'2024-03-05' AS d, "
        "TIMESTAMP'2024-03-05 01:02:03' AS s, TIMESTAMP_NTZ'2024-03-05 01:02:03' AS n"
    )
    for name in df.columns:
        row = with_watch_month(df, name).first()
        assert (row["watch_year"], row["watch_month"]) == (2024, 3)


def test_stable_round_ignores_summation_noise(spark):
    low, high = math.nextafter(12.35, 0), math.nextafter(12.35, 99)
    df = spark.createDataFrame([(low,), (12.35,), (high,), (-12.35,)], "x DOUBLE")
    found = [r[0] for r in df.select(stable_round(F.col("x"), 1)).collect()]
    assert found == [12.4, 12.4, 12.4, -12.4]


def test_engagement_flags_at_their_limits(spark):
    df = spark.createDataFrame(
        [
            (1, 19.99, 5.0, "stopped", "SD"),
            (2, 20.0, 5.0, "stopped", "HD"),
            (3, 50.0, 5.0, "stopped", "4K"),
            (4, NAN, None, "completed", "Ultra HD"),
            (5, None, NAN, None, None),
        ],
        "id INT, progress_percentage DOUBLE, watch_duration_minutes DOUBLE, action STRING, "
        "quality STRING",
    )
    found = with_engagement_flags(df).select(
        "progress_percentage", "watch_duration_minutes",
        "is_low_engagement", "is_quality_downgrade", "is_abandoned", "is_completed",
    )
    assert [tuple(r) for r in found.collect()] == [
        (19.99, 5.0, 1, 1, 1, 0),
        (20.0, 5.0, 0, 1, 1, 0),
        (50.0, 5.0, 0, 0, 0, 0),
        (0.0, 0.0, 1, 0, 0, 1),
        (0.0, 0.0, 1, 0, 0, 0),
    ]


@pytest.mark.parametrize(
    "part, whole, level, rate",
    [(6, 10, "MEDIUM", 60.0), (61, 100, "HIGH", 61.0), (4, 10, "LOW", 40.0), (1, 3, "LOW", 33.33)],
)
def test_alert_limits_are_exclusive(spark, part, whole, level, rate):
    df = spark.createDataFrame([(part, whole)], "p BIGINT, w BIGINT")
    row = df.select(alert_level("p", "w"), percentage("p", "w")).first()
    assert tuple(row) == (level, rate)
