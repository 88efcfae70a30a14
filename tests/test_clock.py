import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventloom.functions import clock

AS_OF = "2024-01-31 00:00:00"


def value(spark, column, **cols):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()])
    return df.select(column.alias("v")).first().v


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


def test_as_of_forms():
    want = dt.datetime(2024, 1, 31)
    assert clock.resolve_as_of(AS_OF) == want
    assert clock.resolve_as_of(want) == want
    assert clock.resolve_as_of("2024-01-30T15:00:00+00:00") == want
    assert clock.resolve_as_of().tzinfo is None


def test_utc_and_back():
    wall = dt.datetime(2024, 1, 31, 3)
    assert clock.to_utc(wall) == dt.datetime(2024, 1, 30, 18)
    assert clock.from_utc(clock.to_utc(wall)) == wall


def test_presets_and_cap():
    assert clock.period_days("All") == 365
    assert clock.cap_days(365) == 90
    assert clock.cap_days(7) == 7
    assert clock.cap_days(365, 400) == 365 and clock.cap_days(365, None) == 365


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Europe/Berlin"])
def test_the_session_zone_decides_nothing(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for text, want in {
            "2024-11-03T06:30:00+00:00": "2024-11-03 15:30:00", "2024-11-03T06:30:00": "2024-11-03 15:30:00",
            "2024-11-03 06:30:00.25Z": "2024-11-03 15:30:00.25", "2024-03-10": "2024-03-10 09:00:00",
            "2024-03-10T02:30:00": "2024-03-10 11:30:00", "2024-03-31T02:30:00-05:00": "2024-03-31 16:30:00",
            "1969-12-31T23:59:59.5+00:00": "1970-01-01 08:59:59.5",
        }.items():
            got = value(spark, clock.event_time(F.col("x")).cast("string"), x=text)
            assert got == want, (zone, text)
        assert value(spark, clock.event_time(F.col("x")), x="soon") is None
        assert value(spark, clock.minutes_between(
            ts("2024-03-10 01:30:00"), ts("2024-03-10 03:30:00"))) == 120
        assert value(spark, clock.minutes_between(
            ts("2024-11-03 00:59:59"), ts("2024-11-03 02:00:00"))) == 61
        assert value(spark, clock.time_ago(
            ts("2024-03-10 01:30:00"), "2024-03-10 03:30:00")) == "2 hours"
        assert value(spark, clock.iso_utc(
            ts("2024-03-10 02:30:00.5"))) == "2024-03-10T02:30:00.500000+00:00"
        assert value(spark, clock.iso_utc(ts("2024-03-10 02:30:00"))) == "2024-03-10T02:30:00.000000+00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("text,want", [
    ("2024-01-01T00:00:00+00:00", dt.datetime(2024, 1, 1, 9)),
    ("2024-01-01T00:00:00.123456+00:00", dt.datetime(2024, 1, 1, 9, 0, 0, 123456)),
    ("2024-01-01T00:00:00Z", dt.datetime(2024, 1, 1, 9)),
    ("2024-01-01T09:00:00+09:00", dt.datetime(2024, 1, 1, 9)),
    ("soon", None),
    (None, None),
])
def test_event_time(spark, text, want):
    assert value(spark, clock.event_time(F.col("t").cast("string")), t=text) == want


def test_minutes_count_boundaries(spark):
    pairs = [("2024-01-01 00:59:59", "2024-01-01 01:01:00", 2),
             ("2024-01-01 00:00:00", "2024-01-01 00:00:59", 0),
             ("2024-01-01 00:00:59", "2024-01-01 00:01:00", 1)]
    for start, end, want in pairs:
        assert value(spark, clock.minutes_between(ts(start), ts(end))) == want


def test_calendar_parts(spark):
    sunday = "2024-01-07 12:00:00"
    assert value(spark, clock.day_of_week(ts(sunday))) == 0
    assert value(spark, clock.monday_first(F.lit(0))) == 6
    assert value(spark, clock.monday_first(F.lit(1))) == 0
    assert value(spark, clock.week_start(F.to_date(ts(sunday)))) == dt.date(2024, 1, 1)
    assert value(spark, clock.month_start(F.to_date(ts(sunday)))) == dt.date(2024, 1, 1)


@pytest.mark.parametrize("text,want", [
    ("2024-01-28 00:00:00", "3 days"),
    ("2024-01-30 23:59:59", "now"),
    ("2024-01-30 23:30:00", "30 minutes"),
    ("2024-01-30 20:00:00", "4 hours"),
    ("2024-01-30 00:00:00", "1 days"),
    ("2024-01-31 09:00:00", "15 hours"),  # after the clock: modulo one day
    (None, "-"),
])
def test_time_ago(spark, text, want):
    assert value(spark, clock.time_ago(F.col("t").cast("timestamp_ntz"), AS_OF), t=text) == want


def test_periods(spark):
    days = spark.sql("SELECT explode(sequence(date'2024-01-10', date'2024-02-01')) AS summary_date")
    current = [r[0] for r in clock.current_dates(days, 7, AS_OF).collect()]
    assert min(current) == dt.date(2024, 1, 24) and max(current) == dt.date(2024, 2, 1)
    previous = [r[0] for r in clock.previous_period(days, 7, AS_OF).collect()]
    assert min(previous) == dt.date(2024, 1, 17) and max(previous) == dt.date(2024, 1, 23)


def test_event_period_rolls_with_the_clock(spark):
    df = spark.createDataFrame(
        [("2024-01-24 11:59:59",), ("2024-01-24 12:00:00",), ("2024-02-09 00:00:00",)], "t string"
    ).select(F.col("t").cast("timestamp_ntz").alias("event_timestamp"),
             F.to_date("t").alias("event_date"))
    assert clock.current_events(df, 7, "2024-01-31 12:00:00").count() == 2
