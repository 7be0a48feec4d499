from datetime import UTC, datetime
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from brezza.operators.timestamps import clock_offsets, normalise_timestamps

FEEDS = [("rome", "Europe/Rome", "dmy"), ("us", "+01:00", "mdy"), ("none", None, None), ("odd", "Mars/Olympus", "dmy"), ("rome", "Europe/Rome", "dmy"), ("ams", "Europe/Amsterdam", "dmy"), ("ny", "America/New_York", "mdy")]


def us(*parts, zone=UTC):
    return int(datetime(*parts, tzinfo=zone).timestamp() * 1_000_000)


CASES = [
    ("2024-03-05T10:00:00+01:00", "rome", us(2024, 3, 5, 9), "ok"),
    ("2024-03-05T10:00:00.1234567Z", "rome", us(2024, 3, 5, 10, 0, 0, 123456), "ok"),
    ("  2024-03-05  10:00 -0530 ", "rome", us(2024, 3, 5, 15, 30), "ok"),
    ("2024-07-05 10:00:00", "rome", us(2024, 7, 5, 8), "ok"),
    ("2024-03-31 02:30:00", "rome", None, "nonexistent"),
    ("2024-10-27 02:30:00", "rome", None, "ambiguous"),
    ("2024-10-27 03:00:00", "rome", us(2024, 10, 27, 2), "ok"),
    ("2024-10-27 02:30:00 CEST", "rome", us(2024, 10, 27, 0, 30), "ok"),
    ("05/03/2024 10:00", "rome", us(2024, 3, 5, 9), "ok"),
    ("05/03/2024 10:00", "us", us(2024, 5, 3, 9), "ok"),
    ("05/03/2024 10:00", "none", None, "not_a_time"),
    ("2024-03-05 10:00", "none", None, "no_clock"),
    ("2024-03-05 10:00", "odd", None, "no_clock"),
    ("2024-03-05 10:00", None, None, "no_clock"),
    ("2024-03-05 10:00 XYZ", "rome", None, "not_a_time"),
    ("31/12/2024 24", "rome", us(2024, 12, 31, 23), "ok"),
    ("31/12/2024 24:30", "rome", None, "not_a_time"),
    ("31/12/2024 25:00", "rome", None, "not_a_time"),
    ("30/02/2024 10:00", "rome", None, "not_a_time"),
    ("29/02/2024 10:00", "rome", us(2024, 2, 29, 9), "ok"),
    ("0000-00-00T00:00:00", "rome", None, "not_a_time"),
    ("01.02.24 10:00", "rome", us(2024, 2, 1, 9), "ok"),
    ("07-01-2025 18.16", "rome", us(2025, 1, 7, 17, 16), "ok"),
    ("10 ago 2024 09:00", "rome", us(2024, 8, 10, 7), "ok"),
    ("1 set 2024 09:00", "rome", us(2024, 9, 1, 7), "ok"),
    ("3 juin 2024 09:00", "rome", us(2024, 6, 3, 7), "ok"),
    ("3 juillet 2024 09:00", "rome", us(2024, 7, 3, 7), "ok"),
    ("Fri, 01 Aug 2025 04:00:00 GMT", "us", us(2025, 8, 1, 4), "ok"),
    ("10 Apr 2024, 03:00:00", "us", us(2024, 4, 10, 2), "ok"),
    ("12/28/2025 12:30:00 AM", "us", us(2025, 12, 27, 23, 30), "ok"),
    ("12/28/2025 12:30:00 PM", "us", us(2025, 12, 28, 11, 30), "ok"),
    ("12/28/2025 13:30:00 PM", "us", None, "not_a_time"),
    ("20240101T040000+0100", "us", us(2024, 1, 1, 3), "ok"),
    ("1704085200000", "us", us(2024, 1, 1, 5), "ok"),
    ("1704085200", "us", us(2024, 1, 1, 5), "ok"),
    # Offsets with seconds, and years before and after the table.
    ("1920-06-15 12:00:00", "ams", us(1920, 6, 15, 12, zone=ZoneInfo("Europe/Amsterdam")), "ok"),
    ("1930-01-15 12:00:00", "ams", us(1930, 1, 15, 12, zone=ZoneInfo("Europe/Amsterdam")), "ok"),
    ("1700-06-15 12:00:00", "ny", us(1700, 6, 15, 12, zone=ZoneInfo("America/New_York")), "ok"),
    ("2345-06-15 12:00:00", "rome", us(2345, 6, 15, 10), "ok"),
    ("2345-01-15 12:00:00", "rome", us(2345, 1, 15, 11), "ok"),
    ("2400-03-26 02:30:00", "rome", None, "nonexistent"),
    ("9999-07-01 00:00:00", "rome", us(9999, 6, 30, 22), "ok"),
    # Other notations.
    ("2024/01/05 10:00", "rome", us(2024, 1, 5, 9), "ok"),
    ("2024.01.05 10:00:30", "rome", us(2024, 1, 5, 9, 0, 30), "ok"),
    ("Jan 5, 2024 10:00", "rome", us(2024, 1, 5, 9), "ok"),
    ("January 5 2024 10:00 PM", "rome", us(2024, 1, 5, 21), "ok"),
    ("Fri, Jan 5, 2024 10:00 p.m.", "rome", us(2024, 1, 5, 21), "ok"),
    ("5-Jan-2024 10:00", "rome", us(2024, 1, 5, 9), "ok"),
    ("5. Januar 2024 10:00", "rome", us(2024, 1, 5, 9), "ok"),
    ("2024-01-05T10:00[Europe/Rome]", "ny", us(2024, 1, 5, 9), "ok"),
    ("2024-01-05T10:00+05:00[Europe/Rome]", "ny", us(2024, 1, 5, 5), "ok"),
    ("2024-01-05T10:00[Mars/Olympus]", "rome", None, "no_clock"),
    ("20240105100000", "rome", us(2024, 1, 5, 9), "ok"),
    ("202401051000", "rome", us(2024, 1, 5, 9), "ok"),
    ("20240105T100000,5Z", "rome", us(2024, 1, 5, 10, 0, 0, 500000), "ok"),
    ("2024-W01-5T10:00", "rome", us(2024, 1, 5, 9), "ok"),
    ("2020-W53-7T10:00Z", "rome", us(2021, 1, 3, 10), "ok"),
    ("2021-W53-1T10:00Z", "rome", None, "not_a_time"),
    ("2024-005T10:00", "rome", us(2024, 1, 5, 9), "ok"),
    ("2024-366T10:00Z", "rome", us(2024, 12, 31, 10), "ok"),
    ("2023-366T10:00Z", "rome", None, "not_a_time"),
    ("1704448800.25", "rome", us(2024, 1, 5, 10, 0, 0, 250000), "ok"),
    ("-1704448800", "rome", -1704448800000000, "ok"),
    ("-170444880.5", "rome", -170444880500000, "ok"),
    ("170444880", "rome", 170444880000000, "ok"),
    ("1704448800000000000", "rome", us(2024, 1, 5, 10), "ok"),
    ("1704448800000000", "rome", us(2024, 1, 5, 10), "ok"),
    ("2024-01-05", "rome", None, "not_a_time"),
    ("20240105", "rome", None, "not_a_time"),
    ("12345", "rome", None, "not_a_time"),
    ("ieri", "us", None, "not_a_time"),
    ("", "us", None, "not_a_time"),
    (None, "us", None, "not_a_time"),
    ("x" * 100_000, "us", None, "not_a_time"),
]


@pytest.fixture(scope="module")
def feeds(spark):
    return spark.createDataFrame(FEEDS, "feed_id string, clock string, date_order string")


def test_notations(spark, feeds):
    df = spark.createDataFrame([(k, t, f) for k, (t, f, _, _) in enumerate(CASES)], "stretches int, t string, feed_id string")
    got = {r.stretches: (r.utc_us, r.status) for r in normalise_timestamps(df, "t", "feed_id", feeds, ["stretches", "feed_id"]).collect()}
    assert len(got) == len(CASES)
    for k, (text, feed, wanted, status) in enumerate(CASES):
        assert got[k] == (wanted, status), (text, feed)


@pytest.mark.parametrize("zone", ["Europe/Rome", "Europe/London", "America/New_York", "Australia/Lord_Howe", "UTC"])
def test_offsets_are_those_of_the_zone(zone):
    stretches = clock_offsets(zone)
    for before, after in zip(stretches, stretches[1:], strict=False):
        assert before[1] == after[0]
    for year in range(1990, 2030):
        for month in range(1, 13):
            moment = datetime(year, month, 15, 12, tzinfo=UTC)
            at = int(moment.timestamp()) * 1_000_000
            (offset,) = [m for a, b, m in stretches if a <= at < b]
            assert offset == moment.astimezone(ZoneInfo(zone)).utcoffset().total_seconds()


def test_every_hour_of_a_year_of_local_time(spark, feeds):
    """Against the zone's own rules: each local quarter hour exists once, twice or never."""
    import collections

    start = us(2024, 1, 1) // 1_000_000
    by_local = collections.defaultdict(list)
    for quarter in range(-8, 366 * 96 + 8):
        moment = datetime.fromtimestamp(start + quarter * 900, UTC)
        by_local[moment.astimezone(ZoneInfo("Europe/Rome")).strftime("%Y-%m-%d %H:%M:%S")].append(int(moment.timestamp()) * 1_000_000)
    texts = spark.range(366 * 96).select(F.date_format(F.timestamp_seconds(F.lit(start) + F.col("id") * 900), "yyyy-MM-dd HH:mm:ss").alias("t"), F.lit("rome").alias("feed_id"))
    got = {r.t: (r.utc_us, r.status) for r in normalise_timestamps(texts, "t", "feed_id", feeds, ["t"]).collect()}
    for text, found in got.items():
        instants = by_local.get(text, [])
        wanted = (instants[0], "ok") if len(instants) == 1 else (None, "ambiguous" if instants else "nonexistent")
        assert found == wanted, text


def test_empty(spark, feeds):
    empty = spark.createDataFrame([], "t string, feed_id string")
    assert normalise_timestamps(empty, "t", "feed_id", feeds, ["t"]).count() == 0
    one = spark.createDataFrame([("2024-01-01T00:00:00Z", "x"), ("2024-01-01T00:00:00", "x")], "t string, feed_id string")
    assert {r.status for r in normalise_timestamps(one, "t", "feed_id", feeds.limit(0), ["t"]).collect()} == {"ok", "no_clock"}
