from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from brezza.operators import regular_grid as G
from tests.conftest import rows

T0 = datetime(2024, 1, 1)


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def test_counter_with_reset_and_gap(spark):
    readings = [("a", at(0), 10.0), ("a", at(30), 16.0), ("a", at(90), 22.0), ("a", at(90), 21.0), ("a", at(120), 3.0), ("a", at(600), 9.0), ("a", at(630), None), ("a", None, 1.0), (None, at(5), 1.0)]
    df = spark.createDataFrame(readings, "k string, ts timestamp_ntz, c double")
    intervals = G.counter_intervals(df, ["k"], "ts", "c", F.lit(60), 240)
    assert rows(intervals.select((F.col("to_us") - F.col("from_us")) / 60e6, "increment", "is_reset")) == sorted([(30.0, 6.0, False), (60.0, 6.0, False), (30.0, 3.0, True)], key=str)
    cells = {r.cell - 473352: (r.amount, r.covered_minutes) for r in G.spread_on_grid(intervals, ["k"]).collect()}
    assert cells == {0: (pytest.approx(9.0), 60.0), 1: (pytest.approx(6.0), 60.0)}


def test_increments_add_up_and_long_gaps_are_marked(spark):
    readings = [("a", at(7 * k), float(k)) for k in range(200)] + [("a", at(100000 + 7 * k), float(200 + k)) for k in range(200)]
    df = spark.createDataFrame(readings, "k string, ts timestamp_ntz, c double")
    intervals = G.counter_intervals(df, ["k"], "ts", "c", F.lit(60), 60)
    series = G.regular_series(intervals, ["k"]).orderBy("slot").collect()
    assert sum(r.amount or 0 for r in series) == pytest.approx(398.0)
    slots = [r.slot for r in series]
    assert all(b - a == timedelta(hours=1) for a, b in zip(slots, slots[1:], strict=False))
    empty = [r for r in series if r.is_empty]
    assert all(r.amount is None and r.intervals == 0 for r in empty)
    assert {r.slot for r in empty} == {at(60 * h) for h in range(24, 1666)}


def test_instants_fill_their_cell(spark):
    readings = [("a", at(5), 1.0), ("a", at(6), 2.0), ("a", at(185), 3.0), ("b", at(0), 1.0), ("a", at(130), None)]
    df = spark.createDataFrame(readings, "k string, ts timestamp_ntz, v double")
    intervals = G.instant_intervals(df, ["k"], "ts", F.col("v"), F.lit(60))
    series = G.regular_series(intervals, ["k"])
    assert rows(series.where("k = 'a'"), "slot", "amount", "is_empty") == sorted([(at(0), 3.0, False), (at(60), None, True), (at(120), None, True), (at(180), 3.0, False)], key=str)
    assert series.where("k = 'b'").count() == 1


def test_local_days(spark):
    df = spark.createDataFrame([("a", datetime(2024, 1, 1, 22, 59), 1.0), ("a", datetime(2024, 1, 3, 23, 0), 1.0)], "k string, ts timestamp_ntz, v double")
    intervals = G.instant_intervals(df, ["k"], "ts", F.col("v"), F.lit(1440))
    series = rows(G.regular_series(intervals, ["k"], 60), "slot", "is_empty")
    assert series == [(datetime(2023, 12, 31, 23), False), (datetime(2024, 1, 1, 23), True), (datetime(2024, 1, 2, 23), True), (datetime(2024, 1, 3, 23), False)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "k string, ts timestamp_ntz, v double")
    assert G.regular_series(G.instant_intervals(df, ["k"], "ts", F.col("v"), F.lit(60)), ["k"]).count() == 0
    assert G.regular_series(G.counter_intervals(df, ["k"], "ts", "v", F.lit(60), 60), ["k"]).count() == 0


def test_long_gaps_and_intervals_are_cut_into_blocks(spark):
    """No row holds more cells than a block, however far apart readings are."""
    df = spark.createDataFrame([(1, 0, 0, 1.0), (1, 2_000_000, 2_000_000, 1.0)], "s int, a bigint, b bigint, increment double")
    points = df.select("s", F.lit(1).alias("minutes"), (F.col("a") * 60_000_000).alias("from_us"), (F.col("b") * 60_000_000).alias("to_us"), "increment")
    empty = G.uncovered_cells(G.spread_on_grid(points, ["s"]), ["s"])
    assert empty.agg(F.count("cell"), F.min("cell"), F.max("cell"), F.countDistinct("cell")).first() == (1_999_999, 1, 1_999_999, 1_999_999)
    span = spark.createDataFrame([(1, 1, 30 * 60_000_000, 1_000_030 * 60_000_000, 5.0)], "s int, minutes int, from_us bigint, to_us bigint, increment double")
    cells = G.spread_on_grid(span, ["s"])
    assert cells.agg(F.count("cell"), F.round(F.sum("amount"), 6), F.sum("covered_minutes")).first() == (1_000_000, 5.0, 1_000_000.0)
    assert G.uncovered_cells(cells, ["s"]).count() == 0
