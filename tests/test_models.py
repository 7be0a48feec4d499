from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from brezza import seeds
from brezza.config import EngineConfig
from brezza.operators import quality, relational
from brezza.plans import marts, models, pipeline
from tests.conftest import rows

CONFIG = EngineConfig()
FACT = "station_id int, pollutant_id int, pollutant_code string, averaging_minutes int, measured_at_utc timestamp_ntz, measurement_date date, concentration_ugm3 double, is_valid boolean"
DAILY = "station_id int, pollutant_id int, pollutant_code string, measurement_date date, daily_mean_ugm3 double, measurements bigint, valid_measurements bigint, expected_measurements int, is_valid_day boolean"


def test_rolling_windows_on_a_gap(spark):
    day = datetime(2026, 6, 1)
    data = [(1, 7, "O3", 60, day + timedelta(hours=h), day.date(), -5.0 if h == 2 else 16.0, h != 2) for h in range(8)]
    got = models.rolling_means(spark.createDataFrame(data, FACT), CONFIG).orderBy("measured_at_utc").collect()
    assert [r.measured_at_utc.hour for r in got] == list(range(24))
    assert [r.valid_hours_in_window for r in got] == [1, 2, 2, 3, 4, 5, 6, 7, 6, 5, 5, 4, 3, 2, 1] + [0] * 9
    assert all(r.rolling_8h_mean_ugm3 == (16.0 if r.valid_hours_in_window else None) for r in got)
    assert [r.measured_at_utc.hour for r in got if r.is_valid_window] == [6, 7, 8]


def test_rolling_windows_reach_over_months(spark):
    first = datetime(2026, 1, 31, 12)
    data = [(1, 7, "O3", 60, first + timedelta(hours=h), (first + timedelta(hours=h)).date(), float(h), True) for h in range(30)]
    got = {r.measured_at_utc: r for r in models.rolling_means(spark.createDataFrame(data, FACT), CONFIG).collect()}
    assert got[datetime(2026, 2, 1, 2)].rolling_8h_mean_ugm3 == pytest.approx(sum(range(7, 15)) / 8)
    assert len(got) == 48


def test_values_are_rounded_before_they_are_compared(spark):
    means = [(50.0, True), (50.4, True), (50.6, True), (62.7, True), (90.0, False)]
    daily = spark.createDataFrame([(1, 5, "PM10", date(2026, 1, k + 1), m, 1, 1, 1, ok) for k, (m, ok) in enumerate(means)], DAILY)
    facts = spark.createDataFrame([], FACT)
    rolling = spark.createDataFrame([], "station_id int, pollutant_id int, measurement_date date, rolling_8h_mean_ugm3 double, is_valid_window boolean")
    stations = spark.createDataFrame([(1, "a", "b")], "station_id int, station_name string, municipality string")
    (row,) = marts.yearly_exceedances(daily, facts, rolling, seeds.air_quality_limits(spark), stations, CONFIG).collect()
    assert (row.exceedances, row.valid_periods, row.max_value_ugm3) == (2, 4, 62.7)
    assert row.year_coverage == pytest.approx(4 / 365) and row.pollutant_id == 5


def test_limits_are_by_id(spark):
    """Two ids of one code are two series; an id without a limit has none."""
    daily = spark.createDataFrame([(1, p, "PM10", date(2026, 1, k + 1), 60.0, 1, 1, 1, True) for p in (5, 105, 205) for k in range(3)], DAILY)
    pollutants = spark.createDataFrame([(5, "PM10"), (105, "PM10"), (205, "other")], "pollutant_id int, pollutant_code string")
    rolling = spark.createDataFrame([], "station_id int, pollutant_id int, measurement_date date, rolling_8h_mean_ugm3 double, is_valid_window boolean")
    stations = spark.createDataFrame([(1, "a", "b")], "station_id int, station_name string, municipality string")
    limits = seeds.air_quality_limits(spark, pollutants)
    assert rows(marts.yearly_exceedances(daily, spark.createDataFrame([], FACT), rolling, limits, stations, CONFIG), "pollutant_id", "exceedances") == [(105, 3), (5, 3)]


def test_completeness_is_over_loaded_days(spark):
    days = {1: [1, 3, 10], 2: [1, 2, 10]}
    daily = spark.createDataFrame([(s, 5, "PM10", date(2026, 1, d), 1.0, 1, 1, 1, True) for s, own in days.items() for d in own], DAILY)
    stations = spark.createDataFrame([(1, "a", "b")], "station_id int, station_name string, municipality string")
    got = {(r.station_id, r.measurement_date.day): r.completeness for r in marts.data_completeness(daily, stations).collect()}
    assert set(got) == {(s, d) for s in (1, 2) for d in (1, 2, 3, 10)}
    assert {k for k, v in got.items() if v == 0} == {(1, 2), (2, 3)}


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (1, 2.0, 2.0), (2, 1.0, 1.0), (2, 2.0, 3.0), (2, None, 9.0), (3, 1.0, 1.0)], "g int, x double, y double")
    from brezza.functions.quality_flags import correlation

    got = dict(rows(df.groupBy("g").agg(correlation(F.col("x"), F.col("y")).alias("c"))))
    assert got[1] is None and got[2] == pytest.approx(1.0) and got[3] is None


RAW = "station_id bigint, pollutant_id bigint, measured_at timestamp, value double, unit string, validation_flag string, raw_reftime string"
POLLUTANTS = "pollutant_id int, pollutant_code string, averaging_minutes int, max_plausible_ugm3 double"


def raw(spark, values):
    return models.stage_measurements(spark.createDataFrame([(1, p, t, v, "ug/m3", None, "") for p, t, v in values], RAW))


def test_fact_flags_periods_and_precedence(spark):
    pollutants = spark.createDataFrame([(8, "NO2", 60, 1000.0), (5, "PM10", 1440, None)], POLLUTANTS)
    new_year = datetime(2025, 12, 31, 23)
    archive = raw(spark, [(8, new_year, 5.0), (5, new_year, 7.0)])
    recent = raw(spark, [(8, new_year, 6.0), (8, new_year + timedelta(hours=1), -1.0), (8, new_year + timedelta(hours=2), 2000.0), (8, new_year + timedelta(hours=3), 0.0), (9, new_year, 1.0)])
    fact = models.deduplicated_measurements({"archive": archive, "near_real_time": recent}, pollutants, CONFIG)
    got = {(r.pollutant_id, r.measured_at_utc): r for r in fact.collect()}
    assert len(got) == 6
    first = got[8, new_year]
    assert (first.concentration_ugm3, first.source_name, first.measurement_date) == (5.0, "archive", date(2025, 12, 31))
    assert got[5, new_year].measurement_date == date(2026, 1, 1)
    assert [got[8, new_year + timedelta(hours=h)].is_valid for h in (1, 2, 3)] == [False, False, True]
    assert got[8, new_year + timedelta(hours=3)].is_zero and got[8, new_year + timedelta(hours=2)].is_implausible
    assert got[9, new_year].pollutant_code is None
    assert quality.flagged_but_valid(fact).count() == 0


def test_incremental_run(spark):
    pollutants = spark.createDataFrame([(8, "NO2", 60, 1000.0)], POLLUTANTS)
    t = datetime(2026, 3, 1)
    loaded = models.deduplicated_measurements({"archive": raw(spark, [(8, t - timedelta(days=100), 1.0)]), "near_real_time": raw(spark, [(8, t, 1.0), (8, t - timedelta(days=60), 1.0)])}, pollutants, CONFIG)
    archive = raw(spark, [(8, t - timedelta(days=100), 2.0), (8, t - timedelta(days=90), 3.0)])
    recent = raw(spark, [(8, t, 9.0), (8, t - timedelta(days=60), 9.0), (8, t + timedelta(days=1), 4.0)])
    fact = models.deduplicated_measurements({"archive": archive, "near_real_time": recent}, pollutants, CONFIG, loaded)
    got = {(r.measured_at_utc - t).days: r.concentration_ugm3 for r in fact.collect()}
    assert got == {-100: 1.0, -90: 3.0, -60: 1.0, 0: 9.0, 1: 4.0}
    again = models.deduplicated_measurements({"near_real_time": recent}, pollutants, CONFIG, loaded, F.lit("2026-01-01").cast("timestamp_ntz"))
    assert {(r.measured_at_utc - t).days: r.concentration_ugm3 for r in again.collect()}[-60] == 9.0
    empty = models.deduplicated_measurements({"near_real_time": recent}, pollutants, CONFIG, loaded.limit(0))
    assert empty.count() == 3


def test_station_types_fall_back(spark):
    label = [(1, date(2026, 1, 1), "Urbana Traffico"), (1, date(2026, 2, 1), "Suburbana"), (2, date(2026, 1, 1), ""), (3, date(2026, 1, 1), "Rurale"), (4, date(2026, 1, 1), "Fondo Remoto")]
    data = spark.createDataFrame([(s, f"S{s}", "BO", text, "x", d) for s, d, text in label], "station_id int, station_name string, province string, type_label string, bulletin_id string, extracted_on date")
    reference = spark.createDataFrame([(2, "traffic", "urban"), (3, "other", None)], "station_id int, station_type string, area_type string")
    got = rows(models.current_station_types(models.stage_station_types(data), reference), "station_id", "station_type", "area_type", "station_type_source")
    assert got == [(1, "traffic", "suburban", "earlier_snapshot"), (2, "traffic", "urban", "reference"), (3, "other", "rural", "unknown"), (4, "background", "remote", "latest_snapshot")]


def test_upsert_relation_counts_changes(spark):
    stored = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    incoming = spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, None, 1), (4, "e", 1)], "k int, v string, n int")
    assert rows(relational.upsert_relation(stored, incoming, ["k"], "n")) == [(1, "a", "kept"), (2, "d", "updated"), (3, None, "unchanged"), (4, "e", "inserted")]


def test_differences_count_repeats(spark):
    a = spark.createDataFrame([(1, 1.00000001), (1, 1.0), (2, 2.0)], "k int, v double")
    b = spark.createDataFrame([(1.0, 1), (3.0, 3)], "v double, k int")
    assert rows(relational.symmetric_difference(a, b)) == [(1, 1.0, "left"), (2, 2.0, "left"), (3, 3.0, "right")]


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "z")], "k int, v string")
    outcomes = quality.run_checks(
        [
            quality.Check("unique", lambda: quality.duplicates(df, ["k"])),
            quality.Check("there", lambda: quality.nulls(df, "v"), quality.Severity.WARN),
            quality.Check("known", lambda: quality.unaccepted(df, "v", ["a"])),
            quality.Check("fine", lambda: quality.violations(df, F.col("k") > 0)),
            quality.Check("kinds", lambda: quality.missing_kinds(df, "v", ["a", "b"])),
        ]
    )
    assert [(o.name, o.failures, o.passed) for o in outcomes] == [("unique", 1, False), ("there", 1, False), ("known", 1, False), ("fine", 0, True), ("kinds", 1, False)]


def test_build_on_an_empty_raw_layer(spark, tmp_path):
    pollutants = spark.createDataFrame([], POLLUTANTS)
    reference = spark.createDataFrame([], "station_id int, station_type string, area_type string")
    built = pipeline.build(spark, str(tmp_path), CONFIG, pollutants, seeds.air_quality_limits(spark), reference)
    assert len(built) == 12 and all(df.count() == 0 for df in built.values())
