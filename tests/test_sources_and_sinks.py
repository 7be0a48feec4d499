import json
import re
from datetime import UTC, date, datetime, timedelta

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from brezza import schemas, seeds
from brezza.config import ConfigError, DateWindow, EngineConfig, bootstrap_requests, legal_day, provisional_window, resolve_window
from brezza.errors import ExportTooLargeError, FormatError, MissingMartError, SchemaError, TransportError
from brezza.plans import pipeline, serving
from brezza.sinks import months
from brezza.sources import feeds, http
from brezza.streaming.feed import upsert_new_files
from tests.conftest import rows

HEADER = "COD_STAZ,ID_PARAM,DATA_INIZIO,DATA_FINE,VALORE,UM"


def archive(folder, lines, name="storico_2025/a.csv"):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    return str(path)


def test_archive_stamps(spark, tmp_path):
    path = archive(tmp_path, ["7000014,5,01/01/2025 00,02/01/2025 00,32,ug/m3", "7.000.014,8,31/12/2024 23,01/01/2025 00,6,ug/m3"])
    got = rows(feeds.read_archive(spark, [path], 1), "pollutant_id", F.col("measured_at").cast("string"), "value")
    assert got == [(5, "2024-12-31 23:00:00", 32.0), (8, "2024-12-31 23:00:00", 6.0)]
    (tmp_path / "bad.csv").write_text("COD_STAZ,ID_PARAM,DATA_INIZIO,DATA_FINE,UM,VALORE\n7000014,5,01/01/2025 00,02/01/2025 00,ug/m3,32\n")
    with pytest.raises(Exception, match="header"):
        feeds.read_archive(spark, [str(tmp_path / "bad.csv")], 1).collect()
    late = archive(tmp_path, ["7000014,8,01/01/2025 23,01/01/2025 24,6,"], "storico_2025/late.csv")
    assert rows(feeds.read_archive(spark, [late], 1), F.col("measured_at").cast("string"), "unit") == [("2025-01-01 23:00:00", None)]
    inside = feeds.read_archive(spark, [path], 1, DateWindow(date(2025, 1, 1), date(2025, 1, 1)))
    assert rows(inside, "pollutant_id") == [(5,)]


@pytest.mark.parametrize("line", ["7000014,5,2025-01-01,02/01/2025 00,3,ug/m3", "7000014,5,01/01/2025 00,02/01/2025 00,n.d.,ug/m3", "7000014,5,01/01/2025 00,01/01/2025 00,3,ug/m3", "x,5,01/01/2025 00,02/01/2025 00,3,ug/m3"])
def test_archive_errors_name_file_and_row(spark, tmp_path, line):
    path = archive(tmp_path, ["7000014,5,01/01/2025 00,02/01/2025 00,32,ug/m3", line])
    with pytest.raises(SparkRuntimeException, match="a.csv: [a-z]+ of row " + re.escape(line[:12])):
        feeds.read_archive(spark, [path], 1).collect()


def test_archive_files_by_year(spark, tmp_path):
    for name in ("storico_2024/b.csv", "storico_2025/a.csv", "storico_2025/c.csv.gz", "storico_2025/notes.txt", "other/x.csv", "storico_2026/z.csv"):
        archive(tmp_path, [], name)
    found = feeds.archive_files(spark, str(tmp_path), DateWindow(date(2024, 12, 31), date(2025, 2, 1)))
    assert [f.rsplit("/", 1)[-1] for f in found] == ["b.csv", "a.csv", "c.csv.gz"]


def page(*items):
    return json.dumps({"_items": [dict(zip(("_id", "station_id", "parameter_id", "reftime", "value", "parameter_unit", "validity"), i, strict=True)) for i in items], "_meta": {"total": len(items)}})


def parsed(spark, body, **more):
    stations = spark.createDataFrame([("2000", 7000014)], "archive_id string, id bigint")
    pollutants = spark.createDataFrame([("30", 8), ("31", 5)], "archive_id string, id bigint")
    return feeds.parse_measurement_pages(spark.createDataFrame([(body,)], "body string"), "body", stations, pollutants, [5], **more)


def test_measurement_pages(spark):
    body = page(("a", "2000", "30", "2026-09-16T00:00:00+01:00", 5.0, "µg/m³", "x"), ("b", "2000", "31", "2026-09-16T00:00:00+01:00", 11.8, "µg/m³", "x"), ("c", "2024", "99", "2026-09-16T00:00:00+01:00", 1.0, "u", "x"))
    got, unmapped = parsed(spark, body)
    assert rows(got, "pollutant_id", F.col("measured_at").cast("string"), "value") == [(5, "2026-09-14 23:00:00", 11.8), (8, "2026-09-16 00:00:00", 5.0)]
    assert rows(unmapped) == [("2024",)]
    got, _ = parsed(spark, body, window=DateWindow(date(2026, 9, 15), date(2026, 9, 15)))
    assert rows(got, "pollutant_id") == [(5,)]


@pytest.mark.parametrize("body", [page(("a", "2000", "99", "2026-09-16T00:00:00+01:00", 5.0, "u", "x")), page(("a", "2000", "30", "yesterday", 5.0, "u", "x")), "not json"])
def test_measurement_pages_fail_loudly(spark, body):
    got, _ = parsed(spark, body)
    with pytest.raises(SparkRuntimeException):
        got.collect()


def test_station_types(spark):
    item = {"_id": "2000224", "nome": "LM-PR", "sigla_provincia": "PR", "tipo_stazione": "Traffico", "zona": " Urbana ", "_updated": "Sat, 10 Oct 2026 05:50:33 GMT"}
    body = json.dumps({"_items": [item, item | {"_id": "2000225", "zona": ""}], "_meta": {"total": 2}})
    got = rows(feeds.parse_station_types(spark.createDataFrame([(body,)], "b string"), "b"))
    assert got == [(2000224, "LM-PR", "PR", "Urbana Traffico", "20261010"), (2000225, "LM-PR", "PR", "Traffico", "20261010")]
    short = json.dumps({"_items": [item], "_meta": {"total": 2}})
    with pytest.raises(SparkRuntimeException, match="incomplete"):
        feeds.parse_station_types(spark.createDataFrame([(short,)], "b string"), "b").collect()


def test_registry(spark, tmp_path):
    path = tmp_path / "stations.csv"
    path.write_text("Stazione,Cod_staz,COMUNE,INDIRIZZO,PROVINCIA,Altezza,Id_Param,PARAMETRO,UM,LON_GEO,LAT_GEO\nGIARDINI,7.000.014,BOLOGNA,VIALE B,BO,43,5,PM10,ug/m3,11.354,44.4827\n")
    (row,) = feeds.read_station_registry(spark, str(path)).collect()
    assert (row.station_id, row.altitude_m, row.longitude) == (7000014, 43.0, 11.354)


def weather(times=("2025-02-23T00:00", "2025-02-23T01:00"), **more):
    series = {"temperature_2m": [1.0, None], "precipitation": [0.0, None], "wind_speed_10m": [2.0, None], "wind_direction_10m": [90, None], "surface_pressure": [1000.0, None]}
    return {"latitude": 44.5, "longitude": 11.4, "utc_offset_seconds": 0, "hourly": {"time": list(times), **series}} | more


def test_weather(spark):
    def parse(answer, places):
        df = spark.createDataFrame([(json.dumps(answer), places)], "body string, asked array<struct<location_id: string, latitude: double, longitude: double>>")
        return feeds.parse_weather(df, "body", "asked")

    a, b = ("445_114", 44.48, 11.35), ("448_103", 44.79, 10.33)
    assert rows(parse(weather(), [a]), "location_id", "temperature_c", "grid_latitude") == [("445_114", 1.0, 44.5)]
    assert rows(parse([weather(), weather()], [a, b]), "location_id") == [("445_114",), ("448_103",)]
    for answer, places in [(weather(utc_offset_seconds=3600), [a]), (weather(), [a, b]), (weather(times=("2025-02-23T00:00",)), [a])]:
        with pytest.raises(SparkRuntimeException):
            parse(answer, places).collect()


def test_locations_and_chunks(spark):
    df = spark.createDataFrame([(44.4827, 11.3541), (44.4712, 11.3893), (44.7937, 10.3306), (None, 1.0), (float("nan"), 1.0)], "latitude double, longitude double")
    assert rows(feeds.weather_locations(df, 1), "location_id") == [("445_114",), ("448_103",)]
    assert [len(c) for c in feeds.chunks(list(range(23)))] == [10, 10, 3]
    assert feeds.measurement_filter(DateWindow(date(2026, 1, 1), date(2026, 1, 2)), ["30"])["reftime"]["$lte"] == "2026-01-03T00:00:00+01:00"


class Service:
    """Answers from memory; fails as told."""

    def __init__(self, *answers):
        self.answers, self.calls = list(answers), 0

    def __call__(self, url, params):
        self.calls += 1
        answer = self.answers.pop(0)
        if isinstance(answer, Exception):
            raise answer
        return answer


def test_retries():
    pauses = []
    service = Service(TransportError("busy", 429), TransportError("down", 503), TransportError("no answer"), b"ok")
    assert http.get(service, "u", {}, attempts=4, sleep=pauses.append) == "ok" and pauses == [1.0, 2.0, 4.0]
    service = Service(TransportError("no", 404), b"ok")
    with pytest.raises(TransportError):
        http.get(service, "u", {}, sleep=pauses.append)
    assert service.calls == 1
    with pytest.raises(TransportError):
        http.get(Service(*[TransportError("down", 500)] * 2), "u", {}, attempts=2, sleep=pauses.append)
    with pytest.raises(FormatError):
        http.get(Service(b"\xff"), "u", {})
    assert http.page_count('{"_meta": {"total": 4001}}', 2000) == 3
    with pytest.raises(FormatError):
        http.page_count("[]", 2000)


def test_bodies_that_do_not_parse_are_fetched_again():
    pauses = []
    service = Service(b"[1, 2", TransportError("down", 503), b"[1, 2]")
    assert http.get_parsed(service, "u", {}, http.parsed_json, sleep=pauses.append) == [1, 2] and service.calls == 3 and pauses == [1.0, 1.0]
    with pytest.raises(FormatError):
        http.get_parsed(Service(*[b"[1"] * 3), "u", {}, http.parsed_json, attempts=3, sleep=pauses.append)


class Pages(http.PagedJson):
    @classmethod
    def name(cls):
        return "test_pages"

    def transport(self):
        def answer(url, params):
            return json.dumps({"page": params["page"], "size": params["max_results"], "where": params["where"], "_meta": {"total": 5}}).encode()

        return answer


def test_paged_source(spark):
    spark.dataSource.register(Pages)
    got = spark.read.format("test_pages").option("url", "u").option("page_size", "2").option("param.where", "x").load()
    assert [r.page for r in got.orderBy("page").collect()] == [1, 2, 3]
    assert json.loads(got.where("page = 3").first().body)["where"] == "x"


def record(month, hour, value=1.0, station=7000014):
    return (station, 8, datetime(2026, month, 1, hour, tzinfo=UTC), value, "ug/m3", None, "r")


def upsert(spark, root, data, **more):
    return months.upsert_months(spark.createDataFrame(data, schemas.MEASUREMENTS.schema), root, schemas.MEASUREMENTS, **more)


def listing(root):
    return {str(p.relative_to(root)): p.read_bytes() for p in sorted(root.rglob("*.parquet"))}


def test_upsert_is_idempotent_and_by_month(spark, tmp_path):
    root = str(tmp_path)
    assert upsert(spark, root, [record(1, 1), record(1, 2), record(2, 1)]) == months.WriteReport(2, 3, 3, 0)
    assert sorted(p.parent.name for p in tmp_path.rglob("*.parquet")) == ["month=01", "month=02"]
    before = listing(tmp_path)
    assert upsert(spark, root, [record(1, 2), record(1, 1)]) == months.WriteReport(0, 2, 0, 0)
    assert listing(tmp_path) == before
    assert upsert(spark, root, [record(1, 2, 9.0), record(1, 3)]) == months.WriteReport(1, 3, 1, 1)
    stored = months.read_dataset(spark, root, schemas.MEASUREMENTS)
    assert rows(stored, "value") == [(1.0,), (1.0,), (1.0,), (9.0,)]
    assert {k for k in before if "month=02" in k} <= set(listing(tmp_path))
    assert not [p for p in tmp_path.rglob("*") if "temporary" in p.name or "staging" in p.name]


def test_upsert_does_not_depend_on_order_or_batches(spark, tmp_path):
    data = [record(m, h, float(h)) for m in (1, 2) for h in range(5)]
    upsert(spark, str(tmp_path / "a"), data)
    for one in (data[::-1][:4], data[:7]):
        upsert(spark, str(tmp_path / "b"), one)
    a, b = (sorted(v for v in listing(tmp_path / x).values()) for x in "ab")
    assert a == b


def test_last_of_a_batch_and_empty_batches(spark, tmp_path):
    data = [(*record(1, 1, 1.0), 1), (*record(1, 1, 5.0), 3), (*record(1, 1, 7.0), 2)]
    batch = spark.createDataFrame(data, StructType([*schemas.MEASUREMENTS.schema.fields, StructField("n", IntegerType())]))
    months.upsert_months(batch, str(tmp_path), schemas.MEASUREMENTS, "n")
    assert rows(months.read_dataset(spark, str(tmp_path), schemas.MEASUREMENTS), "value") == [(5.0,)]
    assert upsert(spark, str(tmp_path), []) == months.WriteReport()


def test_schema_is_checked(spark, tmp_path):
    spark.createDataFrame([(1, "2026", "01")], "station_id bigint, year string, month string").write.partitionBy("year", "month").parquet(str(tmp_path / "measurements"))
    with pytest.raises(SchemaError):
        months.read_dataset(spark, str(tmp_path), schemas.MEASUREMENTS)
    with pytest.raises(SchemaError):
        upsert(spark, str(tmp_path), [record(1, 1)])


def test_snapshots_replace_their_day(spark, tmp_path):
    def snapshot(*ids):
        return spark.createDataFrame([(i, "n", "p", "t", "b") for i in ids], "station_id bigint, station_name string, province string, type_label string, bulletin_id string")

    root = str(tmp_path)
    months.write_snapshot(snapshot(1, 2), root, schemas.STATION_TYPES, date(2026, 1, 1))
    months.write_snapshot(snapshot(3), root, schemas.STATION_TYPES, date(2026, 1, 2))
    assert months.write_snapshot(snapshot(2, 1, 2), root, schemas.STATION_TYPES, date(2026, 1, 1)) == 2
    assert rows(months.read_dataset(spark, root, schemas.STATION_TYPES), "station_id", F.col("extracted_on").cast("string")) == [(1, "2026-01-01"), (2, "2026-01-01"), (3, "2026-01-02")]


def test_ingest_writes_nothing_when_fetching_fails(spark, tmp_path):
    class Broken:
        def fetch(self, window):
            raise TransportError("down")

    with pytest.raises(TransportError):
        pipeline.ingest(Broken(), str(tmp_path), schemas.MEASUREMENTS, DateWindow(date(2026, 1, 1), date(2026, 1, 1)))
    assert not list(tmp_path.iterdir())


def test_stream_takes_new_files_and_ends(spark, tmp_path):
    incoming, reports = tmp_path / "in", []

    def drop(n, data):
        spark.createDataFrame(data, schemas.MEASUREMENTS.schema).write.mode("append").parquet(str(incoming))
        upsert_new_files(spark, str(incoming), str(tmp_path / "out"), schemas.MEASUREMENTS, str(tmp_path / "state"), lambda _, r: reports.append(r))

    drop(1, [record(1, 1), record(1, 2)])
    drop(2, [record(1, 2, 5.0), record(2, 1)])
    assert [r.rows_inserted for r in reports] == [2, 1] and reports[1].rows_updated == 1
    assert months.read_dataset(spark, str(tmp_path / "out"), schemas.MEASUREMENTS).count() == 3


def test_seeds(spark, tmp_path):
    assert seeds.air_quality_limits(spark).count() == 3
    path = tmp_path / "s.csv"
    path.write_text("pollutant_id,pollutant_code,pollutant_name,averaging_minutes,max_plausible_ugm3\n5,PM10,PM10,1440,\n")
    assert rows(seeds.read_seed(spark, str(path), schemas.POLLUTANTS_SCHEMA)) == [(5, "PM10", "PM10", 1440, None)]


def test_config_and_windows():
    assert EngineConfig.parse({}, {"BREZZA__LOOKBACK_DAYS": "7", "BREZZA_OTHER": "x", "OTHER": "y"}).lookback_days == 7
    for values, environment in [({"nope": 1}, {}), ({}, {"BREZZA__NOPE": "1"}), ({}, {"BREZZA__LOOKBACK_DAYS": "many"})]:
        with pytest.raises(ConfigError):
            EngineConfig.parse(values, environment)
    with pytest.raises(ConfigError):
        DateWindow(date(2026, 1, 2), date(2026, 1, 1))
    day = date(2026, 3, 10)
    assert DateWindow.ending_on(day, 0) == DateWindow(day, day) == resolve_window(None, None, day, 1)
    assert resolve_window(date(2026, 3, 1), None, day, 30).first == date(2026, 3, 1)
    assert provisional_window(day, 30, date(2026, 3, 5)) == DateWindow(date(2026, 3, 5), day)
    assert DateWindow(date(2025, 12, 1), day).within_year(2025) == DateWindow(date(2025, 12, 1), date(2025, 12, 31)) and DateWindow(day, day).within_year(2025) is None
    assert legal_day(datetime(2026, 1, 1, 23, tzinfo=UTC)) == date(2026, 1, 1)
    assert legal_day(datetime(2026, 1, 1, 23, 0, 1, tzinfo=UTC)) == date(2026, 1, 2)
    assert bootstrap_requests(False, False, day)[0][0] == "archive" and bootstrap_requests(True, False, day)[0][0] == "refresh" and not bootstrap_requests(True, True, day)


@pytest.fixture(scope="module")
def served(spark):
    d = date(2026, 1, 1)
    frames = {
        "mart_exceedances_yearly": spark.createDataFrame([(1, "B", "x", "PM10", "daily_mean", 2025, 3, 1.23456), (2, "A", "x", "PM10", "daily_mean", 2024, 1, float("inf"))], "station_id int, station_name string, municipality string, pollutant_code string, metric string, year bigint, exceedances bigint, max_value_ugm3 double"),
        "mart_pollutant_trend": spark.createDataFrame([("x", "PM10", 2025, 1.0)], "municipality string, pollutant_code string, year bigint, annual_mean_ugm3 double"),
        "mart_traffic_vs_background": spark.createDataFrame([("x", "NO2", d, 1.0)], "municipality string, pollutant_code string, month date, traffic_mean_ugm3 double"),
        "mart_weather_correlation": spark.createDataFrame([(1, "B", "winter", float("nan"))], "station_id int, station_name string, season string, corr_pm10_wind double"),
        "mart_data_completeness": spark.createDataFrame([(1, "B", "x", "PM10", d + timedelta(days=k), k != 3, 1.0 if k != 3 else 0.0) for k in range(40)], "station_id int, station_name string, municipality string, pollutant_code string, measurement_date date, is_complete boolean, completeness double"),
    }
    kinds = {"year": "bigint", "month": "date", "measurement_date": "date", "is_complete": "boolean"}

    def whole(mart, df):
        missing = [c for c in serving.COLUMNS[mart] if c not in df.columns]
        return df.select("*", *(F.lit(None).cast(kinds.get(c, "double")).alias(c) for c in missing), F.lit(7).alias("beside"))

    return serving.Marts(spark, {mart: whole(mart, df) for mart, df in frames.items()})


def test_accessors(served, spark):
    assert [r[0] for r in served.distinct("mart_exceedances_yearly", "station_name").collect()] == ["A", "B"]
    assert served.date_range("mart_data_completeness", "measurement_date") == (date(2026, 1, 1), date(2026, 2, 9))
    assert [r.station_name for r in served.exceedances("daily_mean").collect()] == ["A", "B"]
    assert served.exceedances("daily_mean", []).count() == 0
    assert served.exceedances("daily_mean").columns == serving.COLUMNS["mart_exceedances_yearly"]
    assert served.exceedances("daily_mean", ["A"], (2025, 2026)).count() == 0
    assert served.pollutant_trend("PM10", ["x"], (2025, 2025)).count() == 1
    assert served.traffic_vs_background("NO2", "x", (date(2026, 1, 1), date(2026, 1, 1))).count() == 1
    assert served.weather_correlation(None, ["winter"]).count() == 1
    assert served.completeness("B", ["PM10"], (date(2026, 1, 2), date(2026, 1, 4))).count() == 3
    for mart, column in [("users; drop", "x"), ("other", "x"), ("mart_pollutant_trend", "a b")]:
        with pytest.raises(ValueError):
            served.distinct(mart, column)
    with pytest.raises(MissingMartError):
        serving.Marts(spark).read("mart_nowhere")


def test_checks_of_the_data(served, spark):
    share = serving.recent_completeness(served.read("mart_data_completeness"), 30).first()
    assert (share.complete, share.total, share.share) == (30, 30, 1.0)
    assert serving.recent_completeness(served.read("mart_data_completeness").limit(0), 30).first().share == 0.0
    now = datetime(2026, 1, 3)
    assert serving.is_fresh(now - timedelta(hours=48), now, 48) and not serving.is_fresh(now - timedelta(hours=49), now, 48) and not serving.is_fresh(None, now, 48)
    stamps = spark.createDataFrame([(now - timedelta(hours=49),), (now - timedelta(hours=60),)], "t timestamp")
    assert rows(serving.freshness(stamps, "t", F.lit(now), 48), "age_hours", "passed") == [(49.0, False)]
    assert rows(serving.freshness(stamps, "t", F.lit(now), 49), "passed") == [(True,)]
    assert rows(serving.freshness(stamps.limit(0), "t", F.lit(now), 49), "newest", "passed") == [(None, False)]
    verdict = serving.completeness_verdict(served.read("mart_data_completeness"), 40, 0.98).first()
    assert (verdict.complete, verdict.total, verdict.passed) == (39, 40, False)


def test_missing_months(spark):
    loaded = spark.createDataFrame([(date(2026, 1, 1),), (date(2026, 1, 31),), (date(2026, 2, 1),), (date(2026, 3, 1),)], "day date")
    got = serving.missing_months(spark, date(2025, 12, 15), date(2026, 3, 10), loaded, 5)
    assert rows(got) == [(date(2025, 12, 15), date(2025, 12, 31)), (date(2026, 2, 1), date(2026, 2, 28))]
    assert serving.missing_months(spark, date(2026, 4, 1), date(2026, 3, 1), loaded, 5).count() == 0
    with pytest.raises(ConfigError):
        serving.missing_months(spark, date(2026, 1, 1), date(2026, 3, 1), loaded, 0)


def test_export(served, tmp_path):
    now = datetime(2026, 2, 10, tzinfo=UTC)
    meta = serving.export_marts(served, tmp_path, EngineConfig(), now, ["someone"])
    assert meta["schema_version"] == 1 and meta["period"] == {"from": "2026-01-01", "to": "2026-02-09"} and meta["files"]["exceedances.json"] == 2 and meta["credits"] == ["someone"]
    assert [r["max_value_ugm3"] for r in json.loads((tmp_path / "exceedances.json").read_text())] == [1.235, None]
    assert json.loads((tmp_path / "weather-correlation.json").read_text())[0]["corr_pm10_wind"] is None
    monthly = json.loads((tmp_path / "completeness-monthly.json").read_text())
    assert [(r["month"], r["days"], r["complete_days"]) for r in monthly] == [("2026-01-01", 31, 30), ("2026-02-01", 9, 9)]
    with pytest.raises(ExportTooLargeError):
        serving.export_marts(served, tmp_path / "b", EngineConfig(max_export_bytes=50), now)
    assert not (tmp_path / "b/exceedances.json").exists()
    assert list(json.loads((tmp_path / "pollutant-trend.json").read_text())[0]) == serving.COLUMNS["mart_pollutant_trend"]


def test_command_line(spark, tmp_path, capsys, monkeypatch):
    from brezza.__main__ import main

    archive(tmp_path / "csv", [f"7000014,5,{d:02d}/01/2025 00,{d + 1:02d}/01/2025 00,{40 + d},ug/m3" for d in range(1, 30)])
    root = str(tmp_path / "raw")
    assert main(["archive", "--csv", str(tmp_path / "csv"), "--root", root], spark) == 0
    assert "rows_inserted=29" in capsys.readouterr().out
    (tmp_path / "p.csv").write_text("pollutant_id,pollutant_code,pollutant_name,averaging_minutes,max_plausible_ugm3\n5,PM10,PM10,1440,1000\n")
    (tmp_path / "t.csv").write_text("station_id,station_type,area_type,source_label,bulletin_id\n7000014,traffic,,x,01\n")
    spark.sql("create database if not exists cli")
    spark.catalog.setCurrentDatabase("cli")
    try:
        main(["build", "--root", root, "--pollutants", str(tmp_path / "p.csv"), "--types", str(tmp_path / "t.csv")], spark)
        (row,) = spark.table("mart_exceedances_yearly").collect()
        assert (row.station_id, row.year, row.exceedances, row.valid_periods) == (7000014, 2025, 19, 29)
        main(["export", "--out", str(tmp_path / "json")], spark)
        assert json.loads((tmp_path / "json/meta.json").read_text())["files"]["exceedances.json"] == 1
        capsys.readouterr()
        main(["gaps", "--root", root, "--today", "2025-03-10"], spark)
        assert capsys.readouterr().out.split() == ["2025-01-29", "2025-01-31", "2025-02-01", "2025-02-28", "2025-03-01", "2025-03-10"]
    finally:
        spark.catalog.setCurrentDatabase("default")


@pytest.fixture
def service():
    """A local server of the three services; some of its first answers are cut short or fail."""
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer
    from urllib.parse import parse_qs, urlparse

    seen = []
    records = [(f"r{k}", "2000", "30", f"2026-06-{1 + k // 24:02d}T{k % 24:02d}:00:00+01:00", float(k), "ug/m3", None) for k in range(50)] + [("x", "9999", "30", "2026-06-01T00:00:00+01:00", 1.0, "ug/m3", None)]

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            asked = urlparse(self.path)
            query = {k: v[0] for k, v in parse_qs(asked.query).items()}
            seen.append((asked.path, query))
            status, body = 200, ""
            if asked.path == "/measurements":
                number, size = int(query["page"]), int(query["max_results"])
                body = page(*records[(number - 1) * size : number * size]).replace(f'"total": {len(records[(number - 1) * size : number * size])}', f'"total": {len(records)}')
                if number == 2 and sum(1 for p, q in seen if q.get("page") == "2") == 1:
                    body = body[:40]
                if number == 3 and sum(1 for p, q in seen if q.get("page") == "3") == 1:
                    status = 503
            elif asked.path == "/types":
                body = json.dumps({"_items": [{"_id": "7.000.014", "nome": "A", "sigla_provincia": "BO", "tipo_stazione": "Traffico", "zona": "Urbana", "_updated": "Mon, 02 Mar 2026 10:00:00 GMT"}], "_meta": {"total": 1}})
            else:
                body = json.dumps([weather(times=("2026-06-01T00:00", "2026-06-01T01:00")) for _ in query["latitude"].split(",")])
            self.send_response(status)
            self.end_headers()
            self.wfile.write(body.encode())

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}", seen
    server.shutdown()


def test_run_weather_and_incremental_build(spark, tmp_path, capsys, service):
    from brezza.__main__ import main

    url, seen = service
    (tmp_path / "s.csv").write_text("archive_id,id\n2000,7000014\n")
    (tmp_path / "p.csv").write_text("pollutant_id,averaging_minutes,archive_parameter_id\n8,60,30\n5,1440,31\n")
    (tmp_path / "r.csv").write_text("Cod_staz,Stazione,COMUNE,PROVINCIA,INDIRIZZO,Altezza,LON_GEO,LAT_GEO,Id_Param,PARAMETRO,UM\n7000014,A,Bologna,BO,Via X,54,11.35,44.48,8,NO2,ug/m3\n")
    root = str(tmp_path / "raw")
    window = ["--from", "2026-06-01", "--to", "2026-06-03"]
    main(["run", "--root", root, "--measurements-url", f"{url}/measurements", "--types-url", f"{url}/types", "--registry", str(tmp_path / "r.csv"), "--stations", str(tmp_path / "s.csv"), "--pollutants", str(tmp_path / "p.csv"), "--page-size", "20", *window], spark)
    said = capsys.readouterr().out
    assert "rows_inserted=50" in said and "no id for station 9999" in said and "sensors: 1" in said and "station types: 1" in said
    assert json.loads(seen[0][1]["where"])["parameter_id"] == {"$in": ["30", "31"]}
    main(["weather", "--root", root, "--weather-url", f"{url}/weather", *window], spark)
    assert "rows_inserted=1" in capsys.readouterr().out  # an hour without values is left out
    assert seen[-1][1]["start_date"] == "2026-06-01" and seen[-1][1]["timezone"] == "GMT"

    (tmp_path / "all.csv").write_text("pollutant_id,pollutant_code,pollutant_name,averaging_minutes,max_plausible_ugm3\n8,NO2,NO2,60,1000\n")
    (tmp_path / "t.csv").write_text("station_id,station_type,area_type,source_label,bulletin_id\n")
    build = ["build", "--root", root, "--pollutants", str(tmp_path / "all.csv"), "--types", str(tmp_path / "t.csv")]
    spark.sql("create database if not exists steps")
    spark.catalog.setCurrentDatabase("steps")
    try:
        main(build, spark)
        facts = spark.table("int_measurements_deduplicated")
        assert facts.count() == 50 and {r.part for r in facts.select("part").distinct().collect()} == {"2026-05", "2026-06"} - ({"2026-05"} if facts.where("part = '2026-05'").count() == 0 else set())
        # Revisions: one within the last thirty days, one before them, and one new row.
        t = datetime(2026, 6, 1, 5, tzinfo=UTC)
        old = t - timedelta(days=90)
        upsert(spark, root, [(7000014, 8, t, 500.0, "ug/m3", None, "r"), (7000014, 8, old, 1.0, "ug/m3", None, "r"), (7000014, 8, t + timedelta(days=20), 7.0, "ug/m3", None, "r")])

        def values():
            spark.catalog.refreshTable("int_measurements_deduplicated")
            return {r.measured_at_utc: r.concentration_ugm3 for r in spark.table("int_measurements_deduplicated").collect()}

        main(build, spark)
        got = values()
        assert got[t.replace(tzinfo=None)] == 500.0 and old.replace(tzinfo=None) not in got and len(got) == 51
        main([*build, "--reprocess-from", "2026-01-01"], spark)
        got = values()
        assert got[old.replace(tzinfo=None)] == 1.0 and len(got) == 52
        main([*build, "--full"], spark)
        assert values() == got
    finally:
        spark.catalog.setCurrentDatabase("default")
