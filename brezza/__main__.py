"""Command line: ``python -m brezza run | archive | weather | build | export | gaps``."""

from __future__ import annotations

import argparse
import os
from datetime import UTC, date, datetime
from pathlib import Path

from pyspark.sql import SparkSession

from brezza import schemas, seeds
from brezza.config import DateWindow, EngineConfig, local_today, resolve_window
from brezza.plans import models, pipeline, serving
from brezza.session import prepare
from brezza.sinks.months import read_dataset, upsert_months, write_snapshot
from brezza.sources import feeds, http


def _arguments(words: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="brezza", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="upsert a window of the archive service, and take snapshots of the registries")
    run.add_argument("--measurements-url", required=True)
    run.add_argument("--types-url", help="URL of the type registry")
    run.add_argument("--registry", help="CSV file of the station registry")
    run.add_argument("--stations", required=True, help="CSV file that maps archive_id to id")
    run.add_argument("--pollutants", required=True, help="CSV file of the pollutants, with archive_parameter_id")
    run.add_argument("--page-size", type=int, default=2000)
    weather = commands.add_parser("weather", help="upsert hourly weather at the stations of the newest registry snapshot")
    weather.add_argument("--weather-url", required=True)
    for command in (run, weather):
        command.add_argument("--from", dest="first", type=date.fromisoformat)
        command.add_argument("--to", dest="last", type=date.fromisoformat)
        command.add_argument("--days", type=int, default=7, help="days of the window where it has no first day")
    archive = commands.add_parser("archive", help="upsert yearly CSV files into the raw layer")
    archive.add_argument("--csv", required=True)
    archive.add_argument("--from", dest="first", type=date.fromisoformat, default=date(1900, 1, 1))
    archive.add_argument("--to", dest="last", type=date.fromisoformat, default=date(2199, 12, 31))
    build = commands.add_parser("build", help="build all datasets and marts as tables")
    build.add_argument("--pollutants", required=True, help="CSV file of the pollutants")
    build.add_argument("--types", required=True, help="CSV file of reference station types")
    build.add_argument("--reprocess-from", type=date.fromisoformat, help="day from which measurements are worked out again")
    build.add_argument("--full", action="store_true", help="work everything out again")
    export = commands.add_parser("export", help="write the marts as JSON")
    export.add_argument("--out", required=True)
    gaps = commands.add_parser("gaps", help="print the months that are missing from the raw layer")
    gaps.add_argument("--since", type=date.fromisoformat)
    gaps.add_argument("--today", type=date.fromisoformat)
    gaps.add_argument("--most", type=int, default=12)
    for command in (run, archive, weather, build, gaps):
        command.add_argument("--root", required=True, help="folder of the raw layer")
    return parser.parse_args(words)


def main(words: list[str] | None = None, spark: SparkSession | None = None) -> int:
    asked = _arguments(words)
    config = EngineConfig.parse({}, os.environ)
    spark = spark or SparkSession.builder.appName("brezza").getOrCreate()
    prepare(spark)
    today = getattr(asked, "today", None) or local_today(datetime.now(UTC), config.local_utc_offset_hours)
    for source in (http.PagedJson, http.ChunkedWeather):
        spark.dataSource.register(source)
    if asked.command == "run":
        window = resolve_window(asked.first, asked.last, today, asked.days)
        pollutants = seeds.read_seed(spark, asked.pollutants, schemas.ARCHIVE_PARAMETERS_SCHEMA)
        stations = seeds.read_seed(spark, asked.stations, schemas.STATION_MAP_SCHEMA)
        rows, unmapped = pipeline.fetch_measurements(spark, asked.measurements_url, window, stations, pollutants, asked.page_size)
        print(upsert_months(rows, asked.root, schemas.MEASUREMENTS))
        for row in unmapped.orderBy("station_id").collect():
            print("no id for station", row.station_id)
        if asked.registry:
            print("sensors:", write_snapshot(feeds.read_station_registry(spark, asked.registry), asked.root, schemas.STATIONS, today))
        if asked.types_url:
            body = http.get_parsed(http.UrlTransport(), asked.types_url, {}, http.sound_json)
            print("station types:", write_snapshot(feeds.parse_station_types(spark.createDataFrame([(body,)], "body string"), "body"), asked.root, schemas.STATION_TYPES, today))
    elif asked.command == "weather":
        window = resolve_window(asked.first, asked.last, today, asked.days)
        sensors = models.stage_stations(read_dataset(spark, asked.root, schemas.STATIONS))
        print(upsert_months(pipeline.fetch_weather(spark, asked.weather_url, window, sensors, config), asked.root, schemas.WEATHER))
    elif asked.command == "archive":
        window = DateWindow(asked.first, asked.last)
        rows = feeds.read_archive(spark, feeds.archive_files(spark, asked.csv, window), config.local_utc_offset_hours, window)
        print(upsert_months(rows, asked.root, schemas.ARCHIVE))
    elif asked.command == "build":
        pollutants = seeds.read_seed(spark, asked.pollutants, schemas.POLLUTANTS_SCHEMA)
        types = seeds.read_seed(spark, asked.types, schemas.TYPES_REFERENCE_SCHEMA)
        for name, df in pipeline.build(spark, asked.root, config, pollutants, seeds.air_quality_limits(spark), types, tables=True, reprocess_from=asked.reprocess_from, full=asked.full).items():
            print(name, df.count())
    elif asked.command == "export":
        print(serving.export_marts(serving.Marts(spark), Path(asked.out), config, datetime.now(UTC)))
    else:
        recent = read_dataset(spark, asked.root, schemas.MEASUREMENTS)
        weather = read_dataset(spark, asked.root, schemas.WEATHER)
        loaded = serving.loaded_days(recent, "measured_at", config.local_utc_offset_hours).intersect(serving.loaded_days(weather, "observed_at", 0))
        since = asked.since or serving.archive_end(read_dataset(spark, asked.root, schemas.ARCHIVE), config.local_utc_offset_hours) or today.replace(month=1, day=1)
        for row in serving.missing_months(spark, since, today, loaded, asked.most).collect():
            print(row.first, row.last)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
