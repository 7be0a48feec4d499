"""Ingestion and the whole build."""

from __future__ import annotations

import json
from datetime import date
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brezza import schemas
from brezza.config import DateWindow, EngineConfig
from brezza.operators.checkpoints import shared_checkpoint
from brezza.operators.history import snapshot_versions
from brezza.operators.relational import delete_insert
from brezza.plans import marts, models
from brezza.sinks.months import WriteReport, as_table, as_view, read_dataset, replace_months, table_exists, upsert_months
from brezza.sources import feeds

STATION_ATTRIBUTES = ["station_name", "municipality", "province", "address", "altitude_m", "longitude", "latitude", "pollutant_name", "unit_original"]


class Source(Protocol):
    def fetch(self, window: DateWindow) -> DataFrame: ...


def ingest(source: Source, root: str, dataset: schemas.Dataset, window: DateWindow) -> WriteReport:
    """Fetches a window and upserts it.  If fetching fails, nothing is written."""
    return upsert_months(source.fetch(window), root, dataset)


def fetch_measurements(
    spark: SparkSession, url: str, window: DateWindow, stations: DataFrame, pollutants: DataFrame, page_size: int = 2000, source: str = "paged_json"
) -> tuple[DataFrame, DataFrame]:
    """(raw measurements of a window, archive numbers of stations without an id), from the pages of the service.

    ``stations`` maps ``archive_id`` to ``id``; ``pollutants`` has ``pollutant_id, averaging_minutes, archive_parameter_id``, a small dimension.
    """
    known = [(r.pollutant_id, r.averaging_minutes, r.archive_parameter_id) for r in pollutants.where("archive_parameter_id is not null").select("pollutant_id", "averaging_minutes", "archive_parameter_id").collect()]
    where = json.dumps(feeds.measurement_filter(window, sorted(parameter for _, _, parameter in known)))
    pages = spark.read.format(source).option("url", url).option("page_size", page_size).option("param.where", where).load()
    ids = pollutants.select(F.col("archive_parameter_id").alias("archive_id"), F.col("pollutant_id").cast("bigint").alias("id"))
    return feeds.parse_measurement_pages(pages, "body", stations, ids, [pollutant for pollutant, minutes, _ in known if minutes == 1440], window)


def fetch_weather(spark: SparkSession, url: str, window: DateWindow, stations: DataFrame, config: EngineConfig, chunk: int = 10, source: str = "chunked_weather") -> DataFrame:
    """Hourly weather of a window at the grid cells that hold a station, a request for each ``chunk`` of cells."""
    places = [r.asDict() for r in feeds.weather_locations(stations, config.weather_coordinate_decimals).collect()]
    options = {"url": url, "locations": json.dumps(places), "start": window.first.isoformat(), "end": window.last.isoformat(), "hourly": feeds.weather_variables(), "chunk": str(chunk)}
    answers = spark.read.format(source).options(**options).load()
    asked = F.from_json("asked", "array<struct<location_id: string, latitude: double, longitude: double>>")
    return feeds.parse_weather(answers.select("body", asked.alias("asked")), "body", "asked")


def merge_snapshot(history: DataFrame | None, snapshot: DataFrame, day: date) -> DataFrame:
    """The history of the stations after one more full snapshot: changed and missing keys close, changed and new ones open."""
    dated = snapshot.withColumn("_day", F.lit(day)).withColumn("_loaded", F.lit(None).cast("timestamp"))
    return snapshot_versions(dated, ["station_id", "pollutant_id"], STATION_ATTRIBUTES, "_day", "_loaded", history)


def build(spark: SparkSession, root: str, config: EngineConfig, pollutants: DataFrame, limits: DataFrame, types_reference: DataFrame, tables: bool = False, reprocess_from: date | None = None, full: bool = False) -> dict[str, DataFrame]:
    """All datasets from the raw layer to the marts, in the order in which they depend on each other.

    With ``tables``, the intermediate datasets and marts are written as tables; else all are views.  The table of measurements is kept up to date:
    where there is one, only rows in scope (the last ``lookback_days``, what ``reprocess_from`` reaches back to, archive rows that it lacks) are worked
    out again, and only the months that they lie in are written, unless ``full``.
    """
    keep = as_table if tables else lambda df, name: as_view(df, name)
    out: dict[str, DataFrame] = {}
    recent = models.stage_measurements(read_dataset(spark, root, schemas.MEASUREMENTS))
    archive = models.stage_measurements(read_dataset(spark, root, schemas.ARCHIVE))
    types = models.stage_station_types(read_dataset(spark, root, schemas.STATION_TYPES))
    registry = read_dataset(spark, root, schemas.STATIONS)
    weather = models.stage_weather(read_dataset(spark, root, schemas.WEATHER))
    renamed = registry.withColumnRenamed("unit", "unit_original").withColumn("_loaded", F.lit(None).cast("timestamp"))
    out["snap_stations"] = keep(snapshot_versions(renamed, ["station_id", "pollutant_id"], STATION_ATTRIBUTES, "extracted_on", "_loaded"), "snap_stations")
    sources, name = {"archive": archive, "near_real_time": recent}, "int_measurements_deduplicated"
    if tables and not full and table_exists(spark, name):
        spark.catalog.dropTempView(name)
        loaded = spark.table(name).drop("part")
        since = None if reprocess_from is None else F.lit(reprocess_from).cast("timestamp_ntz")
        fresh = shared_checkpoint(models.deduplicated_measurements(sources, pollutants, config, models.scope_of(loaded), since, merge=False))
        touched = fresh.select(F.date_format("measured_at_utc", "yyyy-MM").alias("part")).distinct()
        facts = replace_months(delete_insert(loaded, fresh, models.FACT_KEY), name, "measured_at_utc", touched)
    elif tables:
        facts = replace_months(models.deduplicated_measurements(sources, pollutants, config), name, "measured_at_utc")
    else:
        facts = as_view(models.deduplicated_measurements(sources, pollutants, config), name)
    out[name] = facts
    out["int_measurements_daily"] = daily = keep(models.daily_measurements(facts, config), "int_measurements_daily")
    ozone = limits.where(F.col("metric") == "daily_max_8h_mean").select("pollutant_id")
    out["int_o3_8h_rolling"] = rolling = keep(models.rolling_means(facts.join(ozone, "pollutant_id", "left_semi"), config), "int_o3_8h_rolling")
    out["int_stations_current"] = stations = keep(models.current_stations(out["snap_stations"], types, config), "int_stations_current")
    out["int_station_types_current"] = kinds = keep(models.current_station_types(types, types_reference), "int_station_types_current")
    out["int_weather_daily"] = days = keep(models.daily_weather(weather, config), "int_weather_daily")
    out["mart_exceedances_yearly"] = keep(marts.yearly_exceedances(daily, facts, rolling, limits, stations, config), "mart_exceedances_yearly")
    out["mart_data_completeness"] = keep(marts.data_completeness(daily, stations), "mart_data_completeness")
    out["mart_pollutant_trend"] = keep(marts.pollutant_trend(daily, stations, config), "mart_pollutant_trend")
    out["mart_traffic_vs_background"] = keep(marts.traffic_vs_background(daily, kinds, stations), "mart_traffic_vs_background")
    out["mart_weather_correlation"] = keep(marts.weather_correlation(daily, stations, days, config), "mart_weather_correlation")
    return out
