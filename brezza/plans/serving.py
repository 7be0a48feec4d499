"""Reading the marts: parametrised accessors, checks, gaps and the JSON export."""

from __future__ import annotations

import json
from collections.abc import Iterable
from datetime import UTC, date, datetime, timedelta
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brezza.config import ConfigError, DateWindow, EngineConfig, legal_day
from brezza.errors import ExportTooLargeError, MissingMartError
from brezza.functions.quality_flags import one_of
from brezza.plans.marts import monthly_completeness

# Version, precision, file names, columns and order of rows of the export contract.
SCHEMA_VERSION = 1
EXPORT_DECIMALS = 3
_PLACE = ["station_id", "station_name", "municipality"]
COLUMNS = {
    "mart_exceedances_yearly": [
        *_PLACE, "pollutant_code", "metric", "year", "exceedances", "limit_ugm3", "max_exceedances_per_year", "is_over_allowed_exceedances", "max_value_ugm3", "valid_periods", "year_coverage",
    ],
    "mart_pollutant_trend": ["municipality", "pollutant_code", "year", "stations", "annual_mean_ugm3", "min_station_mean_ugm3", "max_station_mean_ugm3", "min_year_coverage", "is_representative"],
    "mart_traffic_vs_background": [
        "municipality", "pollutant_code", "month", "days", "traffic_stations", "background_stations", "traffic_mean_ugm3", "background_mean_ugm3", "difference_ugm3", "traffic_to_background_ratio",
    ],
    "mart_weather_correlation": [
        *_PLACE, "season", "days", "pm10_mean_ugm3", "corr_pm10_wind", "corr_pm10_precipitation", "windy_days", "pm10_mean_windy_ugm3", "pm10_mean_calm_ugm3", "rainy_days",
        "pm10_mean_rainy_ugm3", "pm10_mean_dry_ugm3",
    ],
    "mart_data_completeness": ["station_id", "station_name", "pollutant_code", "measurement_date", "expected_measurements", "valid_measurements", "completeness", "is_complete"],
    "monthly_completeness": [*_PLACE, "pollutant_code", "month", "days", "complete_days", "completeness"],
}
EXPORTS = {
    "exceedances.json": ("mart_exceedances_yearly", ["station_id", "pollutant_code", "metric", "year"]),
    "pollutant-trend.json": ("mart_pollutant_trend", ["municipality", "pollutant_code", "year"]),
    "traffic-vs-background.json": ("mart_traffic_vs_background", ["municipality", "pollutant_code", "month"]),
    "weather-correlation.json": ("mart_weather_correlation", ["station_id", "season"]),
    "completeness-monthly.json": ("monthly_completeness", ["station_id", "pollutant_code", "month"]),
}
CREDITS = [
    {"source": "ARPAE Emilia-Romagna", "url": "https://dati.arpae.it", "licence": "CC BY", "note": "Air quality measurements, processed."},
    {"source": "Open-Meteo", "url": "https://open-meteo.com", "licence": "CC BY 4.0", "note": "Weather data."},
]


class Marts:
    """Read access to the marts: tables of a session, or DataFrames by name."""

    def __init__(self, spark: SparkSession, frames: dict[str, DataFrame] | None = None):
        self._spark, self._frames = spark, frames or {}

    def read(self, mart: str) -> DataFrame:
        if not (mart.startswith("mart_") and mart.isidentifier()):
            raise ValueError(f"{mart!r} is not the name of a mart")
        if mart in self._frames:
            return self._frames[mart]
        try:
            return self._spark.table(mart)
        except AnalysisException as e:
            raise MissingMartError(f"{mart} has not been built yet") from e

    def _rows(self, mart: str) -> DataFrame:
        """A mart with the columns that it is served with."""
        return self.read(mart).select(*COLUMNS[mart])

    def _column(self, mart: str, column: str) -> tuple[DataFrame, Column]:
        if not column.isidentifier():
            raise ValueError(f"{column!r} is not the name of a column")
        return self.read(mart), F.col(column)

    def distinct(self, mart: str, column: str) -> DataFrame:
        """The distinct non-null values, sorted."""
        df, c = self._column(mart, column)
        return df.where(c.isNotNull()).select(c).distinct().orderBy(column)

    def date_range(self, mart: str, column: str) -> tuple[date, date] | None:
        df, c = self._column(mart, column)
        row = df.agg(F.min(c).alias("a"), F.max(c).alias("z")).first()
        return (row.a, row.z) if row and row.a else None

    def exceedances(self, metric: str, stations: list[str] | None = None, years: tuple[int, int] | None = None) -> DataFrame:
        df = self._rows("mart_exceedances_yearly").where((F.col("metric") == metric) & one_of(F.col("station_name"), stations) & _between("year", years))
        return df.orderBy("station_name", "year")

    def pollutant_trend(self, pollutant: str, municipalities: list[str] | None = None, years: tuple[int, int] | None = None) -> DataFrame:
        df = self._rows("mart_pollutant_trend").where((F.col("pollutant_code") == pollutant) & one_of(F.col("municipality"), municipalities) & _between("year", years))
        return df.orderBy("municipality", "year")

    def traffic_vs_background(self, pollutant: str, municipality: str, period: tuple[date, date] | None = None) -> DataFrame:
        df = self._rows("mart_traffic_vs_background")
        return df.where((F.col("pollutant_code") == pollutant) & (F.col("municipality") == municipality) & _between("month", period)).orderBy("month")

    def weather_correlation(self, stations: list[str] | None = None, seasons: list[str] | None = None) -> DataFrame:
        df = self._rows("mart_weather_correlation").where(one_of(F.col("station_name"), stations) & one_of(F.col("season"), seasons))
        return df.orderBy("station_name", "season")

    def completeness(self, station: str, pollutants: list[str] | None = None, period: tuple[date, date] | None = None) -> DataFrame:
        df = self._rows("mart_data_completeness")
        return df.where((F.col("station_name") == station) & one_of(F.col("pollutant_code"), pollutants) & _between("measurement_date", period)).orderBy("pollutant_code", "measurement_date")


def _between(column: str, bounds: tuple | None) -> Column:
    return F.lit(True) if bounds is None else F.col(column).between(*bounds)


def recent_completeness(completeness: DataFrame, days: int) -> DataFrame:
    """``complete, total, share`` over the last ``days`` days of the data; the share of none is 0."""
    newest = completeness.agg(F.max("measurement_date").alias("_newest"))
    recent = completeness.where(F.col("measurement_date") > F.date_sub(newest.scalar(), days))
    counts = recent.agg(F.count_if("is_complete").alias("complete"), F.count(F.lit(1)).alias("total"))
    return counts.withColumn("share", F.coalesce(F.try_divide("complete", "total"), F.lit(0.0)))


def newest_instant(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(column).alias("newest"))


def freshness(df: DataFrame, column: str, now: Column, hours: float) -> DataFrame:
    """``newest, age_hours, passed``: a warning where the newest instant is older than ``hours``, or where there is none."""
    age = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("newest").cast("timestamp"))) / 3.6e9
    aged = newest_instant(df, column).select("newest", age.alias("age_hours"))
    return aged.withColumn("passed", F.coalesce(F.col("age_hours") <= hours, F.lit(False)))


def completeness_verdict(completeness: DataFrame, days: int, least: float) -> DataFrame:
    """``complete, total, share, passed`` over the last ``days`` days of the data: a warning below the least share."""
    return recent_completeness(completeness, days).withColumn("passed", F.col("share") >= least)


def is_fresh(newest: datetime | None, now: datetime, hours: float) -> bool:
    """Whether data are no older than ``hours``; none at all are not fresh."""
    return newest is not None and (now - newest).total_seconds() <= hours * 3600


def loaded_days(df: DataFrame, column: str, offset_hours: int) -> DataFrame:
    """``day``: local days that hold a value which is stamped at the end of its period (an offset of 0 gives UTC days as they are)."""
    stamp = F.col(column) + F.make_dt_interval(hours=F.lit(offset_hours), secs=F.lit(-1 if offset_hours else 0))
    return df.where(F.col(column).isNotNull()).select(F.to_date(stamp).alias("day")).distinct()


def archive_end(archive: DataFrame, offset_hours: int) -> date | None:
    """The day after the archive's last local day, where a refresh begins; none for an empty archive."""
    newest = archive.agg(F.max("measured_at").alias("newest")).first().newest
    return legal_day(newest.replace(tzinfo=UTC), offset_hours) + timedelta(days=1) if newest else None


def missing_months(spark: SparkSession, since: date, today: date, loaded: DataFrame, most: int) -> DataFrame:
    """``first, last`` of the months to fetch, oldest first: a past month is there if its first and last day are, the current one by its first."""
    if most < 1:
        raise ConfigError("at least one month must be asked for")
    months = [(w.first, w.last) for w in DateWindow(since, today).months()] if since <= today else []
    wanted = spark.createDataFrame(months, "first date, last date")
    ends = wanted.select("first", "last", F.explode(F.when(F.col("last") < F.lit(today), F.array("first", "last")).otherwise(F.array("first"))).alias("day"))
    return ends.join(loaded, "day", "left_anti").select("first", "last").distinct().orderBy("first").limit(most)


def export_rows(marts: Marts, name: str) -> DataFrame:
    """``line``: the records of an export file in its order, each as JSON with all of its columns.

    Numbers have ``EXPORT_DECIMALS`` decimals, NaN and infinities are null, days are in ISO form.
    """
    source, order = EXPORTS[name]
    df = monthly_completeness(marts.read("mart_data_completeness")) if source == "monthly_completeness" else marts.read(source)

    def plain(column: str, kind: str) -> Column:
        if kind not in ("double", "float") and not kind.startswith("decimal"):
            return F.col(column)
        number = F.col(column).cast("double")
        return F.when(F.abs(number) < float("inf"), F.round(number, EXPORT_DECIMALS)).alias(column)

    rows = df.select(*COLUMNS[source])
    return rows.orderBy(*order).select(F.to_json(F.struct(*(plain(c, t) for c, t in rows.dtypes)), {"ignoreNullFields": "false"}).alias("line"))


def _write(path: Path, text: str, limit: int) -> None:
    data = text.encode()
    if len(data) > limit:
        raise ExportTooLargeError(f"{path.name} has {len(data)} bytes, more than {limit}")
    path.write_bytes(data)


def export_marts(marts: Marts, folder: Path, config: EngineConfig, now: datetime, credits: Iterable[dict] = CREDITS) -> dict:
    """Writes the export files and ``meta.json``, and returns the latter's content.  A file that would be too large is not fetched from the cluster."""
    folder.mkdir(parents=True, exist_ok=True)
    files: dict[str, int] = {}
    for name in EXPORTS:
        lines = export_rows(marts, name)
        size, files[name] = lines.agg(F.coalesce(F.sum(F.octet_length("line") + 1), F.lit(1)) + 1, F.count(F.lit(1))).first()
        if size > config.max_export_bytes:
            raise ExportTooLargeError(f"{name} has {size} bytes, more than {config.max_export_bytes}")
        _write(folder / name, "[" + ",".join(r.line for r in lines.collect()) + "]", config.max_export_bytes)
    period = marts.date_range("mart_data_completeness", "measurement_date")
    meta = {
        "schema_version": SCHEMA_VERSION,
        "generated_at": now.astimezone(UTC).isoformat(),
        "period": {"from": period[0].isoformat(), "to": period[1].isoformat()} if period else None,
        "files": files,
        "credits": list(credits),
    }
    _write(folder / "meta.json", json.dumps(meta, ensure_ascii=False, separators=(",", ":")), config.max_export_bytes)
    return meta
