"""Queries of the engine's own datasets and operators over the test tables, and the SQL that they are checked against.

Where the test tables lack an input (station type labels, weather), an adapter derives it from columns that are there, in the query and in
its SQL alike.  Averages and other floating sums are rounded to six decimals, as the order of addition differs between engines.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brezza import seeds
from brezza.config import EngineConfig
from brezza.functions import quality_flags as Q
from brezza.functions import temporal as X
from brezza.operators import quality, relational
from brezza.operators.history import snapshot_versions
from brezza.plans import marts, models, serving
from brezza.plans.problems import SERIES, STATION_ATTRIBUTES, Query
from brezza.sources import feeds
from brezza.sources.tables import table

CONFIG = EngineConfig()
UPSERT_KEY = ["station_id", "pollutant_id", "measured_at_utc"]


def _rounded(df: DataFrame, decimals: int = 6) -> DataFrame:
    return df.select(*(F.round(c, decimals).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


def _facts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "int_measurements_deduplicated")


def _daily(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "int_measurements_daily")


def _feed(spark: SparkSession, d: str) -> DataFrame:
    """The newest feed as a staged source; of several deliveries of a key the latest, then the greatest row, holds."""
    feed = table(spark, d, "stg_arpae__measurements")
    return relational.latest_per_key(feed.select(*UPSERT_KEY, "concentration_ugm3", "value_original", "unit_original", "validation_flag", F.struct("ingested_at", "row_id").alias("_at")), UPSERT_KEY, "_at").drop("_at")


def _versions(spark: SparkSession, d: str) -> DataFrame:
    earlier = table(spark, d, "snap_arpae__stations").withColumnsRenamed({"dbt_valid_from": "valid_from", "dbt_valid_to": "valid_to"})
    return snapshot_versions(table(spark, d, "stg_arpae__stations"), SERIES, STATION_ATTRIBUTES, "extracted_on", "loaded_at", earlier)


def _type_label() -> Column:
    step = F.pmod(F.col("station_id") + F.datediff(F.col("extracted_on"), F.lit("2024-01-01").cast("date")), F.lit(7))
    return (
        F.when(step == 0, "Urbana Traffico").when(step == 1, "Suburbana Fondo").when(step == 2, "Rurale").when(step == 3, "Fondo remoto").when(step == 4, "URBANA INDUSTRIALE").when(step == 5, "Traffico").otherwise("")
    )


def _types(spark: SparkSession, d: str) -> DataFrame:
    """Station type snapshots: one row per station and day, also of stations that only the fact knows."""
    days = table(spark, d, "stg_arpae__stations").groupBy("station_id", "extracted_on").agg(F.lit("").alias("province"))
    unknown = _facts(spark, d).select("station_id").distinct().withColumn("extracted_on", F.lit("2024-06-24").cast("date")).withColumn("province", F.lit(""))
    raw = days.unionByName(unknown).distinct().select("station_id", F.concat(F.lit("S"), F.col("station_id")).alias("station_name"), "province", _type_label().alias("type_label"), F.lit("20240101").alias("bulletin_id"), "extracted_on")
    return models.stage_station_types(raw)


def _types_reference(spark: SparkSession, d: str) -> DataFrame:
    stations = _facts(spark, d).select("station_id").distinct()
    step = F.pmod(F.col("station_id"), F.lit(3))
    return stations.select("station_id", F.when(step == 0, "background").when(step == 1, "traffic").otherwise("other").alias("station_type"), F.when(step == 0, "rural").alias("area_type"))


def _stations(spark: SparkSession, d: str) -> DataFrame:
    """One row per station: of several open versions (one per pollutant) that differ, the least holds."""
    sensors = models.current_sensors(table(spark, d, "stg_arpae__stations"), SERIES, "extracted_on", "loaded_at")
    current = models.current_stations(sensors, _types(spark, d), CONFIG)
    names = [c for c in current.columns if c != "station_id"]
    upper = [F.upper(F.regexp_replace(c, r"\s+", "")).alias(c) if c in ("station_name", "municipality", "province", "address") else F.col(c) for c in names]
    tidy = current.select("station_id", *upper)
    return relational.first_per_key(tidy, ["station_id"], [F.col(c) for c in names])


def _weather(spark: SparkSession, d: str, stations: DataFrame) -> DataFrame:
    """Hourly weather: the ozone readings of the fact stand for wind and temperature, at the location of their station."""
    places = stations.where(F.col("weather_location_id").isNotNull()).select("station_id", F.col("weather_location_id").alias("location_id"))
    ozone = _facts(spark, d).where((F.col("pollutant_code") == "O3") & F.col("is_valid"))
    hour = F.hour("measured_at_utc")
    return ozone.join(places, "station_id").select(
        "location_id",
        F.col("measured_at_utc").alias("observed_at_utc"),
        (F.col("concentration_ugm3") / 4).alias("temperature_c"),
        F.when(hour % 11 != 0, F.pmod(F.dayofmonth("measured_at_utc"), F.lit(4)) * 0.1).alias("precipitation_mm"),
        (F.col("concentration_ugm3") / 16).alias("wind_speed_ms"),
        F.lit(90.0).alias("wind_direction_deg"),
        (F.col("concentration_ugm3") + 900).alias("surface_pressure_hpa"),
    )


def s05_archive_stamps(spark: SparkSession, d: str) -> DataFrame:
    """Every row of the yearly files through the parser of the archive: its ids, stamp and value, or what of it cannot be read."""
    read = feeds.parse_archive_rows(table(spark, d, "csv_row"), CONFIG.local_utc_offset_hours)
    return read.select("file_name", "row_no", "station_id", "pollutant_id", X.to_naive_utc(F.col("measured_at")).alias("measured_at_utc"), "value", "problem").distinct()


def s07_archive_records(spark: SparkSession, d: str) -> DataFrame:
    """Every record of the archive service, each as a JSON page: mapped to the engine's ids and moved to its stamps, or what of it cannot be read.

    Records without a station number are those of unknown stations, which the parser leaves out.
    """
    records = table(spark, d, "measurement_record")
    pollutants = table(spark, d, "arpae_pollutants").select(F.col("archive_parameter_id").alias("archive_id"), F.col("pollutant_id").alias("id"))
    item = F.struct(*(F.col(c) for c in ("_id", "station_id", "parameter_id", "reftime", "value", "parameter_unit", "validity")))
    pages = records.select(F.to_json(F.struct(F.array(item).alias("_items"), F.struct(F.lit(1).alias("total")).alias("_meta"))).alias("body"))
    number = F.col("station_id").try_cast("bigint")
    stations = records.select(F.col("station_id").alias("archive_id"), number.alias("id")).where(number.isNotNull()).distinct()
    daily = [r.id for r in table(spark, d, "arpae_pollutants").where("averaging_minutes = 1440").select(F.col("pollutant_id").alias("id")).collect()]
    read, _ = feeds.parse_measurement_pages(pages, "body", stations, pollutants, daily, problems=True)
    return read.select("record_id", "station_id", F.col("pollutant_id").cast("bigint").alias("pollutant_id"), X.to_naive_utc(F.col("measured_at")).alias("measured_at_utc"), "value", "raw_reftime", "problem").distinct()


def s09_station_registry(spark: SparkSession, d: str) -> DataFrame:
    """All snapshots of the registry as rows of its CSV file, read back."""
    stations = table(spark, d, "stg_arpae__stations")
    names = {"Cod_staz": "station_id", "Stazione": "station_name", "COMUNE": "municipality", "PROVINCIA": "province", "INDIRIZZO": "address", "Altezza": "altitude_m", "LON_GEO": "longitude",
             "LAT_GEO": "latitude", "Id_Param": "pollutant_id", "PARAMETRO": "pollutant_name", "UM": "unit_original"}
    return _rounded(feeds.parse_station_registry(stations.select(*(F.col(c).cast("string").alias(name) for name, c in names.items()))))


def s10_station_types(spark: SparkSession, d: str) -> DataFrame:
    """Pages of the type registry, one for each station and day; area and exposure are derived from the station's number."""
    days = table(spark, d, "stg_arpae__stations").select("station_id", "extracted_on").distinct()
    step = F.pmod(F.col("station_id"), F.lit(3))
    item = F.struct(
        F.col("station_id").cast("string").alias("_id"),
        F.concat(F.lit(" S"), "station_id").alias("nome"),
        F.lit("BO ").alias("sigla_provincia"),
        F.when(step == 0, "Traffico").when(step == 1, " Fondo ").otherwise("").alias("tipo_stazione"),
        F.when(step == 2, "Rurale").otherwise("Urbana").alias("zona"),
        F.concat(F.date_format("extracted_on", "EEE, dd MMM yyyy"), F.lit(" 10:00:00 GMT")).alias("_updated"),
    )
    pages = days.select(F.to_json(F.struct(F.array(item).alias("_items"), F.struct(F.lit(1).alias("total")).alias("_meta"))).alias("body"))
    return feeds.parse_station_types(pages, "body")


def s11_weather(spark: SparkSession, d: str) -> DataFrame:
    """Answers of the weather service, one for each ozone station and day, with the readings as temperatures and every third wind missing."""
    ozone = _facts(spark, d).where((F.col("pollutant_code") == "O3") & F.col("concentration_ugm3").isNotNull())
    wind = F.when(F.hour("measured_at_utc") % 3 != 0, F.col("concentration_ugm3") / 8)
    hours = ozone.groupBy("station_id", F.to_date("measured_at_utc").alias("day")).agg(
        F.sort_array(F.collect_list(F.struct(F.date_format("measured_at_utc", "yyyy-MM-dd'T'HH:mm").alias("time"), F.col("concentration_ugm3").alias("t"), wind.alias("w")))).alias("h")
    )
    none = F.transform("h", lambda h: F.lit(None).cast("double"))
    series = F.struct(
        F.col("h.time").alias("time"), F.col("h.t").alias("temperature_2m"), none.alias("precipitation"), F.col("h.w").alias("wind_speed_10m"), none.alias("wind_direction_10m"), none.alias("surface_pressure")
    )
    answer = F.struct(F.lit(44.5).alias("latitude"), F.lit(11.5).alias("longitude"), F.lit(0).alias("utc_offset_seconds"), series.alias("hourly"))
    place = F.array(F.struct(F.concat(F.lit("L"), "station_id").alias("location_id"), F.lit(44.4).alias("latitude"), F.lit(11.4).alias("longitude")))
    read = feeds.parse_weather(hours.select(F.to_json(answer, {"ignoreNullFields": "false"}).alias("body"), place.alias("asked")), "body", "asked")
    return read.select("location_id", "latitude", "grid_latitude", X.to_naive_utc(F.col("observed_at")).alias("observed_at_utc"), F.round("temperature_c", 6).alias("temperature_c"), F.round("wind_speed_ms", 6).alias("wind_speed_ms"))


def s14_weather_locations(spark: SparkSession, d: str) -> DataFrame:
    return feeds.weather_locations(table(spark, d, "stg_arpae__stations"), CONFIG.weather_coordinate_decimals)


def f01_unit_conversion(spark: SparkSession, d: str) -> DataFrame:
    feed = table(spark, d, "stg_arpae__measurements")
    return feed.select("row_id", F.round(Q.to_ugm3(F.col("value_original"), F.col("unit_original")), 6).alias("concentration_ugm3"))


def f06_location_id(spark: SparkSession, d: str) -> DataFrame:
    sensors = table(spark, d, "snap_arpae__stations")
    return sensors.select(*SERIES, Q.location_id(F.col("latitude"), F.col("longitude"), 1).alias("weather_location_id")).distinct()


def f10_calendar(spark: SparkSession, d: str) -> DataFrame:
    day = F.col("measurement_date")
    return _daily(spark, d).select(day).distinct().select(
        day.alias("day"), X.season(day).alias("season"), X.month_start(day).alias("month"), X.days_in_year(F.year(day)).cast("bigint").alias("days_in_year"), F.year(day).cast("bigint").alias("year")
    )


def f16_unpivot(spark: SparkSession, d: str) -> DataFrame:
    """Daily mean and maximum as rows of (statistic, value)."""
    long = _daily(spark, d).unpivot(["station_id", "pollutant_id", "measurement_date"], ["daily_mean_ugm3", "daily_max_ugm3"], "statistic", "value_ugm3")
    return long.where(F.col("value_ugm3").isNotNull())


def pred04_latest_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """The rows of the newest snapshot of the registry, by a scalar subquery."""
    stations = table(spark, d, "stg_arpae__stations")
    newest = stations.agg(F.max("extracted_on").alias("day"))
    return stations.where(F.col("extracted_on") == newest.scalar()).select(*SERIES, "station_name", "extracted_on").distinct()


def pred05_incremental_scope(spark: SparkSession, d: str) -> DataFrame:
    """What an incremental run would process again if only valid rows were loaded: the last 30 days, and archive rows not loaded at all."""
    loaded = _facts(spark, d).where("is_valid")
    scope = relational.incremental_scope(_facts(spark, d), loaded, "measured_at_utc", UPSERT_KEY, CONFIG.lookback_days, F.col("source_name") == "archive")
    return scope.select(*UPSERT_KEY)


def pred06_reprocess_scope(spark: SparkSession, d: str) -> DataFrame:
    """The same with a date to reprocess from, a day further back than it says."""
    loaded = _facts(spark, d).where("is_valid")
    scope = relational.incremental_scope(
        _facts(spark, d), loaded, "measured_at_utc", UPSERT_KEY, CONFIG.lookback_days, F.col("source_name") == "archive", F.lit("2026-05-10").cast("timestamp_ntz")
    )
    return scope.select(*UPSERT_KEY)


def m01_staged_measurements(spark: SparkSession, d: str) -> DataFrame:
    feed = table(spark, d, "stg_arpae__measurements")
    raw = feed.select("station_id", "pollutant_id", F.col("measured_at_utc").cast("timestamp").alias("measured_at"), F.col("value_original").alias("value"), F.col("unit_original").alias("unit"), "validation_flag", "raw_reftime")
    return _rounded(models.stage_measurements(raw))


def m02_staged_stations(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(models.stage_stations(table(spark, d, "stg_arpae__stations").withColumnRenamed("unit_original", "unit")))


def m04_staged_weather(spark: SparkSession, d: str) -> DataFrame:
    """The ozone table as raw weather."""
    none = F.lit(None).cast("double")
    raw = table(spark, d, "int_o3_8h_rolling").select(
        F.col("station_id").alias("location_id"), F.col("measured_at_utc").cast("timestamp").alias("observed_at"), F.col("rolling_8h_mean_ugm3").alias("temperature_c"), none.alias("precipitation_mm"),
        F.col("valid_hours_in_window").cast("double").alias("wind_speed_ms"), none.alias("wind_direction_deg"), none.alias("surface_pressure_hpa"),
    )
    return _rounded(models.stage_weather(raw))


def m06_measurements_deduplicated(spark: SparkSession, d: str) -> DataFrame:
    """The fact from the archive (what is loaded) and the newest feed, with the archive before the feed."""
    columns = [*UPSERT_KEY, "concentration_ugm3", "value_original", "unit_original", "validation_flag"]
    sources = {"archive": _facts(spark, d).select(*columns), "near_real_time": _feed(spark, d).select(*columns)}
    return _rounded(models.deduplicated_measurements(sources, table(spark, d, "arpae_pollutants"), CONFIG))


def m06_incremental(spark: SparkSession, d: str) -> DataFrame:
    """The fact after an incremental run with the newest feed: rows in scope replaced by key, all others kept."""
    columns = [*UPSERT_KEY, "concentration_ugm3", "value_original", "unit_original", "validation_flag"]
    loaded = _facts(spark, d).where(F.col("measured_at_utc") < F.lit("2026-06-20").cast("timestamp_ntz"))
    fact = models.deduplicated_measurements({"near_real_time": _feed(spark, d).select(*columns)}, table(spark, d, "arpae_pollutants"), CONFIG, loaded)
    return fact.groupBy("source_name", "pollutant_id").agg(F.count(F.lit(1)).alias("rows"), F.count_if("is_valid").alias("valid_rows"))


def m07_measurements_daily(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(models.daily_measurements(_facts(spark, d), CONFIG))


def m08_o3_8h_rolling(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(models.rolling_means(_facts(spark, d).where("pollutant_code = 'O3'"), CONFIG))


def m09_stations_current(spark: SparkSession, d: str) -> DataFrame:
    return _stations(spark, d).select("station_id", "station_name", "municipality", "weather_location_id")


def m10_station_types_current(spark: SparkSession, d: str) -> DataFrame:
    return models.current_station_types(_types(spark, d), _types_reference(spark, d))


def m11_weather_daily(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(models.daily_weather(_weather(spark, d, _stations(spark, d)), CONFIG))


def _exceedances(spark: SparkSession, d: str) -> DataFrame:
    rolling = table(spark, d, "int_o3_8h_rolling")
    return marts.yearly_exceedances(_daily(spark, d), _facts(spark, d), rolling, seeds.air_quality_limits(spark, table(spark, d, "arpae_pollutants")), _stations(spark, d), CONFIG)


def m12_exceedances_yearly(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(_exceedances(spark, d))


def _completeness(spark: SparkSession, d: str) -> DataFrame:
    return marts.data_completeness(_daily(spark, d), _stations(spark, d))


def m13_data_completeness(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(_completeness(spark, d))


def _trend(spark: SparkSession, d: str) -> DataFrame:
    return marts.pollutant_trend(_daily(spark, d), _stations(spark, d), CONFIG)


def m14_pollutant_trend(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(_trend(spark, d))


def _traffic(spark: SparkSession, d: str) -> DataFrame:
    types = models.current_station_types(_types(spark, d), _types_reference(spark, d))
    # By province, as few municipalities of the test data have both kinds of station.
    return marts.traffic_vs_background(_daily(spark, d), types, _stations(spark, d).withColumn("municipality", F.col("province")))


def m15_traffic_vs_background(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(_traffic(spark, d))


def _correlation(spark: SparkSession, d: str) -> DataFrame:
    stations = _stations(spark, d)
    return marts.weather_correlation(_daily(spark, d), stations, models.daily_weather(_weather(spark, d, stations), CONFIG), CONFIG)


def m16_weather_correlation(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(_correlation(spark, d))


def k01_upsert(spark: SparkSession, d: str) -> DataFrame:
    """What an upsert of the newest feed does to the fact's rows, by kind of change and pollutant."""
    columns = [*UPSERT_KEY, "value_original", "unit_original"]
    feed = table(spark, d, "stg_arpae__measurements").select(*columns, "row_id")
    merged = relational.upsert_relation(_facts(spark, d).select(*columns), feed, UPSERT_KEY, "row_id")
    return merged.groupBy("_change", "pollutant_id").agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("value_original"), 4).alias("total")).withColumnRenamed("_change", "change")


def k09_scd2(spark: SparkSession, d: str) -> DataFrame:
    """The history of the stations with all attributes in tidy form."""
    versions = _versions(spark, d)
    return versions.select(*SERIES, F.upper(F.regexp_replace("station_name", r"\s+", "")).alias("station_name"), F.round("altitude_m", 3).alias("altitude_m"), "valid_from", "valid_to")


def k11_monthly_completeness(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(marts.monthly_completeness(marts.data_completeness(_daily(spark, d), _stations(spark, d)))).drop("station_name", "municipality")


def q01_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return quality.duplicates(table(spark, d, "stg_arpae__measurements"), UPSERT_KEY)


def q02_orphans(spark: SparkSession, d: str) -> DataFrame:
    """Series of the registry of which the fact has no reading."""
    series = F.concat_ws(":", "station_id", "pollutant_id")
    listed = table(spark, d, "stg_arpae__stations").select(*SERIES, series.alias("series")).distinct()
    return quality.orphans(listed, "series", _facts(spark, d).select(series.alias("series")), "series").select(*SERIES)


def q02_nulls(spark: SparkSession, d: str) -> DataFrame:
    return quality.nulls(table(spark, d, "stg_arpae__measurements"), "unit_original").select("row_id")


def q02_unaccepted(spark: SparkSession, d: str) -> DataFrame:
    return quality.unaccepted(table(spark, d, "stg_arpae__measurements"), "unit_original", [*Q.MICROGRAMS, *Q.MILLIGRAMS])


def q03_correlations(spark: SparkSession, d: str) -> DataFrame:
    """Correlations beyond a tenth, by a tolerance below zero; none is beyond one."""
    beyond = quality.correlations_out_of_range(m16_weather_correlation(spark, d), ["corr_pm10_wind", "corr_pm10_precipitation"], -0.9)
    return beyond.select("station_id", "season", "corr_pm10_wind", "corr_pm10_precipitation")


def q05_inconsistent_exceedances(spark: SparkSession, d: str) -> DataFrame:
    """What the check would find if a limit had been exceeded a hundred times more."""
    yearly = m12_exceedances_yearly(spark, d).withColumn("exceedances", F.col("exceedances") + 100)
    return quality.inconsistent_exceedances(yearly).select("station_id", "pollutant_id", "year", "exceedances", "valid_periods")


def q07_missing_kinds(spark: SparkSession, d: str) -> DataFrame:
    types = models.current_station_types(_types(spark, d), _types_reference(spark, d))
    return quality.missing_kinds(types, "station_type", ["traffic", "background", "industrial", "harbour", "other"])


def q08_implausible(spark: SparkSession, d: str) -> DataFrame:
    return quality.flagged(_facts(spark, d), "is_implausible")


def q08_negative(spark: SparkSession, d: str) -> DataFrame:
    return quality.flagged(_facts(spark, d), "is_negative")


def q08_stale_types(spark: SparkSession, d: str) -> DataFrame:
    return quality.stale_types(models.current_station_types(_types(spark, d), _types_reference(spark, d)))


def q04_inconsistent_days(spark: SparkSession, d: str) -> DataFrame:
    days = models.daily_measurements(_facts(spark, d).where("not is_implausible"), CONFIG)
    return _rounded(quality.inconsistent_days(days.withColumn("expected_measurements", F.col("expected_measurements") - 1)))


def q06_flagged_but_valid(spark: SparkSession, d: str) -> DataFrame:
    """What the check would find if every reading that is there counted as valid."""
    wrong = _facts(spark, d).withColumn("is_valid", F.col("concentration_ugm3").isNotNull())
    return quality.flagged_but_valid(wrong).select(*UPSERT_KEY, "is_negative", "is_implausible")


def q09_symmetric_difference(spark: SparkSession, d: str) -> DataFrame:
    """Daily rows that differ between the table and the engine's own daily dataset without the readings of zero, after rounding to six decimals."""
    columns = ["station_id", "pollutant_id", "measurement_date", "daily_mean_ugm3", "valid_measurements"]
    own = models.daily_measurements(_facts(spark, d).where("not is_zero"), CONFIG).select(*columns)
    return relational.symmetric_difference(own, _daily(spark, d).select(*columns)).select("station_id", "pollutant_id", "measurement_date", "side")


def x01_distinct(spark: SparkSession, d: str) -> DataFrame:
    served = serving.Marts(spark, {"mart_data_completeness": _daily(spark, d).select("pollutant_code", "measurement_date")})
    return served.distinct("mart_data_completeness", "pollutant_code")


def _served(spark: SparkSession, mart: str, df: DataFrame) -> serving.Marts:
    return serving.Marts(spark, {mart: df})


def x02_exceedances(spark: SparkSession, d: str) -> DataFrame:
    return _served(spark, "mart_exceedances_yearly", m12_exceedances_yearly(spark, d)).exceedances("hourly_mean", None, (2025, 2026))


def x03_pollutant_trend(spark: SparkSession, d: str) -> DataFrame:
    return _served(spark, "mart_pollutant_trend", m14_pollutant_trend(spark, d)).pollutant_trend("NO2", None, (2025, 2026))


def x04_traffic_vs_background(spark: SparkSession, d: str) -> DataFrame:
    """The first place that has the pollutant, over a period."""
    months = m15_traffic_vs_background(spark, d)
    first = months.where("pollutant_code = 'PM10'").agg(F.min("municipality").alias("m")).first().m
    return _served(spark, "mart_traffic_vs_background", months).traffic_vs_background("PM10", first or "", (date(2025, 1, 1), date(2026, 12, 31)))


def x05_weather_correlation(spark: SparkSession, d: str) -> DataFrame:
    return _served(spark, "mart_weather_correlation", m16_weather_correlation(spark, d)).weather_correlation(None, ["spring", "summer"])


def x06_completeness(spark: SparkSession, d: str) -> DataFrame:
    """One series of completeness over a period; the station is given by its number in place of its name."""
    grid = m13_data_completeness(spark, d).withColumn("station_name", F.col("station_id").cast("string"))
    return _served(spark, "mart_data_completeness", grid).completeness("9100001", ["PM10", "O3"], (date(2026, 5, 1), date(2026, 6, 15)))


def x09_export_exceedances(spark: SparkSession, d: str) -> DataFrame:
    return serving.export_rows(_served(spark, "mart_exceedances_yearly", _exceedances(spark, d)), "exceedances.json")


def x10_export_trend(spark: SparkSession, d: str) -> DataFrame:
    return serving.export_rows(_served(spark, "mart_pollutant_trend", _trend(spark, d)), "pollutant-trend.json")


def x11_export_traffic(spark: SparkSession, d: str) -> DataFrame:
    """From means rounded to six decimals, as those of two stations often end in a half of the third."""
    return serving.export_rows(_served(spark, "mart_traffic_vs_background", m15_traffic_vs_background(spark, d)), "traffic-vs-background.json")


def x12_export_correlation(spark: SparkSession, d: str) -> DataFrame:
    return serving.export_rows(_served(spark, "mart_weather_correlation", _correlation(spark, d)), "weather-correlation.json")


def x13_export_completeness(spark: SparkSession, d: str) -> DataFrame:
    return serving.export_rows(_served(spark, "mart_data_completeness", _completeness(spark, d)), "completeness-monthly.json")


def x07_date_range(spark: SparkSession, d: str) -> DataFrame:
    return _daily(spark, d).agg(F.min("measurement_date").alias("first"), F.max("measurement_date").alias("last"))


def x19_loaded_days(spark: SparkSession, d: str) -> DataFrame:
    """Local days with any measurement of the fact and any row of the feed: the intersection of two sets of days."""
    facts = serving.loaded_days(_facts(spark, d), "measured_at_utc", CONFIG.local_utc_offset_hours)
    archive = serving.loaded_days(table(spark, d, "int_o3_8h_rolling"), "measured_at_utc", 0)
    return facts.intersect(archive)


def x22_missing_months(spark: SparkSession, d: str) -> DataFrame:
    loaded = serving.loaded_days(table(spark, d, "stg_arpae__measurements"), "measured_at_utc", CONFIG.local_utc_offset_hours)
    return serving.missing_months(spark, date(2026, 3, 10), date(2026, 9, 14), loaded, 12)


def x24_freshness(spark: SparkSession, d: str) -> DataFrame:
    """The verdict on the fact's age at a fixed instant."""
    now = F.lit("2026-07-02 00:00:00").cast("timestamp")
    verdict = serving.freshness(_facts(spark, d), "measured_at_utc", now, CONFIG.raw_freshness_hours)
    return verdict.select("newest", F.round("age_hours", 6).alias("age_hours"), "passed")


def x25_recent_completeness(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(serving.completeness_verdict(marts.data_completeness(_daily(spark, d), _stations(spark, d)), CONFIG.completeness_days, CONFIG.min_recent_completeness))


def w01_source_precedence(spark: SparkSession, d: str) -> DataFrame:
    """First row per key by a priority: lineitem's repeated keys, even parts before odd ones."""
    lines = table(spark, d, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    rest = [c for c in lines.columns if c not in keys]
    return relational.first_per_key(lines, keys, [F.pmod("l_partkey", F.lit(2)), *(F.col(c) for c in rest)]).select(*keys, "l_partkey", "l_quantity")


def o02_sorted_top(spark: SparkSession, d: str) -> DataFrame:
    """A report: the ten days with the highest daily maxima of nitrogen dioxide."""
    days = _daily(spark, d).where((F.col("pollutant_code") == "NO2") & F.col("daily_max_ugm3").isNotNull())
    return days.orderBy(F.desc("daily_max_ugm3"), "station_id", "measurement_date").limit(10).select("station_id", "measurement_date", "daily_max_ugm3")


def o04_tagged_union(spark: SparkSession, d: str) -> DataFrame:
    parts = {"fact": _facts(spark, d).select("station_id", "pollutant_id", "source_name"), "feed": table(spark, d, "stg_arpae__measurements").select("station_id", "pollutant_id")}
    return relational.union_tagged(parts, "origin").groupBy("origin", "source_name", "pollutant_id").agg(F.count(F.lit(1)).alias("rows"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        s05_archive_stamps, s07_archive_records, s09_station_registry, s10_station_types, s11_weather, s14_weather_locations, f01_unit_conversion, f06_location_id, f10_calendar, f16_unpivot,
        pred04_latest_snapshot, pred05_incremental_scope, pred06_reprocess_scope, m01_staged_measurements, m02_staged_stations, m04_staged_weather, m06_measurements_deduplicated, m06_incremental,
        m07_measurements_daily, m08_o3_8h_rolling, m09_stations_current, m10_station_types_current, m11_weather_daily, m12_exceedances_yearly, m13_data_completeness, m14_pollutant_trend,
        m15_traffic_vs_background, m16_weather_correlation, k01_upsert, k09_scd2, k11_monthly_completeness, q01_duplicates, q02_orphans, q02_nulls, q02_unaccepted, q03_correlations,
        q04_inconsistent_days, q05_inconsistent_exceedances, q06_flagged_but_valid, q07_missing_kinds, q08_implausible, q08_negative, q08_stale_types, q09_symmetric_difference, x01_distinct,
        x02_exceedances, x03_pollutant_trend, x04_traffic_vs_background, x05_weather_correlation, x06_completeness, x07_date_range, x09_export_exceedances, x10_export_trend, x11_export_traffic,
        x12_export_correlation, x13_export_completeness, x19_loaded_days, x22_missing_months, x24_freshness, x25_recent_completeness, w01_source_precedence, o02_sorted_top, o04_tagged_union,
    )
}
