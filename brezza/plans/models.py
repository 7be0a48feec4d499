"""The datasets from staging to the intermediate layer, each a function from DataFrames to a lazy DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brezza.config import EngineConfig
from brezza.functions import quality_flags as Q
from brezza.functions.temporal import add_hours, local_day, to_naive_utc
from brezza.operators.relational import delete_insert, first_per_key, incremental_scope, latest_per_key, union_tagged

FACT_KEY = ["station_id", "pollutant_id", "measured_at_utc"]
FACT_COLUMNS = [
    "station_id", "pollutant_id", "pollutant_code", "averaging_minutes", "measured_at_utc", "period_start_utc", "measurement_date", "concentration_ugm3",
    "value_original", "unit_original", "validation_flag", "source_name", "is_negative", "is_zero", "is_implausible", "is_valid",
]
SOURCE_PRIORITY = {"archive": 1, "near_real_time": 2}


def stage_measurements(raw: DataFrame) -> DataFrame:
    """Raw measurements with final names and types and the concentration for plainly spelled units."""
    return raw.select(
        F.col("station_id").cast("int").alias("station_id"),
        F.col("pollutant_id").cast("int").alias("pollutant_id"),
        to_naive_utc(F.col("measured_at")).alias("measured_at_utc"),
        Q.to_ugm3(F.col("value"), F.col("unit")).alias("concentration_ugm3"),
        F.col("value").alias("value_original"),
        F.col("unit").alias("unit_original"),
        "validation_flag",
    )


def stage_stations(raw: DataFrame) -> DataFrame:
    """The newest snapshot of the station registry."""
    newest = raw.agg(F.max("extracted_on").alias("_day"))
    latest = raw.where(F.col("extracted_on") == newest.scalar())
    ids = [F.col(c).cast("int").alias(c) for c in ("station_id", "pollutant_id")]
    rest = [c for c in raw.columns if c not in ("station_id", "pollutant_id", "unit")]
    return latest.select(*ids, *rest, F.col("unit").alias("unit_original"))


def stage_station_types(raw: DataFrame) -> DataFrame:
    """Station types with exposure and area read from their labels; null where the label does not tell."""
    return raw.select(
        F.col("station_id").cast("int").alias("station_id"),
        F.col("station_name").alias("bulletin_station_name"),
        "province",
        Q.station_type_of(F.col("type_label")).alias("station_type"),
        Q.area_type_of(F.col("type_label")).alias("area_type"),
        F.col("type_label").alias("type_label_original"),
        "bulletin_id",
        "extracted_on",
    )


def stage_weather(raw: DataFrame) -> DataFrame:
    measured = ["temperature_c", "precipitation_mm", "wind_speed_ms", "wind_direction_deg", "surface_pressure_hpa"]
    return raw.select("location_id", to_naive_utc(F.col("observed_at")).alias("observed_at_utc"), *measured)


def deduplicated_measurements(
    sources: dict[str, DataFrame], pollutants: DataFrame, config: EngineConfig, loaded: DataFrame | None = None, reprocess_from: Column | None = None, merge: bool = True
) -> DataFrame:
    """The fact: one row per natural key from the source of best priority, with its period, local day and flags.

    ``sources`` are staged tables by name.  With the ``loaded`` fact, the rows in scope of an incremental run replace theirs in it; an
    empty one means all rows; without ``merge`` only the rows in scope come out.  Hourly values are stamped at the end of their hour, daily ones at the start of their day.
    """
    united = union_tagged(sources, "source_name")
    if loaded is not None:
        archived = F.col("source_name") == "archive"
        united = incremental_scope(united, loaded, "measured_at_utc", FACT_KEY, config.lookback_days, archived, reprocess_from)
    priority = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for p in SOURCE_PRIORITY.items() for x in p)), F.col("source_name")), F.lit(99))
    order = [priority, F.xxhash64("concentration_ugm3", "value_original", "unit_original", "validation_flag")]
    chosen = first_per_key(united.dropna(subset=FACT_KEY), FACT_KEY, order)
    dimension = pollutants.select("pollutant_id", "pollutant_code", "averaging_minutes", "max_plausible_ugm3")
    known = chosen.join(dimension, "pollutant_id", "left")
    start = F.when(F.col("averaging_minutes") == 60, add_hours(F.col("measured_at_utc"), -1)).otherwise(F.col("measured_at_utc"))
    dated = known.withColumn("period_start_utc", start).withColumn("measurement_date", local_day(F.col("period_start_utc"), config.local_utc_offset_hours))
    fact = dated.withColumns(Q.flags(F.col("concentration_ugm3"), F.col("max_plausible_ugm3"))).select(*FACT_COLUMNS)
    return fact if loaded is None or not merge else delete_insert(loaded, fact, FACT_KEY)


def scope_of(loaded: DataFrame) -> DataFrame:
    """What an incremental run needs to know of the loaded fact."""
    return loaded.select(*FACT_KEY, "source_name")


def daily_measurements(facts: DataFrame, config: EngineConfig) -> DataFrame:
    """Mean, maximum, counts and coverage per series and local day.  A day is valid from ``min_coverage`` on."""
    valid = F.when(F.col("is_valid"), F.col("concentration_ugm3"))
    keys = ["station_id", "pollutant_id", "pollutant_code", "averaging_minutes", "measurement_date"]
    days = facts.groupBy(*keys).agg(
        F.avg(valid).alias("daily_mean_ugm3"),
        F.max(valid).alias("daily_max_ugm3"),
        F.count(F.lit(1)).alias("measurements"),
        F.count(F.when(F.col("is_valid"), 1)).alias("valid_measurements"),
    )
    expected = F.floor(F.lit(1440) / F.col("averaging_minutes")).cast("int")
    covered = days.withColumn("expected_measurements", expected).withColumn("coverage", F.col("valid_measurements") / F.col("expected_measurements"))
    return covered.withColumn("is_valid_day", F.col("coverage") >= config.min_coverage)


def rolling_means(facts: DataFrame, config: EngineConfig) -> DataFrame:
    """Means over trailing hours for every hour of every local day from the first to the last day of a series with a valid value.

    A window counts the valid hours among its ``rolling_hours`` and is valid from ``min_coverage`` of them on.  Each month of a series
    is a task of its own: the few hours that reach over a month's end are also given to the next one.
    """
    hours = config.rolling_hours
    valid = facts.where("is_valid").select("station_id", "pollutant_id", "pollutant_code", "measured_at_utc", "measurement_date", "concentration_ugm3")
    own = ["station_id", "pollutant_id", "pollutant_code"]
    spans = valid.groupBy(*own).agg(F.min("measurement_date").alias("first"), F.max("measurement_date").alias("last"))
    day = F.explode(F.sequence("first", "last")).alias("measurement_date")
    ends = F.explode(F.sequence(F.lit(1), F.lit(24))).alias("_hour")
    grid = spans.select(*own, day).select(*own, "measurement_date", ends)
    stamp = add_hours(F.col("measurement_date").cast("timestamp_ntz"), F.col("_hour") - config.local_utc_offset_hours)
    grid = grid.select(*own, "measurement_date", stamp.alias("measured_at_utc"), F.lit(None).cast("double").alias("_value"))
    readings = valid.select(*own, F.lit(None).cast("date").alias("measurement_date"), "measured_at_utc", F.col("concentration_ugm3").alias("_value"))
    both = grid.unionByName(readings).groupBy(*own, "measured_at_utc").agg(F.max("measurement_date").alias("measurement_date"), F.max("_value").alias("_value"))
    months = F.array_distinct(F.array(F.trunc("measured_at_utc", "month"), F.trunc(add_hours(F.col("measured_at_utc"), hours - 1), "month")))
    dealt = both.select("*", F.explode(months).alias("_month"))
    at = F.unix_seconds(F.col("measured_at_utc").cast("timestamp"))
    window = Window.partitionBy(*own, "_month").orderBy(at).rangeBetween(-(hours - 1) * 3600, 0)
    rolled = dealt.select(
        *own,
        "measured_at_utc",
        "measurement_date",
        "_month",
        F.avg("_value").over(window).alias("rolling_8h_mean_ugm3"),
        F.count("_value").over(window).alias("valid_hours_in_window"),
    )
    kept = rolled.where((F.col("_month") == F.trunc("measured_at_utc", "month")) & F.col("measurement_date").isNotNull()).drop("_month")
    return kept.withColumn("is_valid_window", F.col("valid_hours_in_window") / hours >= config.min_coverage)


def current_sensors(snapshots: DataFrame, keys: list[str], day: str, loaded: str) -> DataFrame:
    """The rows that are open in the history of dated full snapshots, without working it out: those of the newest one, of each key the latest loaded."""
    newest = snapshots.agg(F.max(day).alias("_day"))
    return latest_per_key(snapshots.where(F.col(day) == newest.scalar()).dropna(subset=keys), keys, loaded).withColumn("valid_to", F.lit(None).cast("date"))


def current_stations(versions: DataFrame, types: DataFrame, config: EngineConfig) -> DataFrame:
    """Stations of the open versions of the registry, and those that only the type registry knows, with their weather location."""
    attributes = ["station_id", "station_name", "municipality", "province", "address", "altitude_m", "longitude", "latitude"]
    registry = versions.where(F.col("valid_to").isNull()).select(*attributes).distinct()
    others = latest_per_key(types, ["station_id"], "extracted_on").join(registry.select("station_id").distinct(), "station_id", "left_anti")
    others = others.select("station_id", F.col("bulletin_station_name").alias("station_name"), "province")
    united = registry.unionByName(others, allowMissingColumns=True)
    return united.withColumn("weather_location_id", Q.location_id(F.col("latitude"), F.col("longitude"), config.weather_coordinate_decimals))


def current_station_types(types: DataFrame, reference: DataFrame) -> DataFrame:
    """Type and area of each station: from its latest snapshot, else the latest that states an exposure, else the reference."""
    latest = latest_per_key(types, ["station_id"], "extracted_on")
    stated = latest_per_key(types.where(F.col("station_type").isNotNull()), ["station_id"], "extracted_on")
    stated = stated.select("station_id", F.col("station_type").alias("_stated"), F.col("area_type").alias("_stated_area"))
    known = reference.where(F.col("station_type") != "other").select("station_id", F.col("station_type").alias("_known"), F.col("area_type").alias("_known_area"))
    joined = latest.join(stated, "station_id", "left").join(known, "station_id", "left")
    origin = (
        F.when(F.col("station_type").isNotNull(), "latest_snapshot")
        .when(F.col("_stated").isNotNull(), "earlier_snapshot")
        .when(F.col("_known").isNotNull(), "reference")
        .otherwise("unknown")
    )
    return joined.select(
        "station_id",
        F.coalesce("_stated", "_known", F.lit("other")).alias("station_type"),
        F.coalesce("area_type", "_stated_area", "_known_area").alias("area_type"),
        origin.alias("station_type_source"),
        "type_label_original",
        "bulletin_id",
        "extracted_on",
    )


def daily_weather(hourly: DataFrame, config: EngineConfig) -> DataFrame:
    """Daily weather per location; a value stamped at the end of its hour belongs to the local day in which the hour begins."""
    day = F.to_date(add_hours(F.col("observed_at_utc"), config.local_utc_offset_hours - 1))
    days = hourly.groupBy("location_id", day.alias("weather_date")).agg(
        F.avg("wind_speed_ms").alias("wind_speed_mean_ms"),
        F.max("wind_speed_ms").alias("wind_speed_max_ms"),
        F.sum("precipitation_mm").alias("precipitation_mm"),
        F.avg("temperature_c").alias("temperature_mean_c"),
        F.avg("surface_pressure_hpa").alias("surface_pressure_mean_hpa"),
        F.count(F.when(F.col("wind_speed_ms").isNotNull() & F.col("precipitation_mm").isNotNull(), 1)).alias("hours"),
    )
    return days.withColumn("is_valid_day", F.col("hours") / 24 >= config.min_coverage)
