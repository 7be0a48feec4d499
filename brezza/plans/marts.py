"""The marts, each a function from the intermediate datasets to a lazy DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brezza.config import EngineConfig
from brezza.functions.quality_flags import correlation
from brezza.functions.temporal import days_in_year, month_start, season

_NAMES = ["station_id", "station_name", "municipality"]


def limit_periods(daily: DataFrame, facts: DataFrame, rolling: DataFrame, config: EngineConfig) -> DataFrame:
    """The values that limits are compared with: daily means, hourly means, and daily maxima of the rolling means."""
    series = ["station_id", "pollutant_id"]
    means = daily.where("is_valid_day").select(*series, F.lit("daily_mean").alias("metric"), "measurement_date", F.col("daily_mean_ugm3").alias("value_ugm3"), F.lit(1).alias("periods_per_day"))
    hourly = facts.where(F.col("is_valid") & (F.col("averaging_minutes") == 60)).select(
        *series, F.lit("hourly_mean").alias("metric"), "measurement_date", F.col("concentration_ugm3").alias("value_ugm3"), F.lit(24).alias("periods_per_day")
    )
    maxima = (
        rolling.where("is_valid_window")
        .groupBy(*series, "measurement_date")
        .agg(F.max("rolling_8h_mean_ugm3").alias("value_ugm3"), F.count(F.lit(1)).alias("_windows"))
        .where(F.col("_windows") / 24 >= config.min_coverage)
        .select(*series, F.lit("daily_max_8h_mean").alias("metric"), "measurement_date", "value_ugm3", F.lit(1).alias("periods_per_day"))
    )
    return means.unionByName(hourly).unionByName(maxima)


def yearly_exceedances(daily: DataFrame, facts: DataFrame, rolling: DataFrame, limits: DataFrame, stations: DataFrame, config: EngineConfig) -> DataFrame:
    """How often each limit was exceeded per station and year; values are rounded to whole numbers before they are compared."""
    bounds = limits.select("pollutant_id", "pollutant_code", "metric", "limit_ugm3", "max_exceedances_per_year")
    periods = limit_periods(daily, facts, rolling, config).join(bounds, ["pollutant_id", "metric"])
    keys = ["station_id", "pollutant_id", "pollutant_code", "metric", "year", "limit_ugm3", "max_exceedances_per_year"]
    yearly = (
        periods.withColumn("year", F.year("measurement_date").cast("bigint"))
        .groupBy(*keys)
        .agg(
            F.count(F.when(F.round("value_ugm3") > F.col("limit_ugm3"), 1)).alias("exceedances"),
            F.count(F.lit(1)).alias("valid_periods"),
            F.max("value_ugm3").alias("max_value_ugm3"),
            F.max("periods_per_day").alias("_per_day"),
        )
    )
    named = yearly.join(stations.select(*_NAMES).dropDuplicates(["station_id"]), "station_id", "left")
    return named.select(
        *_NAMES,
        "pollutant_id",
        "pollutant_code",
        "metric",
        "year",
        "exceedances",
        "limit_ugm3",
        "max_exceedances_per_year",
        (F.col("exceedances") > F.col("max_exceedances_per_year")).alias("is_over_allowed_exceedances"),
        "max_value_ugm3",
        "valid_periods",
        (F.col("valid_periods") / (F.col("_per_day") * days_in_year(F.col("year")))).alias("year_coverage"),
    )


def data_completeness(daily: DataFrame, stations: DataFrame) -> DataFrame:
    """Completeness of each series on each day between its first and last one on which any series has a row."""
    series = ["station_id", "pollutant_id", "pollutant_code", "expected_measurements"]
    spans = daily.groupBy(*series).agg(F.min("measurement_date").alias("first"), F.max("measurement_date").alias("last"))
    loaded = daily.select("measurement_date").distinct()
    grid = spans.select(*series, F.explode(F.sequence("first", "last")).alias("measurement_date")).join(loaded, "measurement_date", "left_semi")
    seen = daily.select("station_id", "pollutant_id", "measurement_date", "measurements", "valid_measurements", "is_valid_day")
    joined = grid.join(seen, ["station_id", "pollutant_id", "measurement_date"], "left").join(stations.select(*_NAMES).dropDuplicates(["station_id"]), "station_id", "left")
    valid = F.coalesce("valid_measurements", F.lit(0))
    return joined.select(
        *_NAMES,
        "pollutant_id",
        "pollutant_code",
        "measurement_date",
        "expected_measurements",
        F.coalesce("measurements", F.lit(0)).alias("measurements"),
        valid.alias("valid_measurements"),
        (valid / F.col("expected_measurements")).alias("completeness"),
        F.coalesce("is_valid_day", F.lit(False)).alias("is_complete"),
    )


def pollutant_trend(daily: DataFrame, stations: DataFrame, config: EngineConfig) -> DataFrame:
    """Mean over the stations of a municipality of their yearly means; representative if the least covered station is."""
    keys = ["pollutant_id", "pollutant_code", "year"]
    yearly = (
        daily.where("is_valid_day")
        .withColumn("year", F.year("measurement_date").cast("bigint"))
        .groupBy("station_id", *keys)
        .agg(F.avg("daily_mean_ugm3").alias("_mean"), F.count(F.lit(1)).alias("_days"))
        .withColumn("_coverage", F.col("_days") / days_in_year(F.col("year")))
    )
    placed = yearly.join(stations.where(F.col("municipality").isNotNull()).select("station_id", "municipality"), "station_id")
    least = F.min("_coverage")
    return placed.groupBy("municipality", *keys).agg(
        F.count(F.lit(1)).alias("stations"),
        F.avg("_mean").alias("annual_mean_ugm3"),
        F.min("_mean").alias("min_station_mean_ugm3"),
        F.max("_mean").alias("max_station_mean_ugm3"),
        least.alias("min_year_coverage"),
        (least >= config.min_annual_coverage).alias("is_representative"),
    )


def traffic_vs_background(daily: DataFrame, types: DataFrame, stations: DataFrame) -> DataFrame:
    """Monthly means of traffic and background stations of a municipality, over the days that have both.

    The daily means of the two kinds are put side by side by one conditional aggregation instead of a self-join.
    """
    kinds = ("traffic", "background")
    typed = types.where(F.col("station_type").isin(*kinds)).select("station_id", "station_type")
    placed = daily.where("is_valid_day").join(typed, "station_id").join(stations.where(F.col("municipality").isNotNull()).select("station_id", "municipality"), "station_id")
    keys = ["municipality", "pollutant_id", "pollutant_code"]

    def of(kind: str, column: str) -> F.Column:
        return F.when(F.col("station_type") == kind, F.col(column))

    days = placed.groupBy(*keys, "measurement_date").agg(
        *(F.avg(of(k, "daily_mean_ugm3")).alias(k) for k in kinds), *(F.count(of(k, "station_id")).alias(f"{k}_n") for k in kinds)
    )
    both = days.where((F.col("traffic_n") > 0) & (F.col("background_n") > 0))
    months = both.groupBy(*keys, month_start(F.col("measurement_date")).alias("month")).agg(
        F.count(F.lit(1)).alias("days"),
        F.max("traffic_n").alias("traffic_stations"),
        F.max("background_n").alias("background_stations"),
        F.avg("traffic").alias("traffic_mean_ugm3"),
        F.avg("background").alias("background_mean_ugm3"),
    )
    return months.withColumn("difference_ugm3", F.col("traffic_mean_ugm3") - F.col("background_mean_ugm3")).withColumn(
        "traffic_to_background_ratio", F.try_divide("traffic_mean_ugm3", "background_mean_ugm3")
    )


def weather_correlation(daily: DataFrame, stations: DataFrame, weather: DataFrame, config: EngineConfig, pollutant: str = "PM10") -> DataFrame:
    """Per station and season: correlation of the daily mean with wind and precipitation, and means on windy, calm, rainy and dry days."""
    means = daily.where(F.col("is_valid_day") & (F.col("pollutant_code") == pollutant)).select("station_id", "measurement_date", F.col("daily_mean_ugm3").alias("_mean"))
    places = stations.where(F.col("weather_location_id").isNotNull()).select(*_NAMES, F.col("weather_location_id").alias("location_id"))
    days = weather.where("is_valid_day").select("location_id", F.col("weather_date").alias("measurement_date"), "wind_speed_mean_ms", "precipitation_mm")
    paired = means.join(places, "station_id").join(days, ["location_id", "measurement_date"])
    windy, rainy = F.col("wind_speed_mean_ms") >= config.windy_day_min_wind_ms, F.col("precipitation_mm") >= config.rainy_day_min_precipitation_mm
    mean = F.col("_mean")
    enough = F.count(F.lit(1)) >= config.min_days_for_correlation
    return paired.groupBy(*_NAMES, season(F.col("measurement_date")).alias("season")).agg(
        F.count(F.lit(1)).alias("days"),
        F.avg(mean).alias("pm10_mean_ugm3"),
        F.when(enough, correlation(mean, F.col("wind_speed_mean_ms"))).alias("corr_pm10_wind"),
        F.when(enough, correlation(mean, F.col("precipitation_mm"))).alias("corr_pm10_precipitation"),
        F.count(F.when(windy, 1)).alias("windy_days"),
        F.avg(F.when(windy, mean)).alias("pm10_mean_windy_ugm3"),
        F.avg(F.when(~windy, mean)).alias("pm10_mean_calm_ugm3"),
        F.count(F.when(rainy, 1)).alias("rainy_days"),
        F.avg(F.when(rainy, mean)).alias("pm10_mean_rainy_ugm3"),
        F.avg(F.when(~rainy, mean)).alias("pm10_mean_dry_ugm3"),
    )


def monthly_completeness(completeness: DataFrame) -> DataFrame:
    return completeness.groupBy(*_NAMES, "pollutant_code", month_start(F.col("measurement_date")).alias("month")).agg(
        F.count(F.lit(1)).alias("days"), F.count_if("is_complete").alias("complete_days"), F.avg("completeness").alias("completeness")
    )
