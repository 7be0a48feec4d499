"""Small dimensions that come with the engine or as CSV files with declared types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brezza import schemas

# Limits of the European air quality directive for the protection of health, with the pollutants' ids in the registry.
_LIMITS = [
    (5, "PM10", "daily_mean", 50.0, 35, "limit value", "Directive 2008/50/EC, annex XI"),
    (8, "NO2", "hourly_mean", 200.0, 18, "limit value", "Directive 2008/50/EC, annex XI"),
    (7, "O3", "daily_max_8h_mean", 120.0, 25, "target value", "Directive 2008/50/EC, annex VII"),
]


def air_quality_limits(spark: SparkSession, pollutants: DataFrame | None = None) -> DataFrame:
    """The limits.  With a dimension of pollutants their ids are taken from it, one row for each id of a code."""
    limits = spark.createDataFrame(_LIMITS, schemas.LIMITS_SCHEMA)
    if pollutants is None:
        return limits
    ids = pollutants.select(F.col("pollutant_id").cast("int").alias("pollutant_id"), "pollutant_code").distinct()
    return limits.drop("pollutant_id").join(ids, "pollutant_code").select(*schemas.LIMITS_SCHEMA.names)


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV file with a header; a value that does not fit its declared type is an error."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)
