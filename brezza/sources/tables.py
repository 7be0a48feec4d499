"""Scans of the Parquet tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brezza.session import prepare


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One table; timestamps are naive UTC."""
    prepare(spark)
    return spark.read.parquet(f"{directory}/{name}.parquet")
