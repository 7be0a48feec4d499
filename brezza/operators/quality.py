"""Data-quality checks: each gives the rows that fail it, and is of a severity."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from enum import StrEnum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Severity(StrEnum):
    ERROR = "error"
    WARN = "warn"


@dataclass(frozen=True)
class Check:
    name: str
    failing: Callable[[], DataFrame]
    severity: Severity = Severity.ERROR


@dataclass(frozen=True)
class Outcome:
    name: str
    severity: Severity
    failures: int

    @property
    def passed(self) -> bool:
        return self.failures == 0


def run_checks(checks: Sequence[Check]) -> list[Outcome]:
    """The number of failing rows of each check; the build stops on errors, warnings are reported."""
    return [Outcome(c.name, c.severity, c.failing().count()) for c in checks]


def duplicates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations that occur more than once, with their number."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def nulls(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unaccepted(df: DataFrame, column: str, accepted: Sequence) -> DataFrame:
    """Values outside the accepted ones, with their number; null is no value."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(accepted))).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose non-null reference is not in the parent."""
    return child.where(F.col(column).isNotNull()).join(parent.select(F.col(parent_column).alias(column)), column, "left_anti")


def violations(df: DataFrame, rule: Column) -> DataFrame:
    """Rows that break a rule; a rule that is null is not broken."""
    return df.where(~rule)


def correlations_out_of_range(df: DataFrame, columns: Sequence[str], tolerance: float = 1e-7) -> DataFrame:
    return violations(df, F.greatest(*(F.abs(c) for c in columns), F.lit(0.0)) <= 1 + tolerance)


def inconsistent_days(daily: DataFrame) -> DataFrame:
    """Days with more measurements than expected or a negative mean."""
    return violations(daily, (F.col("measurements") <= F.col("expected_measurements")) & F.coalesce(F.col("daily_mean_ugm3") >= 0, F.lit(True)))


def inconsistent_exceedances(yearly: DataFrame) -> DataFrame:
    return violations(yearly, (F.col("exceedances") <= F.col("valid_periods")) & (F.col("year_coverage") <= 1))


def flagged_but_valid(facts: DataFrame) -> DataFrame:
    return facts.where(F.col("is_valid") & (F.col("is_negative") | F.col("is_implausible")))


def missing_kinds(types: DataFrame, column: str, wanted: Sequence[str]) -> DataFrame:
    """The wanted kinds that no row has."""
    expected = types.sparkSession.createDataFrame([(w,) for w in wanted], f"{column} string")
    return expected.join(types.select(column), column, "left_anti")


def flagged(facts: DataFrame, flag: str) -> DataFrame:
    """Readings that are kept with a flag (``is_implausible``, ``is_negative``): a warning that only shows them."""
    return facts.where(F.col(flag)).select("station_id", "pollutant_id", "measured_at_utc", "concentration_ugm3")


def stale_types(types: DataFrame) -> DataFrame:
    """Stations whose type comes from an earlier snapshot or the reference, as the latest one does not state it: a warning."""
    return types.where(F.col("station_type_source").isin("earlier_snapshot", "reference")).select("station_id", "station_type", "station_type_source", "type_label_original")
