"""Stored datasets: columns, natural keys and layout."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from brezza.errors import SchemaError


def _columns(**types: str) -> T.StructType:
    """``name="type"`` nullable, ``name="type!"`` not."""
    return T.StructType([T.StructField(n, _TYPES[t.rstrip("!")], not t.endswith("!")) for n, t in types.items()])


_TYPES = {"bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(), "date": T.DateType(), "timestamp": T.TimestampType()}


@dataclass(frozen=True)
class Dataset:
    """A stored dataset; ``time`` is the column that its months are cut by, None for dated snapshots."""

    path: str
    schema: T.StructType
    key: tuple[str, ...]
    time: str | None


MEASUREMENTS = Dataset(
    "measurements",
    _columns(station_id="bigint!", pollutant_id="bigint!", measured_at="timestamp!", value="double!", unit="string", validation_flag="string", raw_reftime="string!"),
    ("station_id", "pollutant_id", "measured_at"),
    "measured_at",
)
ARCHIVE = Dataset("measurements_archive", MEASUREMENTS.schema, MEASUREMENTS.key, "measured_at")
WEATHER = Dataset(
    "weather",
    _columns(
        location_id="string!", latitude="double!", longitude="double!", grid_latitude="double!", grid_longitude="double!", observed_at="timestamp!",
        temperature_c="double", precipitation_mm="double", wind_speed_ms="double", wind_direction_deg="double", surface_pressure_hpa="double",
    ),
    ("location_id", "observed_at"),
    "observed_at",
)
STATIONS = Dataset(
    "stations",
    _columns(
        station_id="bigint!", station_name="string!", municipality="string!", province="string!", address="string!", altitude_m="double", longitude="double",
        latitude="double", pollutant_id="bigint!", pollutant_name="string!", unit="string!", extracted_on="date!",
    ),
    ("station_id", "pollutant_id"),
    None,
)
STATION_TYPES = Dataset(
    "station_types", _columns(station_id="bigint!", station_name="string!", province="string!", type_label="string!", bulletin_id="string!", extracted_on="date!"), ("station_id",), None
)
LIMITS_SCHEMA = _columns(pollutant_id="int!", pollutant_code="string!", metric="string!", limit_ugm3="double!", max_exceedances_per_year="int!", limit_type="string", legal_reference="string")
POLLUTANTS_SCHEMA = _columns(pollutant_id="int!", pollutant_code="string!", pollutant_name="string", averaging_minutes="int!", max_plausible_ugm3="double")
ARCHIVE_PARAMETERS_SCHEMA = _columns(pollutant_id="int!", averaging_minutes="int!", archive_parameter_id="string")
STATION_MAP_SCHEMA = _columns(archive_id="string!", id="bigint!")
TYPES_REFERENCE_SCHEMA = _columns(station_id="int!", station_type="string!", area_type="string", source_label="string", bulletin_id="string")


def check_schema(df: DataFrame, expected: T.StructType, what: str) -> DataFrame:
    """The expected columns in their order; a missing column or another type is an error, columns beyond them are left out."""
    actual = {f.name: f.dataType for f in df.schema}
    for f in expected:
        if f.name not in actual:
            raise SchemaError(f"{what}: column {f.name} is missing")
        if actual[f.name] != f.dataType:
            raise SchemaError(f"{what}: column {f.name} is {actual[f.name].simpleString()}, not {f.dataType.simpleString()}")
    return df.select(*expected.names)
