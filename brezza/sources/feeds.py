"""Parsers of the source formats, as expressions over DataFrames of texts.  Whatever cannot be read is an error that names its place."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brezza.config import DateWindow
from brezza.functions.quality_flags import location_id, station_code
from brezza.functions.temporal import add_hours

# The formats of the sources.
_ARCHIVE_HEADER = "COD_STAZ,ID_PARAM,DATA_INIZIO,DATA_FINE,VALORE,UM"
_ARCHIVE_TIME = r"^\d\d/\d\d/\d{4} ([01]\d|2[0-4])$"
_PAGE = """struct<_items: array<struct<_id: string, station_id: string, parameter_id: string, reftime: string, value: double, parameter_unit: string,
validity: string>>, _meta: struct<total: bigint>>"""
_TYPES_PAGE = "struct<_items: array<struct<_id: string, nome: string, sigla_provincia: string, tipo_stazione: string, zona: string, _updated: string>>, _meta: struct<total: bigint>>"
_WEATHER_FIELDS = {
    "temperature_2m": "temperature_c", "precipitation": "precipitation_mm", "wind_speed_10m": "wind_speed_ms",
    "wind_direction_10m": "wind_direction_deg", "surface_pressure": "surface_pressure_hpa",
}


def or_fail(value: Column, *message: Column | str) -> Column:
    """The value, or an error with the message where it is null."""
    parts = [m if isinstance(m, Column) else F.lit(m) for m in message]
    return F.when(value.isNotNull(), value).otherwise(F.raise_error(F.concat(*(F.coalesce(p.cast("string"), F.lit("null")) for p in parts))))


def archive_files(spark: SparkSession, root: str, window: DateWindow) -> list[str]:
    """The yearly CSV files (plain or gzip) in folders ``..._<year>`` whose year the window touches, sorted; others are not listed.

    ``root`` is a path of any file system that the session knows.
    """
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(root)
    system = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def inside(folder: Any) -> list[Any]:
        return sorted(system.listStatus(folder), key=lambda status: status.getPath().getName())

    found = []
    for folder in inside(top):
        year = folder.getPath().getName().rsplit("_", 1)[-1]
        if folder.isDirectory() and year.isdigit() and window.within_year(int(year)):
            found += [f.getPath().toString() for f in inside(folder.getPath()) if f.getPath().getName().endswith((".csv", ".csv.gz"))]
    return found


def parse_archive_rows(cells: DataFrame, utc_offset_hours: int) -> DataFrame:
    """All columns and ``station_id, pollutant_id, period_start, period_end, value, measured_at, problem`` of rows of the archive's six text columns.

    Times are a local day and an hour from 00 to 24, where hour 24 is the end of its day.  An interval of a day or more is stamped with its start, a
    shorter one with its end.  ``problem`` is null, or the first of ``station``, ``parameter``, ``time``, ``value`` and ``interval`` that cannot be read;
    then ``measured_at`` is null.
    """

    def moment(column: str) -> Column:
        text = F.trim(column)
        day = F.try_to_timestamp(F.substring(text, 1, 10), F.lit("dd/MM/yyyy")).cast("timestamp_ntz")
        return F.when(text.rlike(_ARCHIVE_TIME), add_hours(day, F.substring(text, 12, 2).try_cast("int")))

    read = cells.select(
        "*",
        station_code(F.col("cod_staz")).alias("station_id"),
        F.trim(F.col("id_param").cast("string")).try_cast("bigint").alias("pollutant_id"),
        moment("data_inizio").alias("period_start"),
        moment("data_fine").alias("period_end"),
        F.trim("valore").try_cast("double").alias("value"),
    )
    minutes = F.timestamp_diff("MINUTE", F.col("period_start"), F.col("period_end"))
    problem = (
        F.when(F.col("station_id").isNull(), "station")
        .when(F.col("pollutant_id").isNull(), "parameter")
        .when(minutes.isNull(), "time")
        .when(F.col("value").isNull(), "value")
        .when(minutes <= 0, "interval")
    )
    local = F.when(minutes >= 1440, F.col("period_start")).otherwise(F.col("period_end"))
    stamped = read.withColumn("problem", problem)
    return stamped.withColumn("measured_at", F.when(F.col("problem").isNull(), add_hours(local, -utc_offset_hours).cast("timestamp")))


def read_archive(spark: SparkSession, files: Sequence[str], utc_offset_hours: int, window: DateWindow | None = None) -> DataFrame:
    """Raw measurements of yearly CSV files, which are split like any others (see ``parse_archive_rows`` for the stamps).

    With a window, only values whose period begins on one of its local days are kept.  A file with another header, or a row that cannot be read, is
    an error that names file and row.
    """
    if not files:
        from brezza.schemas import ARCHIVE

        return spark.createDataFrame([], ARCHIVE.schema)
    names = _ARCHIVE_HEADER.split(",")
    schema = ", ".join(f"{name} string" for name in names)
    raw = spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(list(files))
    cells = raw.select(F.col("_metadata.file_name").alias("_file"), *(F.col(name).alias(name.lower()) for name in names))
    read = parse_archive_rows(cells, utc_offset_hours)
    row = F.concat_ws(",", *(F.coalesce(name.lower(), F.lit("")) for name in names))
    complaint = F.concat(F.col("_file"), F.lit(": "), F.col("problem"), F.lit(" of row "), row)
    station = F.when(F.col("problem").isNull(), F.col("station_id")).otherwise(F.raise_error(complaint).cast("bigint"))
    checked = read.select(station.alias("station_id"), "pollutant_id", "period_start", "measured_at", "value", F.nullif(F.trim("um"), F.lit("")).alias("unit"), F.concat_ws("/", F.trim("data_inizio"), F.trim("data_fine")).alias("raw_reftime"))
    if window is not None:
        checked = checked.where(F.col("station_id").isNotNull() & F.to_date("period_start").between(window.first, window.last))
    return checked.select("station_id", "pollutant_id", "measured_at", "value", "unit", F.lit(None).cast("string").alias("validation_flag"), "raw_reftime")


def parse_measurement_pages(
    pages: DataFrame, body: str, stations: DataFrame, pollutants: DataFrame, daily: Iterable[int], window: DateWindow | None = None, problems: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(raw measurements, archive numbers of stations that have no id) of JSON pages.

    ``stations`` and ``pollutants`` map ``archive_id`` to ``id``.  The archive stamps hours at their start and days at their end; both are
    moved to the opposite.  Records of unknown stations are left out, an unknown parameter or an unreadable time is an error.  With ``problems``
    such records are kept instead, with a null stamp, and each record has its ``record_id`` and ``problem`` (``parameter``, ``time`` or null).
    """
    items = pages.select(F.inline(or_fail(F.from_json(body, _PAGE)["_items"], "a page is not the expected JSON")))
    known = items.join(stations.select(F.col("archive_id").alias("station_id"), F.col("id").alias("_station")), "station_id", "left")
    unmapped = known.where(F.col("_station").isNull()).select("station_id").distinct()
    mapped = known.where(F.col("_station").isNotNull()).join(
        pollutants.select(F.col("archive_id").alias("parameter_id"), F.col("id").alias("_pollutant")), "parameter_id", "left"
    )
    place = (F.lit("record "), F.col("_id"), F.lit(": "))

    def demanded(value: Column, *message: Column | str) -> Column:
        return value if problems else or_fail(value, *place, *message)

    pollutant = demanded(F.col("_pollutant"), "parameter_id ", F.col("parameter_id"))
    offset = F.regexp_extract("reftime", r"(Z|[+-]\d\d:\d\d)$", 1)
    stated = demanded(F.when(offset != "", F.try_to_timestamp("reftime")), "reftime ", F.col("reftime"))
    is_daily = F.col("pollutant_id").isin(list(daily))
    read = mapped.select(F.col("_station").alias("station_id"), pollutant.alias("pollutant_id"), stated.alias("_stated"), "value", F.col("parameter_unit").alias("unit"), F.col("validity").alias("validation_flag"), F.col("reftime").alias("raw_reftime"), F.col("_id").alias("record_id"))
    local = F.try_to_timestamp(F.substring("raw_reftime", 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    begins = F.when(is_daily, local - F.expr("interval 1 day")).otherwise(local)
    moved = F.when(is_daily, F.col("_stated") - F.expr("interval 1 day")).otherwise(F.col("_stated") + F.expr("interval 1 hour"))
    if window is not None:
        read = read.where(F.to_date(begins).between(window.first, window.last))
    kept = read.select("station_id", "pollutant_id", moved.alias("measured_at"), "value", "unit", "validation_flag", "raw_reftime", "record_id")
    if not problems:
        return kept.drop("record_id"), unmapped
    problem = F.when(F.col("pollutant_id").isNull(), "parameter").when(F.col("measured_at").isNull(), "time")
    return kept.withColumn("problem", problem).withColumn("measured_at", F.when(F.col("problem").isNull(), F.col("measured_at"))), unmapped


def measurement_filter(window: DateWindow, parameters: Sequence[str], offset: str = "+01:00") -> dict:
    """The service's filter for values from the first midnight of the window to the midnight after its last day."""
    from datetime import timedelta

    bounds = {"$gte": f"{window.first}T00:00:00{offset}", "$lte": f"{window.last + timedelta(days=1)}T00:00:00{offset}"}
    return {"reftime": bounds, "parameter_id": {"$in": list(parameters)}}


def read_station_registry(spark: SparkSession, path: str) -> DataFrame:
    """Sensors of the registry CSV, one row per station and pollutant; a station code that is no number is an error."""
    return parse_station_registry(spark.read.option("header", True).csv(path))


def parse_station_registry(raw: DataFrame) -> DataFrame:
    place = (F.lit("registry: station "), F.col("Cod_staz"))
    return raw.select(
        or_fail(station_code(F.col("Cod_staz")), *place).alias("station_id"),
        F.trim("Stazione").alias("station_name"),
        F.trim("COMUNE").alias("municipality"),
        F.trim("PROVINCIA").alias("province"),
        F.trim("INDIRIZZO").alias("address"),
        F.col("Altezza").try_cast("double").alias("altitude_m"),
        F.col("LON_GEO").try_cast("double").alias("longitude"),
        F.col("LAT_GEO").try_cast("double").alias("latitude"),
        or_fail(F.col("Id_Param").try_cast("bigint"), *place, ": parameter").alias("pollutant_id"),
        F.trim("PARAMETRO").alias("pollutant_name"),
        F.trim("UM").alias("unit"),
    )


def parse_station_types(pages: DataFrame, body: str) -> DataFrame:
    """Station types of the type registry; a page that is empty or lacks some of its stations is an error.

    The label is area and exposure without blanks; ``bulletin_id`` is the day of the last change as ``yyyyMMdd``.
    """
    page = F.from_json(body, _TYPES_PAGE)
    whole = pages.select(page.alias("_p")).select(
        or_fail(F.when((F.size("_p._items") > 0) & (F.size("_p._items") == F.col("_p._meta.total")), F.col("_p._items")), "the type registry is incomplete").alias("_items")
    )

    def text(name: str) -> Column:
        return F.nullif(F.trim(name), F.lit(""))

    changed = F.try_to_timestamp(F.substring("_updated", 6, 100), F.lit("dd MMM yyyy HH:mm:ss z"))
    return whole.select(F.inline("_items")).select(
        or_fail(station_code(F.col("_id")), F.lit("type registry: station "), F.col("_id")).alias("station_id"),
        F.trim("nome").alias("station_name"),
        F.trim("sigla_provincia").alias("province"),
        F.concat_ws(" ", text("zona"), text("tipo_stazione")).alias("type_label"),
        F.date_format(or_fail(changed, F.lit("type registry: _updated "), F.col("_updated")), "yyyyMMdd").alias("bulletin_id"),
    )


def weather_locations(stations: DataFrame, decimals: int) -> DataFrame:
    """``location_id, latitude, longitude`` of the grid cells that hold a station, by the first station in each; no cell without finite coordinates."""
    cell = location_id(F.col("latitude"), F.col("longitude"), decimals)
    placed = stations.select(cell.alias("location_id"), "latitude", "longitude").where(F.col("location_id").isNotNull())
    first = placed.groupBy("location_id").agg(F.min(F.struct("latitude", "longitude")).alias("_at"))
    return first.select("location_id", "_at.latitude", "_at.longitude").orderBy("location_id")


def weather_variables() -> str:
    """The hourly variables to ask the weather service for."""
    return ",".join(_WEATHER_FIELDS)


def chunks(values: Sequence, size: int = 10) -> Iterator[Sequence]:
    """Requests hold at most ``size`` locations."""
    return (values[k : k + size] for k in range(0, len(values), size))


def parse_weather(responses: DataFrame, body: str, locations: str) -> DataFrame:
    """Hourly weather of answers with one location (an object) or several (a list), in the order of ``locations``, an array of
    ``location_id, latitude, longitude``.  Another offset than UTC, series of unequal length or another number of locations is an error.
    Hours without any value are left out.
    """
    series = ", ".join(f"{name}: array<double>" for name in _WEATHER_FIELDS)
    one = f"struct<latitude: double, longitude: double, utc_offset_seconds: int, hourly: struct<time: array<string>, {series}>>"
    text = F.trim(body)
    answers = F.from_json(F.when(text.startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]"))), f"array<{one}>")
    each = _each(responses, answers, F.col(locations))
    equal = [F.size(F.col("a.hourly")[name]) == F.size("a.hourly.time") for name in _WEATHER_FIELDS]
    sound = F.col("a.utc_offset_seconds") == 0
    for e in equal:
        sound = sound & e
    zipped = F.arrays_zip(F.col("a.hourly.time").alias("time"), *(F.col("a.hourly")[n].alias(n) for n in _WEATHER_FIELDS))
    hours = each.select("l", "a.latitude", "a.longitude", or_fail(F.when(sound, zipped), "weather of ", F.col("l.location_id"), " is not in UTC or has series of unequal length").alias("_h"))
    flat = hours.select(F.col("l.location_id"), F.col("l.latitude"), F.col("l.longitude"), F.col("latitude").alias("grid_latitude"), F.col("longitude").alias("grid_longitude"), F.explode("_h").alias("_h"))
    named = [F.col("_h")[name].alias(column) for name, column in _WEATHER_FIELDS.items()]
    at = or_fail(F.try_to_timestamp(F.col("_h")["time"], F.lit("yyyy-MM-dd'T'HH:mm")), "weather time ", F.col("_h")["time"])
    return flat.where(F.coalesce(*(F.col("_h")[n] for n in _WEATHER_FIELDS)).isNotNull()).select("location_id", "latitude", "longitude", "grid_latitude", "grid_longitude", at.alias("observed_at"), *named)


def _each(responses: DataFrame, answers: Column, asked: Column) -> DataFrame:
    """``a, l``: each answer with the location that was asked for."""
    both = responses.select(answers.alias("_a"), asked.alias("_l"))
    checked = both.select(or_fail(F.when(F.size("_a") == F.size("_l"), F.col("_a")), "the answer has another number of locations").alias("_a"), "_l")
    return checked.select("_l", F.posexplode("_a").alias("_k", "a")).select("a", F.get("_l", F.col("_k")).alias("l"))
