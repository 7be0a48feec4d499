"""Time arithmetic on naive UTC timestamps.  All of it assumes ``spark.sql.session.timeZone=UTC``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_DAY = "1970-01-01"
MICROS_PER_MINUTE = 60_000_000


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 UTC of a naive UTC timestamp."""
    return F.unix_micros(ts.cast("timestamp"))


def naive_from_micros(us: Column) -> Column:
    """The naive UTC timestamp of microseconds since 1970-01-01 UTC."""
    return F.timestamp_micros(us).cast("timestamp_ntz")


def to_naive_utc(ts: Column) -> Column:
    return ts.cast("timestamp_ntz")


def instant_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a naive UTC timestamp."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def day_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def day_number(day: Column) -> Column:
    """Days since 1970-01-01 as int."""
    return F.datediff(day, F.lit(EPOCH_DAY).cast("date"))


def day_from_number(number: Column) -> Column:
    return F.date_add(F.lit(EPOCH_DAY).cast("date"), number.cast("int"))


def days_in_year(year: Column) -> Column:
    """366 in leap years, else 365; null for a null year."""
    y = year.cast("int")
    return F.datediff(F.make_date(y + 1, F.lit(1), F.lit(1)), F.make_date(y, F.lit(1), F.lit(1)))


def add_hours(ts: Column, hours: int | Column) -> Column:
    h = F.lit(hours) if isinstance(hours, int) else hours
    return ts + F.make_dt_interval(hours=h.cast("int"))


def local_day(ts: Column, utc_offset_hours: int) -> Column:
    """Calendar day of a naive UTC instant on a clock with a fixed offset."""
    return F.to_date(add_hours(ts, utc_offset_hours))


def days_between(first: Column, last: Column) -> Column:
    """Array of the days from first to last, both included; null if either is null or first > last."""
    return F.when(first <= last, F.sequence(first, last))


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def season(day: Column) -> Column:
    """winter (Dec-Feb), spring, summer or autumn of a date; null for a null date."""
    m = F.month(day)
    return (
        F.when(m.isin(12, 1, 2), "winter")
        .when(m.between(3, 5), "spring")
        .when(m.between(6, 8), "summer")
        .when(m.isNotNull(), "autumn")
    )


def cell_text(cell: Column, minutes: Column, offset_minutes: int) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of the first instant of a grid cell (see ``operators.regular_grid``)."""
    return instant_text(F.timestamp_micros((cell * minutes.cast("bigint") - F.lit(offset_minutes)) * MICROS_PER_MINUTE))
