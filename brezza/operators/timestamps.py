"""Timestamps in mixed notations and zones, normalised to microseconds since 1970-01-01 UTC.

A text is rewritten by the pattern that fits it into one canonical row of fields, checked against the calendar, and brought to UTC by the offset or
zone in the text or else by the clock of its feed.  For a clock, the time line is cut into intervals of constant offset (in seconds), exploded by local
year; the local time is joined as of these intervals: one match gives the offset, two mean an ambiguous time, none a nonexistent one.

The intervals come from the transitions that the zone data list, and from the zone's rule after the last of these.  They are worked out for FIRST_YEAR to LAST_YEAR.
Before, a clock has the offset that it begins with; later, its rules recur, so that a year stands for all of the same length that begin on the same
weekday.  So every year has intervals.

Scale: parsing is built of Spark expressions, row by row, without a shuffle; a text meets only the patterns of its shape.  The interval table has a short
row per clock and year, and the clocks are bounded by the number of zones that exist, so that it is broadcast.
"""

from __future__ import annotations

import os
import re
import struct
from calendar import isleap
from collections.abc import Iterator
from datetime import UTC, date, datetime, timedelta
from functools import lru_cache
from importlib import resources
from zoneinfo import TZPATH, ZoneInfo

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIRST_YEAR, LAST_YEAR = 1800, 2199
MICROS = 1_000_000

# Zone letters in their European sense, in minutes east of UTC.
ZONE_LETTERS = {
    "Z": 0, "UT": 0, "UTC": 0, "GMT": 0, "WET": 0, "WEST": 60, "BST": 60, "IST": 60, "CET": 60, "MEZ": 60,
    "CEST": 120, "MESZ": 120, "EET": 120, "OEZ": 120, "EEST": 180, "OESZ": 180, "MSK": 180, "TRT": 180,
}

# Month names by their first letters, in English, Italian, German and French.
MONTH_NAMES = {
    "jan": 1, "gen": 1, "jän": 1, "feb": 2, "fév": 2, "fev": 2, "mar": 3, "mär": 3, "maer": 3, "apr": 4, "avr": 4,
    "may": 5, "mag": 5, "mai": 5, "jun": 6, "giu": 6, "juin": 6, "jul": 7, "lug": 7, "juil": 7, "aug": 8, "ago": 8,
    "aoû": 8, "aou": 8, "sep": 9, "set": 9, "oct": 10, "ott": 10, "okt": 10, "nov": 11, "dec": 12, "dic": 12,
    "dez": 12, "déc": 12,
}

_ZONE = r"(?: ?(?:([+-])(\d\d)(?::?(\d\d))?|([A-Za-z]{1,5})))?"
_CLOCK = r"(\d\d?)(?:[:.](\d\d)(?:[:.](\d\d)(?:[.,](\d{1,9}))?)?)?(?: ?([AaPp])\.?[Mm]\.?)?"
# Each pattern and the canonical row that it is rewritten to: kind|year|month|day|hour|minute|second|fraction|half|sign|hours|minutes|letters.
_DIGITS = [
    (r"^(-?\d{9,10})(?:[.,](\d{1,9}))?$", "epoch|$1|$2||||||||||"),
    (r"^(\d{10})(\d{3}|\d{6}|\d{9})$", "epoch|$1|$2||||||||||"),
    (r"^(\d{4})(\d\d)(\d\d)[T ]?(\d\d)(\d\d)(\d\d)?(?:[.,](\d{1,9}))?()" + _ZONE + "$", "ymd|$1|$2|$3|$4|$5|$6|$7|$8|$9|$10|$11|$12"),
]
_YEAR_FIRST = [
    (r"^(\d{4})[-/.](\d\d?)[-/.](\d\d?)[Tt ]" + _CLOCK + _ZONE + "$", "ymd|$1|$2|$3|$4|$5|$6|$7|$8|$9|$10|$11|$12"),
    (r"^(\d{4})-(\d{3})()[Tt ]" + _CLOCK + _ZONE + "$", "ordinal|$1|$2|$3|$4|$5|$6|$7|$8|$9|$10|$11|$12"),
    (r"^(\d{4})-?[Ww](\d\d)-?(\d)[Tt ]" + _CLOCK + _ZONE + "$", "week|$1|$2|$3|$4|$5|$6|$7|$8|$9|$10|$11|$12"),
]
_OTHERS = [
    (r"^(\d\d?)[/.-](\d\d?)[/.-](\d{4}|\d\d),?[T ]" + _CLOCK + _ZONE + "$", "xxy|$3|$2|$1|$4|$5|$6|$7|$8|$9|$10|$11|$12"),
    (r"^(?:\p{L}+\.?, ?)?(\d\d?)\.?[ -](\p{L}+)\.?[ -](\d{4}),? " + _CLOCK + _ZONE + "$", "ymd|$3|$2|$1|$4|$5|$6|$7|$8|$9|$10|$11|$12"),
    (r"^(?:\p{L}+\.?, ?)?(\p{L}+)\.? (\d\d?),? (\d{4}),? " + _CLOCK + _ZONE + "$", "ymd|$3|$1|$2|$4|$5|$6|$7|$8|$9|$10|$11|$12"),
]


def _lookup(values: dict[str, int]) -> Column:
    return F.create_map(*(F.lit(x) for pair in values.items() for x in pair))


def _month_by_name(text: Column) -> Column:
    """The month's number by the first four, else three letters of its name; null where it has none."""
    names = _lookup(MONTH_NAMES)
    return F.coalesce(F.try_element_at(names, F.substring(text, 1, 4)), F.try_element_at(names, F.substring(text, 1, 3)))


def _is_zone(name: str) -> bool:
    try:
        ZoneInfo(name)
    except Exception:  # noqa: BLE001  the library raises several kinds for senseless names
        return False
    return True


def _listed_transitions(name: str) -> tuple[list[int], bool]:
    """Seconds since 1970 UTC of the changes that the data of a zone list, and whether a rule with further changes may follow them."""
    for folder in TZPATH:
        path = os.path.join(folder, *name.split("/"))
        if os.path.isfile(path):
            with open(path, "rb") as file:
                data = file.read()
            break
    else:
        try:
            *parts, last = name.split("/")
            data = resources.files(".".join(["tzdata", "zoneinfo", *parts])).joinpath(last).read_bytes()
        except (ModuleNotFoundError, FileNotFoundError, OSError):
            return [], True
    header = struct.Struct(">4sc15x6l")
    at, length = 0, 4
    magic, version, utc, std, leap, times, types, letters = header.unpack_from(data)
    if magic != b"TZif":
        return [], True
    if version >= b"2":
        # The second part of the file has the times in eight bytes.
        at, length = header.size + times * 5 + types * 6 + letters + leap * 8 + std + utc, 8
        times = header.unpack_from(data, at)[5]
    listed = list(struct.unpack_from(f">{times}{'q' if length == 8 else 'l'}", data, at + header.size))
    # The rule is the last line; one with summer time names its days after a comma.
    return listed, length == 4 or b"," in data.rstrip(b"\n").rsplit(b"\n", 1)[-1]


@lru_cache(maxsize=1024)
def clock_offsets(clock: str) -> tuple[tuple[int, int, int], ...]:
    """``(from_us, to_us, offset_seconds)`` of each stretch of constant offset of a clock in UTC, from FIRST_YEAR to LAST_YEAR.

    A clock is a fixed offset (``+01:00``) or the name of a zone; anything else has no stretches.
    """
    origin = datetime(1970, 1, 1, tzinfo=UTC)
    start, end = datetime(FIRST_YEAR, 1, 1, tzinfo=UTC) - timedelta(days=2), datetime(LAST_YEAR + 1, 1, 1, tzinfo=UTC) + timedelta(days=2)

    def seconds(t: datetime) -> int:
        return (t - origin) // timedelta(seconds=1)

    if fixed := re.fullmatch(r"([+-])(\d\d):?(\d\d)", clock or ""):
        offset = (int(fixed[2]) * 60 + int(fixed[3])) * (-60 if fixed[1] == "-" else 60)
        return ((seconds(start) * MICROS, seconds(end) * MICROS, offset),)
    if not clock or not _is_zone(clock):
        return ()
    zone = ZoneInfo(clock)

    def offset_at(t: int) -> int:
        return int(((origin + timedelta(seconds=t)).astimezone(zone).utcoffset() or timedelta(0)).total_seconds())

    first, last = seconds(start), seconds(end)
    listed, ruled = _listed_transitions(clock)
    changes = [t for t in listed if first < t < last]
    # After the listed ones a rule holds with two changes a year at most, months apart, which are looked for by weeks.
    here = max(changes, default=first) if ruled else last
    while here < last:
        after = min(here + 7 * 86_400, last)
        if offset_at(here) != offset_at(after):
            low, high = here, after
            while high - low > 1:
                middle = (low + high) // 2
                low, high = (middle, high) if offset_at(middle) == offset_at(here) else (low, middle)
            changes.append(high)
        here = after
    stretches: list[tuple[int, int, int]] = []
    for a, b in zip([first, *changes], [*changes, last], strict=True):
        offset = offset_at(a)
        if stretches and stretches[-1][2] == offset:
            stretches[-1] = (stretches[-1][0], b * MICROS, offset)
        else:
            stretches.append((a * MICROS, b * MICROS, offset))
    return tuple(stretches)


def _standing_for(year: Column, first_day: Column) -> tuple[Column, Column]:
    """The year of the table that stands for a local year (given its first day), and by how many days the local time is moved to it."""
    alike = {}
    for y in range(LAST_YEAR - 60, LAST_YEAR + 1):
        alike[date(y, 1, 1).isoweekday() % 7 + 1 + (7 if isleap(y) else 0)] = y
    leap = F.dayofyear(F.make_date(year, F.lit(12), F.lit(31))) == 366
    later = F.try_element_at(_lookup(alike), F.dayofweek(first_day) + F.when(leap, 7).otherwise(0))
    standing = F.when(year > LAST_YEAR, later).when(year < FIRST_YEAR, FIRST_YEAR - 1).otherwise(year)
    return standing, F.when(year > LAST_YEAR, F.datediff(F.make_date(later, F.lit(1), F.lit(1)), first_day)).otherwise(0)


def offset_intervals(clocks: DataFrame, clock: str = "clock") -> DataFrame:
    """``clock, year, stretches`` of the distinct clocks: per local year, the local ``from_us, to_us, offset_seconds``; the year before FIRST_YEAR
    stands for all earlier ones."""

    def explode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name in frame[clock]:
                rows: dict[int, list[tuple[int, int, int]]] = {}
                stretches = clock_offsets(name)
                for a, b, offset in stretches:
                    a, b = a + offset * MICROS, b + offset * MICROS
                    years = [(datetime(1970, 1, 1) + timedelta(microseconds=x)).year for x in (a, b - 1)]
                    for year in range(max(FIRST_YEAR, years[0]), min(LAST_YEAR, years[1]) + 1):
                        rows.setdefault(year, []).append((a, b, offset))
                if rows:
                    rows[FIRST_YEAR - 1] = [(-(1 << 62), stretches[0][0], stretches[0][2])]
                    yield pd.DataFrame({"clock": name, "year": list(rows), "stretches": [[{"from_us": a, "to_us": b, "offset_seconds": o} for a, b, o in s] for s in rows.values()]})

    named = clocks.select(clock).where(F.col(clock).isNotNull()).distinct()
    return named.mapInPandas(explode, "clock string, year int, stretches array<struct<from_us: bigint, to_us: bigint, offset_seconds: int>>")


def _fields(text: Column) -> Column:
    """The canonical row of a text; a row of one where no notation fits.

    The notations fit whole texts and no canonical row, so that those of one shape may be applied one after the other.
    """
    def rewritten(notations: list[tuple[str, str]]) -> Column:
        row = text
        for pattern, canonical in notations:
            row = F.regexp_replace(row, pattern, canonical)
        return row

    def digits_only(part: Column) -> Column:
        return F.translate(part, "0123456789", "") == ""

    year_first = digits_only(F.substring(text, 1, 4)) & F.substring(text, 5, 1).isin("-", "/", ".", "W", "w")
    digits = digits_only(F.substring(text, 2, 7)) & (F.length(text) >= 8)
    row = F.when(year_first, rewritten(_YEAR_FIRST)).when(digits, rewritten(_DIGITS)).otherwise(rewritten(_OTHERS))
    return F.split(row, r"\|", -1)


def normalise_timestamps(texts: DataFrame, text: str, feed: str, feeds: DataFrame, kept: list[str]) -> DataFrame:
    """``kept`` columns and ``utc_us, status`` of each text; ``feeds`` has ``feed_id, clock, date_order``.

    ``status`` is ``ok``; ``ambiguous`` or ``nonexistent`` (a local time that its clock shows twice or never); ``no_clock`` (a local time of a feed without
    a known clock); or ``not_a_time`` (null, empty, a day without a time, no known notation, not in the calendar, unknown zone, or day and month in unknown
    order).  ``utc_us`` is null unless ``ok``; digits beyond microseconds are cut off.  Hour 24 is the end of its day, and only without minutes.  Two-digit
    years are 20yy.  A zone's name in brackets at the end (``[Europe/Rome]``) is a clock where the text has no offset, if a feed has that clock too.  Bare
    numbers are seconds (9 or 10 digits, negative ones and fractions too), or milli-, micro- or nanoseconds (13, 16 or 19 digits) since 1970.  A feed that
    is described twice counts once, by its least row.  Each row of ``texts`` gives one row.
    """
    rules = feeds.where(F.col("feed_id").isNotNull()).groupBy("feed_id").agg(F.min(F.struct("clock", "date_order")).alias("_rule"))
    clocks = rules.select(F.col("_rule.clock").alias("clock"))
    tidy = F.trim(F.regexp_replace(F.translate(F.col(text), "|\u00a0\u202f", "!  "), r"\s+", " "))
    bracketed = F.endswith(tidy, F.lit("]"))
    zone = F.when(bracketed, F.nullif(F.regexp_extract(tidy, r" ?\[([A-Za-z]+(?:/[A-Za-z0-9_+-]+)+)\]$", 1), F.lit("")))
    plain = F.when(bracketed, F.regexp_replace(tidy, r" ?\[[A-Za-z]+(?:/[A-Za-z0-9_+-]+)+\]$", "")).otherwise(tidy)
    read = texts.select(F.struct(*kept).alias("_kept"), F.col(feed).alias("_feed"), _fields(plain).alias("_f"), zone.alias("_named"))
    read = read.join(rules, F.col("_feed") == F.col("feed_id"), "left").select("_kept", "_f", F.coalesce("_named", F.col("_rule.clock")).alias("_clock"), F.lower("_rule.date_order").alias("_order"))

    # The fields become columns first, so that none of them is worked out more than once.
    micros = F.expr("cast(rpad(substring(concat(coalesce(get(_f, 7), ''), '000000'), 1, 6), 6, '0') as int)")
    texts_at, numbers_at = (0, 1, 2, 8, 9, 12), (1, 2, 3, 4, 5, 6, 10, 11)
    fields = [F.get("_f", F.lit(k)).alias(f"_t{k}") for k in texts_at] + [F.expr(f"try_cast(nullif(get(_f, {k}), '') as int) as _n{k}") for k in numbers_at]
    epoch = F.expr("case when get(_f, 0) = 'epoch' then try_cast(concat(get(_f, 1), rpad(coalesce(get(_f, 2), ''), 6, '0')) as bigint) end")
    read = read.select("_kept", "_clock", "_order", *fields, micros.alias("_micros"), epoch.alias("_epoch"))

    def part(k: int) -> Column:
        return F.col(f"_t{k}")

    def number(k: int) -> Column:
        return F.col(f"_n{k}")

    month_by_name = F.when(number(2).isNull() & (part(2) != ""), _month_by_name(F.lower(part(2))))
    two = F.length(part(1)) == 2
    zone_letters = F.when(part(12) != "", F.try_element_at(_lookup(ZONE_LETTERS), F.upper(part(12))))
    read = read.select(
        "*",
        F.coalesce("_t0", F.lit("")).alias("_kind"),
        F.coalesce(number(2), month_by_name).alias("_named"),
        F.when(two, F.lit(2000) + number(1)).otherwise(number(1)).alias("_y"),
        zone_letters.alias("_letters"),
    )
    kind, named, year, micros = (F.col(c) for c in ("_kind", "_named", "_y", "_micros"))
    swapped = (kind == "xxy") & (F.col("_order") == "mdy")
    ordered = kind.isin("ymd", "ordinal", "week") | ((kind == "xxy") & F.col("_order").isin("dmy", "mdy"))
    month, day = F.when(swapped, number(3)).otherwise(named), F.when(swapped, named).otherwise(number(3))
    half, raw_hour = F.upper(part(8)), number(4)
    whole_day = half.isNull() | (half == "")
    hour = F.when(whole_day, raw_hour).when(raw_hour.between(1, 12), F.pmod(raw_hour, F.lit(12)) + F.when(half == "P", 12).otherwise(0)).otherwise(F.lit(None))
    minute, second = F.coalesce(number(5), F.lit(0)), F.coalesce(number(6), F.lit(0))
    sign, letters = part(9), part(12)
    zone_hours, zone_minutes = number(10), F.coalesce(number(11), F.lit(0))
    stated = F.when((sign != "") & (zone_hours <= 18) & (zone_minutes < 60), (zone_hours * 60 + zone_minutes) * F.when(sign == "-", -1).otherwise(1)).otherwise(F.col("_letters"))
    known_year = year.between(1, 9999)
    first_of_year = F.when(known_year, F.make_date(year, F.lit(1), F.lit(1)))
    first_of_month = F.when(month.between(1, 12) & known_year, F.make_date(year, month, F.lit(1)))

    def first_monday(y: Column) -> Column:
        """The Monday of the week that holds the fourth of January."""
        fourth = F.make_date(y, F.lit(1), F.lit(4))
        return F.date_sub(fourth, F.weekday(fourth))

    of_week = F.when(known_year & (kind == "week"), F.date_add(first_monday(year), (named - 1) * 7 + day - 1))
    begins = F.when(kind == "week", of_week).when(kind == "ordinal", F.date_add(first_of_year, named - 1)).otherwise(F.date_add(first_of_month, day - 1))
    in_year = (
        F.when(kind == "week", named.between(1, 53) & day.between(1, 7) & (of_week < first_monday(year + 1)))
        .when(kind == "ordinal", named.between(1, F.dayofyear(F.make_date(year, F.lit(12), F.lit(31)))))
        .otherwise(day.between(1, F.dayofmonth(F.last_day(first_of_month))))
    )
    in_calendar = (
        F.coalesce(in_year & known_year, F.lit(False))
        & F.coalesce(hour.between(0, 23) | ((hour == 24) & (minute == 0) & (second == 0) & (micros == 0) & whole_day), F.lit(False))
        & minute.between(0, 59)
        & second.between(0, 59)
        & F.coalesce(ordered, F.lit(False))
    )
    # A fold over the parts of the clock.  It also keeps this projection out of whole-stage code generation, which would make
    # one method of it that is too long for the JVM to compile (measured: three times slower).
    of_day = F.aggregate(F.array(hour, minute, second), F.lit(0), lambda total, part: total * 60 + part)
    local = (F.datediff(begins, F.lit("1970-01-01").cast("date")).cast("bigint") * 86400 + of_day) * MICROS + micros
    zoned = ((F.coalesce(sign, F.lit("")) != "") | (F.coalesce(letters, F.lit("")) != "")).alias("_zoned")
    timed = read.select("_kept", "_clock", "_epoch", F.when((kind != "epoch") & in_calendar, local).alias("_local"), zoned, stated.alias("_stated"))
    at = F.timestamp_micros("_local")
    timed = timed.withColumn("_year", F.when(~F.col("_zoned"), F.year(at)))
    standing, moved = _standing_for(F.col("_year"), F.make_date(F.col("_year"), F.lit(1), F.lit(1)))
    timed = timed.withColumn("_at", F.col("_local") + moved.cast("bigint") * 86400 * MICROS).withColumn("_year", standing)
    table = offset_intervals(clocks).select(F.col("clock").alias("_c"), F.col("year").alias("_y"), "stretches")
    joined = timed.join(F.broadcast(table), (F.col("_clock") == F.col("_c")) & (F.col("_year") == F.col("_y")), "left")
    matches = F.filter("stretches", lambda s: (s["from_us"] <= F.col("_at")) & (F.col("_at") < s["to_us"]))
    timed = joined.withColumn("_matches", matches)
    found = F.size("_matches")
    by_clock = F.col("_local") - F.get("_matches", F.lit(0))["offset_seconds"].cast("bigint") * MICROS
    status = (
        F.when(F.col("_epoch").isNotNull(), "ok")
        .when(F.col("_local").isNull(), "not_a_time")
        .when(F.col("_zoned"), F.when(F.col("_stated").isNotNull(), "ok").otherwise("not_a_time"))
        .when(F.col("stretches").isNull(), "no_clock")
        .when(found == 1, "ok")
        .when(found == 0, "nonexistent")
        .otherwise("ambiguous")
    )
    us = (
        F.when(F.col("_epoch").isNotNull(), F.col("_epoch"))
        .when(F.col("_zoned"), F.col("_local") - F.col("_stated").cast("bigint") * 60 * MICROS)
        .when(found == 1, by_clock)
    )
    return timed.select("_kept.*", us.alias("utc_us"), status.alias("status"))
