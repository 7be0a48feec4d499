"""Scalar expressions on measurements."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The plain spellings of the two units that staging converts.
MICROGRAMS, MILLIGRAMS = ["ug/m3", "µg/m³"], ["mg/m3", "mg/m³"]


def to_ugm3(value: Column, unit: Column) -> Column:
    """The value in ug/m3 for plainly spelled units; null for others and for nulls (see ``operators.units`` for all others)."""
    return F.when(unit.isin(MICROGRAMS), value).when(unit.isin(MILLIGRAMS), value * 1000)


def location_id(latitude: Column, longitude: Column, decimals: int) -> Column:
    """``round(lat * 10^d)_round(lon * 10^d)``, halves away from zero; null if a coordinate is null or not finite."""
    scale = float(10 ** min(decimals, 6))

    def cell(x: Column) -> Column:
        return F.when(~F.isnan(x) & (F.abs(x) < 1e6), F.round(x * scale).cast("bigint").cast("string"))

    return F.concat(cell(latitude), F.lit("_"), cell(longitude))


def station_code(text: Column) -> Column:
    """A station's number from ``7.000.014`` and the like; null unless only digits remain."""
    digits = F.replace(F.trim(text), F.lit("."), F.lit(""))
    return F.when(digits.rlike("^[0-9]{1,10}$"), digits.cast("bigint"))


def flags(concentration: Column, largest: Column) -> dict[str, Column]:
    """``is_negative, is_zero, is_implausible, is_valid``, none of them null."""
    negative = F.coalesce(concentration < 0, F.lit(False))
    implausible = F.coalesce(concentration > largest, F.lit(False))
    return {
        "is_negative": negative,
        "is_zero": F.coalesce(concentration == 0, F.lit(False)),
        "is_implausible": implausible,
        "is_valid": concentration.isNotNull() & ~negative & ~implausible,
    }


# What Italian labels of stations contain, and what it means; the first that fits holds.
EXPOSURES = {"traffico": "traffic", "fondo": "background", "industriale": "industrial"}
AREAS = {"remot": "remote", "suburban": "suburban", "urban": "urban", "rural": "rural"}


def _first_contained(label: Column, meanings: dict[str, str]) -> Column:
    found = F.filter(F.array(*(F.when(F.contains(F.lower(label), F.lit(part)), F.lit(name)) for part, name in meanings.items())), lambda x: x.isNotNull())
    return F.get(found, F.lit(0))


def station_type_of(label: Column) -> Column:
    """traffic, background, industrial or null, from an Italian label."""
    return _first_contained(label, EXPOSURES)


def area_type_of(label: Column) -> Column:
    """remote, suburban, urban, rural or null; suburban is looked for before urban."""
    return _first_contained(label, AREAS)


def correlation(x: Column, y: Column) -> Column:
    """Pearson's correlation of a group; null where a variance is zero, instead of an error."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def one_of(column: Column, values: list | None) -> Column:
    """No filter for None; nothing passes an empty list."""
    return F.lit(True) if values is None else column.isin(list(values))
