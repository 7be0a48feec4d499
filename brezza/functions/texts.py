"""Texts of units and numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that stand for one another in unit texts.
_UNIT_FROM, _UNIT_TO = "µμ³²¹⁻−·⋅", "uu321--"  # the dots are removed
_TITLE = r"^.*?(?:[(\[]\s*([^()\[\]]+)\s*[)\]]\s*|\s[-–—]\s+(.+)|,\s*[^,]*\bin\s+(.+))$"
_NUMBER = r"^\s*([+-]?[0-9][0-9.,]*(?:[eE][+-]?[0-9]+)?|[+-]?[.,][0-9]+)\s*(.*)$"


def plain_unit(text: Column) -> Column:
    """A unit text in lower case without white space, brackets, HTML entities, superscripts and variants of the micro sign."""
    decoded = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(text), "&micro;|&mu;", "u"), "&sup3;", "3"), "&sup2;", "2")
    return F.regexp_replace(F.translate(decoded, _UNIT_FROM, _UNIT_TO), r"[\s \[\](){}]+", "")


def number_of(text: Column) -> Column:
    """The number that a text begins with, null if none.  A comma is the decimal sign, else a dot is."""
    digits = F.regexp_extract(text, _NUMBER, 1)
    plain = F.when(digits.contains(","), F.replace(F.replace(digits, F.lit("."), F.lit("")), F.lit(","), F.lit("."))).otherwise(digits)
    return F.nullif(plain, F.lit("")).try_cast("double")


def rest_after_number(text: Column) -> Column:
    """What follows the number that a text begins with; null if it begins with none or nothing follows."""
    return F.nullif(F.trim(F.regexp_extract(text, _NUMBER, 2)), F.lit(""))


def unit_in_title(text: Column) -> Column:
    """The unit at the end of a title such as ``NO2 (ug/m3)``, ``NO2 [ug/m3]``, ``NO2 - ug/m3`` or ``NO2, valori in ug/m3``."""
    return F.coalesce(*(F.nullif(F.regexp_extract(text, _TITLE, k), F.lit("")) for k in (1, 2, 3)))
