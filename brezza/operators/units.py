"""Quantities in different units, brought to canonical units by a graph of conversions.

Units are nodes, conversions are edges with an affine function ``y = factor * x + shift`` in exact fractions; each edge can be walked both ways.
The edges between volume ratios and mass concentrations depend on the quantity: their factor is multiplied by a power of the quantity's own constant,
which the graph carries as a symbol, so that they take part in compositions and cycles like all others.  From every unit the composition to each
canonical unit over the fewest edges is worked out once; a cycle of edges whose composition is not the identity is an error, and so are two constants
of one quantity that differ.  Spellings lead to nodes after a plain normalisation of the text.  The conversion table (a row per quantity, spelling and
target) is then equi-joined to the records on source unit and target.

Scale: the graph is fixed, a few dozen edges on the driver.  The table has as many rows as spellings times the quantities in the dimension table and the
targets.  Records are joined to it in one pass, without a Python step.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brezza.functions.texts import plain_unit


@dataclass(frozen=True)
class Affine:
    """``y = factor * constant ** power * x + shift``, where the constant belongs to the quantity.

    A function with both a power and a shift would have no constant shift on the way back; the graph has none.
    """

    factor: Fraction = Fraction(1)
    shift: Fraction = Fraction(0)
    power: int = 0

    def __post_init__(self) -> None:
        if self.power and self.shift:
            raise ValueError("a conversion that depends on the quantity has no shift")

    def then(self, following: Affine) -> Affine:
        return Affine(self.factor * following.factor, self.shift * following.factor + following.shift, self.power + following.power)

    def inverse(self) -> Affine:
        return Affine(1 / self.factor, -self.shift / self.factor, -self.power)


class InconsistentUnits(ValueError):
    """Two ways between the same units disagree."""


Edge = tuple[str, str, Fraction, Fraction] | tuple[str, str, Fraction, Fraction, int]

# Edges (from, to, factor, shift), and the power of the quantity's constant (its ug/m3 in one ppb) where there is one.
EDGES: list[Edge] = [
    ("g/m3", "mg/m3", Fraction(1000), Fraction(0)),
    ("mg/m3", "ug/m3", Fraction(1000), Fraction(0)),
    ("ug/m3", "ng/m3", Fraction(1000), Fraction(0)),
    ("mg/m3", "ng/m3", Fraction(1_000_000), Fraction(0)),
    ("ng/m3", "pg/m3", Fraction(1000), Fraction(0)),
    ("kg/m3", "g/m3", Fraction(1000), Fraction(0)),
    ("ug/l", "ug/m3", Fraction(1000), Fraction(0)),
    ("ug/l", "mg/m3", Fraction(1), Fraction(0)),
    ("mg/l", "ug/l", Fraction(1000), Fraction(0)),
    ("mg/l", "g/m3", Fraction(1), Fraction(0)),
    ("ng/l", "ug/m3", Fraction(1), Fraction(0)),
    ("ppm", "ppb", Fraction(1000), Fraction(0)),
    ("ppb", "ppt", Fraction(1000), Fraction(0)),
    ("umol/mol", "ppm", Fraction(1), Fraction(0)),
    ("nmol/mol", "ppb", Fraction(1), Fraction(0)),
    ("umol/mol", "nmol/mol", Fraction(1000), Fraction(0)),
    ("pmol/mol", "ppt", Fraction(1), Fraction(0)),
    ("ppb", "ug/m3", Fraction(1), Fraction(0), 1),
    ("ppm", "mg/m3", Fraction(1), Fraction(0), 1),
    ("K", "degC", Fraction(1), Fraction(-27315, 100)),
    ("degF", "degC", Fraction(5, 9), Fraction(-160, 9)),
    ("degF", "K", Fraction(5, 9), Fraction(45967, 180)),
    ("km/h", "m/s", Fraction(5, 18), Fraction(0)),
    ("hPa", "Pa", Fraction(100), Fraction(0)),
    ("kPa", "hPa", Fraction(10), Fraction(0)),
    ("kPa", "Pa", Fraction(1000), Fraction(0)),
]

# Spellings of the nodes after ``plain_unit``, besides the node's own name in lower case.
SPELLINGS = {
    "ug/m3": ["mcg/m3", "microg/m3", "ugm-3", "mcgm-3", "microgm-3", "ug/mc", "mcg/mc", "microg/mc"],
    "mg/m3": ["mgm-3", "mg/mc"],
    "ng/m3": ["ngm-3", "ng/mc"],
    "g/m3": ["gm-3", "g/mc"],
    "pg/m3": ["pgm-3"],
    "ug/l": ["ug/dm3", "mcg/l", "mcg/dm3", "microg/l", "microg/dm3", "ugl-1", "ugdm-3"],
    "mg/l": ["mg/dm3", "mgl-1"],
    "ng/l": ["ng/dm3", "ngl-1"],
    "ppb": ["ppbv", "partsperbillion"],
    "ppm": ["ppmv", "partspermillion"],
    "ppt": ["pptv", "partspertrillion"],
    "umol/mol": ["micromol/mol"],
    "degC": ["°c", "c"],
    "degF": ["°f", "f"],
}

#: Canonical unit of a mass concentration.
MASS = "ug/m3"
#: What came of a record: ``ok``, or why it has no value in its target unit.
STATUSES = ("ok", "no_value", "no_unit", "unknown_unit", "no_way")


def compositions(edges: Sequence[Edge], target: str) -> dict[str, Affine]:
    """The conversion of each unit that reaches ``target`` over the fewest edges; ``InconsistentUnits`` if any way disagrees."""
    ways: dict[str, list[tuple[str, Affine]]] = {}
    for start, end, *affine in edges:
        forth = Affine(*affine)
        ways.setdefault(end, []).append((start, forth))
        ways.setdefault(start, []).append((end, forth.inverse()))
    found, waiting = {target: Affine()}, deque([target])
    while waiting:
        here = waiting.popleft()
        for there, to_here in ways.get(here, []):
            whole = to_here.then(found[here])
            if there not in found:
                found[there] = whole
                waiting.append(there)
            elif found[there] != whole:
                raise InconsistentUnits(f"{there} to {target}: {found[there]} and {whole}")
    return found


def spellings(unit: str) -> list[str]:
    """How a unit is written, as ``plain_unit`` gives it."""
    return sorted({unit.lower(), *SPELLINGS.get(unit, [])})


def known_spellings(edges: Sequence[Edge] | None = None) -> list[str]:
    return sorted({s for edge in edges or EDGES for unit in edge[:2] for s in spellings(unit)})


def conversion_table(quantities: DataFrame, quantity: str, per_ratio: str, targets: Sequence[str] = (MASS,), edges: Sequence[Edge] | None = None) -> DataFrame:
    """``quantity, target, spelling, factor, shift`` for each quantity of a dimension table and each canonical unit.

    ``per_ratio`` is the quantity's ug/m3 in one ppb, the constant of the edges between ratios and masses; null or not positive where there is none, and
    then there is no such way.  A quantity that is listed twice counts once; two constants that differ by more than a billionth are an error, raised
    when the table is read.
    """
    per = F.when(F.col(per_ratio) > 0, F.col(per_ratio))
    listed = quantities.where(F.col(quantity).isNotNull()).groupBy(quantity).agg(F.min(per).alias("_per"), F.max(per).alias("_most"))
    conflict = F.concat(F.lit("InconsistentUnits: "), F.col(quantity).cast("string"), F.lit(" has constants "), F.col("_per").cast("string"), F.lit(" and "), F.col("_most").cast("string"))
    constant = F.when(F.col("_most") > F.col("_per") * (1 + 1e-9), F.raise_error(conflict).cast("double")).otherwise(F.col("_per"))
    rows = [
        F.struct(F.lit(target).alias("target"), F.lit(s).alias("spelling"), F.lit(float(way.factor)).alias("_factor"), F.lit(float(way.shift)).alias("shift"), F.lit(way.power).alias("_power"))
        for target in targets
        for unit, way in sorted(compositions(edges or EDGES, target).items())
        for s in spellings(unit)
    ]
    each = listed.select(quantity, constant.alias("_per"), F.inline(F.array(*rows)))
    known = F.when(F.col("_power") == 0, 1.0).otherwise(F.pow("_per", F.col("_power")))
    return each.select(quantity, "target", "spelling", (F.col("_factor") * known).alias("factor"), "shift").where(F.col("factor").isNotNull())


def stated_unit(field: Column, *others: Column) -> Column:
    """The spelling of the unit that holds: the field's where it states one, else that of the first other text that does.

    The field states a unit unless it is null, blank, or made of dashes or dots (``-``, ``n.d.``).
    """
    own = plain_unit(field)
    stated = own.isNotNull() & (own != "") & ~own.rlike(r"^([-–—.?/]+|n\.?d\.?|n/?a|null|none)$")
    return F.when(stated, own).otherwise(F.coalesce(*others, F.lit(None)) if others else F.lit(None).cast("string"))


def convert(records: DataFrame, quantity: str, spelling: str, value: str, table: DataFrame, kept: list[str], target: Column | None = None) -> DataFrame:
    """``kept, converted, status`` of every record; ``target`` is its canonical unit (``MASS`` unless given).

    ``status`` is ``ok``; ``no_value`` (null or NaN); ``no_unit`` (null spelling); ``unknown_unit`` (a spelling of no unit of the graph); or ``no_way`` (no
    conversion of this unit to the target for this quantity, unknown ones included).  ``converted`` is null unless ``ok``.
    """
    read = records.select(
        F.struct(*kept).alias("_kept"),
        F.col(quantity).alias("_q"),
        F.col(spelling).alias("_s"),
        F.col(value).cast("double").alias("_v"),
        (F.lit(MASS) if target is None else target).alias("_t"),
    )
    joined = read.join(table, (F.col("_q") == F.col(table.columns[0])) & (F.col("_s") == F.col("spelling")) & (F.col("_t") == F.col("target")), "left")
    status = (
        F.when(F.col("_v").isNull() | F.isnan("_v"), "no_value")
        .when(F.col("_s").isNull() | (F.col("_s") == ""), "no_unit")
        .when(F.col("factor").isNotNull(), "ok")
        .when(~F.col("_s").isin(known_spellings()), "unknown_unit")
        .otherwise("no_way")
    )
    converted = F.when(~F.isnan("_v"), F.col("_v") * F.col("factor") + F.col("shift"))
    return joined.select("_kept.*", converted.alias("converted"), status.alias("status"))
