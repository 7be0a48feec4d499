from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from brezza.functions.texts import number_of, plain_unit, rest_after_number, unit_in_title
from brezza.operators import units
from tests.conftest import rows


def test_affine_compositions():
    to_celsius = units.compositions(units.EDGES, "degC")
    assert to_celsius["degF"] == units.Affine(Fraction(5, 9), Fraction(-160, 9))
    assert to_celsius["K"].shift == Fraction(-27315, 100)
    to_mass = units.compositions(units.EDGES, "ug/m3")
    assert to_mass["g/m3"].factor == 10**6 and to_mass["ng/m3"].factor == Fraction(1, 1000) and to_mass["ug/l"].factor == 1000
    assert to_mass["ppb"] == units.Affine(Fraction(1), Fraction(0), 1) and to_mass["nmol/mol"].power == 1 and to_mass["ppm"].factor == 1000
    assert units.compositions(units.EDGES, "ppb")["g/m3"] == units.Affine(Fraction(10**6), Fraction(0), -1)
    assert "degC" not in to_mass


def test_cycles_must_agree():
    wrong = [*units.EDGES, ("g/m3", "ug/m3", Fraction(1000), Fraction(0))]
    with pytest.raises(units.InconsistentUnits):
        units.compositions(wrong, "ug/m3")
    # The edges that depend on the quantity take part in cycles.
    for edge in [("ppt", "ng/m3", Fraction(2), Fraction(0), 1), ("ppb", "ug/m3", Fraction(1), Fraction(0), 2), ("ppb", "ug/m3", Fraction(2), Fraction(0))]:
        with pytest.raises(units.InconsistentUnits):
            units.compositions([*units.EDGES, edge], "ug/m3")
    units.compositions([*units.EDGES, ("ppt", "ng/m3", Fraction(1), Fraction(0), 1)], "ug/m3")
    with pytest.raises(ValueError):
        units.Affine(Fraction(1), Fraction(1), 1)


def test_constants_of_one_quantity_must_agree(spark):
    quantities = spark.createDataFrame([(1, 2.0), (1, 1.9)], "id int, per double")
    with pytest.raises(Exception, match="InconsistentUnits"):
        units.conversion_table(quantities, "id", "per").collect()


def test_target_is_a_join_key(spark):
    quantities = spark.createDataFrame([("t", None), ("no2", 1.88)], "id string, per double")
    table = units.conversion_table(quantities, "id", "per", ["ug/m3", "ppb", "degC", "K"])
    df = spark.createDataFrame(
        [(1, "t", 212.0, "degf", "degC"), (2, "t", 212.0, "degf", "K"), (3, "no2", 188.0, "ug/m3", "ppb"), (4, "no2", 0.1, "ppm", "ug/m3"), (5, "t", 1.0, "ppb", "ug/m3"), (6, "t", 1.0, "degf", "Pa")],
        "k int, id string, v double, u string, goal string",
    )
    got = {r.k: (r.status, r.converted) for r in units.convert(df, "id", "u", "v", table, ["k"], F.col("goal")).collect()}
    assert got == {1: ("ok", pytest.approx(100)), 2: ("ok", pytest.approx(373.15)), 3: ("ok", pytest.approx(100)), 4: ("ok", pytest.approx(188)), 5: ("no_way", None), 6: ("no_way", None)}


UNITS = {"ug/m3": 1.0, " UG/M3 ": 1.0, "µg/m³": 1.0, "μg/m3": 1.0, "µg·m⁻³": 1.0, "&micro;g/m&sup3;": 1.0, "mcg/m3": 1.0, "microg/m³": 1.0, "ug m-3": 1.0, "µg/mc": 1.0,
         "MG/M3": 1e3, "mg m-3": 1e3, "mg/mc": 1e3, "ug/l": 1e3, "µg/dm3": 1e3, "ng/m³": 1e-3, "g/m3": 1e6, "ppb": 2.0, "PPB": 2.0, "parts per billion": 2.0, "nmol/mol": 2.0,
         "ppmv": 2e3, "µmol/mol": 2e3, "[µg/m³]": 1.0, "(ug/m3)": 1.0, "n/l": None, "Bq/m3": None, "%": None, "ug": None, "": None, "-": None, "n.d.": None, None: None}


@pytest.fixture(scope="module")
def table(spark):
    quantities = spark.createDataFrame([(1, 2.0), (1, 2.0), (2, None), (None, 1.0)], "id int, per double")
    return units.conversion_table(quantities, "id", "per")


def test_spellings(spark, table):
    df = spark.createDataFrame([(k, 1, 3.0, u) for k, u in enumerate(UNITS)], "factor int, id int, v double, unit string").withColumn("u", units.stated_unit(F.col("unit")))
    got = {r.factor: r for r in units.convert(df, "id", "u", "v", table, ["factor"]).collect()}
    for k, (unit, factor) in enumerate(UNITS.items()):
        assert got[k].converted == (None if factor is None else pytest.approx(3.0 * factor)), unit
        assert got[k].status == ("ok" if factor else "no_unit" if unit in ("", "-", "n.d.", None) else "unknown_unit"), unit


def test_ratios_need_a_factor_and_values_must_be_there(spark, table):
    df = spark.createDataFrame([(1, 2, 3.0, "ppb"), (2, 2, 3.0, "ug/m3"), (3, 1, None, "ug/m3"), (4, 1, float("nan"), "ug/m3"), (5, 9, 1.0, "ug/m3"), (6, None, 1.0, "ug/m3")], "k int, id int, v double, u string")
    assert [r[1:] for r in rows(units.convert(df, "id", "u", "v", table, ["k"]))] == [(None, "no_way"), (3.0, "ok"), (None, "no_value"), (None, "no_value"), (None, "no_way"), (None, "no_way")]
    assert units.convert(df.limit(0), "id", "u", "v", table, ["k"]).count() == 0


def test_texts(spark):
    values = ["1.139,041", "5,525", "4.801", "1.5174e-05", " 0,000231  mg/m3", "99.353ug/m3", "998,69PPB", "n.d.", "", None, "99.75 [µg/m³]", "-1,5", "1,5parts per billion"]
    df = spark.createDataFrame([(v,) for v in values], "t string")
    got = [tuple(r) for r in df.select(number_of(F.col("t")), plain_unit(rest_after_number(F.col("t")))).collect()]
    assert got == [
        (1139.041, None), (5.525, None), (4.801, None), (1.5174e-05, None), (0.000231, "mg/m3"), (99.353, "ug/m3"), (998.69, "ppb"), (None, None), (None, None), (None, None), (99.75, "ug/m3"),
        (-1.5, None), (1.5, "partsperbillion"),
    ]
    titles = ["NO2 (ug/m3)", "PM2.5, valori in mg/m³", "NO - ppb", "NO [mg m-3]", "PM10", "", None, "NO2 - parts per billion"]
    df = spark.createDataFrame([(v,) for v in titles], "t string")
    assert [r[0] for r in df.select(plain_unit(unit_in_title(F.col("t")))).collect()] == ["ug/m3", "mg/m3", "ppb", "mgm-3", None, None, None, "partsperbillion"]


def test_the_field_holds_where_it_states_a_unit(spark):
    df = spark.createDataFrame([("ug/m3", "mg/m3"), ("-", "mg/m3"), (None, "mg/m3"), ("n.d.", "mg/m3"), ("Bq/m3", "mg/m3"), (" ", None)], "a string, b string")
    assert [r[0] for r in df.select(units.stated_unit(F.col("a"), plain_unit(F.col("b")))).collect()] == ["ug/m3", "mg/m3", "mg/m3", "mg/m3", "bq/m3", None]
