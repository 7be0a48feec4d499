"""Each query against its SQL, on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from brezza.plans import catalogue

QUERIES, ORACLES = catalogue.queries(), catalogue.oracle_sql()


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for path in glob.glob(f"{small}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 5) + 0.0
    if hasattr(value, "isoformat"):
        return value.isoformat()[:19].replace("T00:00:00", "")
    return value


def table(rows, names):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_gives_what_its_sql_gives(spark, small, duck, name):
    got = QUERIES[name](spark, small)
    wanted = duck.execute(ORACLES[name])
    names = [d[0] for d in wanted.description]
    assert sorted(got.columns) == sorted(names)
    a, b = table(got.collect(), got.columns), table(wanted.fetchall(), names)
    assert len(a) == len(b)
    for x, y in zip(a, b, strict=True):
        for p, q in zip(x, y, strict=True):
            assert p == q or (isinstance(p, float) and p == pytest.approx(q, abs=2e-5)), (x, y)


def test_every_registered_query_runs(spark, small):
    for name in set(QUERIES) - set(ORACLES):
        assert QUERIES[name](spark, small).count() >= 0


def test_entry_has_rows(spark, small):
    assert entry.entry(spark).count() > 0


def test_found_queries_have_the_columns_that_are_asked_for(spark, small):
    wanted = {
        "p1_found": "station_id int, pollutant_id int, day string, period_days int",
        "p2_found": "station_id int, pollutant_id int, slot string",
        "p3_found": "record_key string, field_name string, utc_us bigint",
        "p4_found": "station_id int, pollutant_id int, measured_at string",
        "p5_found": "src string, record_key string, ng_m3 bigint",
        "p6_found": "station_id int, pollutant_id int, valid_from string, valid_to string",
    }
    for name, columns in wanted.items():
        found = QUERIES[name](spark, small)
        assert ", ".join(f"{c} {t}" for c, t in found.dtypes) == columns
        assert found.count() == found.distinct().count()
