import random
from datetime import date, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from brezza.operators import trailing
from tests.conftest import rows

SCHEMA = "k string, day date, v double, ok boolean, total double"


def brute(data, period, bounds_valid=False):
    out = {}
    by = {}
    for k, d, v, ok, _ in data:
        if k is not None and d is not None:
            by.setdefault(k, []).append((d, v, bool(ok)))
    for k, readings in by.items():
        days = [d for d, _, ok in readings if ok or not bounds_valid]
        if not days:
            continue
        day = min(days)
        while day <= max(days):
            inside = [v or 0.0 for d, v, ok in readings if ok and day - timedelta(days=period - 1) <= d <= day]
            out[k, day] = (sum(inside), len(inside)) if inside else (None, 0)
            day += timedelta(days=1)
    return out


@pytest.fixture(scope="module")
def data():
    chance = random.Random(5)
    start = date(2023, 12, 20)
    out = [(k, start + timedelta(days=chance.choice([chance.randrange(40), 150 + chance.randrange(30), 400])), chance.uniform(0, 9), chance.random() < 0.7, 1.0) for k in "abc" for _ in range(60)]
    out += [("a", None, 1.0, True, 1.0), (None, start, 1.0, True, 1.0), ("b", start, None, True, 1.0), ("c", start, 1.0, None, 1.0)]
    return out + out[:7]


@pytest.mark.parametrize("valid_bounds", [False, True])
@pytest.mark.parametrize("period", [1, 7, 30, 200])
def test_against_brute_force(spark, data, period, valid_bounds):
    df = spark.createDataFrame(data, SCHEMA)
    got = trailing.trailing_totals(df, ["k"], "day", "v", F.col("ok"), [period], valid_bounds=valid_bounds)
    wanted = brute(data, period, valid_bounds)
    found = {(r.k, r.day): (r.total, r.readings) for r in got.collect()}
    assert found.keys() == wanted.keys()
    for key, (total, number) in wanted.items():
        assert found[key][1] == number
        assert found[key][0] is None if total is None else found[key][0] == pytest.approx(total)


def test_periods_without_readings(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    got = trailing.trailing_totals(df, ["k"], "day", "v", F.col("ok"), [7, 30], valid_bounds=True, empty_only=True)
    wanted = {(k, d, p) for p in (7, 30) for (k, d), (_, n) in brute(data, p, True).items() if n == 0}
    assert {(r.k, r.day, r.period_days) for r in got.collect()} == wanted


def test_late_corrections_change_only_their_shards(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    forest = trailing.build_forest(trailing.day_leaves(df, ["k"], "day", "v", F.col("ok")), ["k"])
    late = spark.createDataFrame([("a", 19720, 5.0, 1), ("a", 19720, 2.5, 1), ("new", 19000, 4.0, 2), (None, 19720, 1.0, 1)], "k string, day_no int, sum_change double, count_change bigint")
    corrected = trailing.correct_forest(forest, late, ["k"])
    before, after = ({(r.k, r.shard): r for r in f.collect()} for f in (forest, corrected))
    changed = {key for key, r in after.items() if key not in before or before[key] != r}
    assert changed == {("a", 19720 // trailing.SHARD_DAYS), ("new", 19000 // trailing.SHARD_DAYS)}
    moved = [k for k, (x, y) in enumerate(zip(before["a", 308].sums, after["a", 308].sums, strict=True)) if x != y]
    node, path = trailing.SHARD_DAYS + 19720 % trailing.SHARD_DAYS, []
    while node:
        path.append(node)
        node >>= 1
    assert moved == sorted(path)
    totals = {(r.k, r.day): r.total for r in trailing.query_forest(corrected, ["k"], [1]).collect()}
    assert totals["new", date(2022, 1, 8)] == 4.0


def test_empty_and_clashing_names(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert rows(trailing.trailing_totals(empty, ["k"], "day", "v", F.col("ok"))) == []
    clash = spark.createDataFrame([("x", date(2024, 1, 1), 1.0, True, 9, 9)], "shard string, day date, v double, ok boolean, day_no int, sums int")
    with pytest.raises(ValueError):
        trailing.query_forest(spark.createDataFrame([], "k string"), ["k"], [0])
    renamed = clash.withColumnRenamed("shard", "k")
    assert trailing.trailing_totals(renamed, ["k"], "day", "v", F.col("ok"), [7]).count() == 1


def test_means_at_rounding_boundaries_do_not_depend_on_the_order_of_addition(spark):
    chance, start, exact, data = random.Random(11), date(2024, 1, 20), {}, []
    for k in map(str, range(60)):
        hundredths = [chance.randrange(1, 9000) for _ in range(96)]
        hundredths[0] += (3 - sum(hundredths)) % 6  # 3, 9, 15 ... hundredths over 96 readings: the seventh place of the mean is a 5, the last
        exact[k] = Decimal(sum(hundredths)) / 100
        data += [(k, start + timedelta(days=n % 32), x / 100, True, 1.0) for n, x in enumerate(hundredths)]
    for rows_ in (data, data[::-1], chance.sample(data, len(data))):
        totals = trailing.trailing_totals(spark.createDataFrame(rows_, SCHEMA), ["k"], "day", "v", F.col("ok"), [32])
        last = totals.where(F.col("day") == start + timedelta(days=31)).select("k", "total", "readings", F.round("mean", 6).alias("mean"))
        found = {r.k: (r.total, r.readings, r.mean) for r in last.collect()}
        assert found == {k: (float(x), 96, float((x / 96).quantize(Decimal("0.000001"), ROUND_HALF_UP))) for k, x in exact.items()}


def test_decimals_and_their_corrections_add_up_without_error_and_large_values_stay(spark):
    start = date(2024, 3, 1)
    df = spark.createDataFrame([("a", start, 0.1, True, 1.0), ("b", start, 1.5e308, True, 1.0), ("c", start, 1e-9, True, 1.0), ("d", start, float("inf"), True, 1.0)], SCHEMA)
    forest = trailing.build_forest(trailing.day_leaves(df, ["k"], "day", "v", F.col("ok")), ["k"])
    late = spark.createDataFrame([("a", (start - date(1970, 1, 1)).days, 0.2, 1)], "k string, day_no int, sum_change double, count_change bigint")
    found = {r.k: (r.total, r.mean, r.readings) for r in trailing.query_forest(trailing.correct_forest(forest, late, ["k"]), ["k"], [2]).collect()}
    assert found.pop("a") == (0.3, 0.15, 2)
    assert found.pop("d") == (float("inf"), float("inf"), 1)
    assert found == {"b": (pytest.approx(1.5e308),) * 2 + (1,), "c": (pytest.approx(1e-9, abs=0),) * 2 + (1,)}
