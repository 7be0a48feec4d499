import math
import random
from datetime import datetime, timedelta

import pytest

from brezza.operators import spikes

SCHEMA = "s int, ts timestamp_ntz, v double, largest double, period int"
T0 = datetime(2024, 1, 1)


def series(s, n, seed, level=40.0, digits=2):
    chance = random.Random(seed)
    noise, out = 0.0, []
    for k in range(n):
        noise = 0.9 * noise + chance.gauss(0, 0.02)
        out.append(round(level * math.exp(0.3 * math.sin(k / 24 * 2 * math.pi) + noise), digits))
    return [[s, T0 + timedelta(hours=k), v, 2000.0, 60] for k, v in enumerate(out)]


def found(spark, data):
    df = spark.createDataFrame([tuple(r) for r in data], SCHEMA)
    got = spikes.flag_readings(df, ["s"], "ts", "v", "largest", "period").collect()
    return {(r.s, int((r.ts - T0).total_seconds() // 3600), r.reason) for r in got}


@pytest.fixture(scope="module")
def planted():
    data, wanted = [], set()
    for s in range(4):
        own = series(s, 1600, s)
        chance = random.Random(100 + s)
        for at, width, factor in [(100, 1, 4.0), (300, 2, 6.0), (511, 3, 5.0), (700, 1, 0.0), (1020, 1, 0.02), (1400, 1, 8.0)]:
            for k in range(at, at + width):
                own[k][2] = round(own[k][2] * factor * chance.uniform(0.95, 1.05), 2)
                wanted.add((s, k, "spike"))
        for k in range(900, 930):
            own[k][2] = own[900][2]
            wanted.add((s, k, "stuck"))
        # Over more than one edge of a block.
        for k in range(1500, 1560):
            own[k][2] = 0.0
            wanted.add((s, k, "stuck"))
        own[50][2], own[60][2], own[70][2] = -9999.0, 9999.0, None
        wanted |= {(s, 50, "impossible"), (s, 60, "impossible")}
        # An episode that builds up and fades, and a lasting shift of level, are no cases.
        for k in range(1100, 1140):
            own[k][2] = round(own[k][2] * (1 + 4 * math.exp(-(((k - 1120) / 8) ** 2))), 2)
        for k in range(1200, 1600):
            if not 1500 <= k < 1560:
                own[k][2] = round(own[k][2] * 2.5, 2)
        data += own
    return data, wanted


def test_planted_cases(spark, planted):
    data, wanted = planted
    assert found(spark, data) == wanted


def test_blocks_do_not_matter(spark, planted, monkeypatch):
    data, wanted = planted
    monkeypatch.setattr(spikes, "BLOCK", 20)
    assert found(spark, data) == wanted


def test_repeated_rows_order_and_clashing_columns(spark, planted):
    data, wanted = planted
    shuffled = data[:1600]
    random.Random(1).shuffle(shuffled)
    df = spark.createDataFrame([(*r, 1, 2) for r in shuffled], SCHEMA + ", block int, reason int")
    got = spikes.flag_readings(df, ["s"], "ts", "v", "largest", "period").collect()
    assert {(r.s, int((r.ts - T0).total_seconds() // 3600), r.reason) for r in got} == {w for w in wanted if w[0] == 0}


def test_low_coarse_and_tiny_series(spark):
    chance = random.Random(3)
    low = [(1, T0 + timedelta(hours=k), round(chance.choice([0.1, 0.1, 0.2, 0.2, 0.3, 0.0]), 1), None, 60) for k in range(800)]
    coarse = [(2, T0 + timedelta(days=k), float(20 + chance.choice([0, 0, 1, 1, 2, -1])), None, 1440) for k in range(500)]
    tiny = [(3, T0, 5.0, None, 60), (3, T0 + timedelta(hours=1), 500.0, None, 60), (4, T0, -1.0, None, None)]
    odd = [(None, T0, 5.0, None, 60), (5, None, 5.0, None, 60), (6, T0, float("nan"), None, 60)]
    assert found(spark, [*low, *coarse, *tiny, *odd]) == {(4, 0, "impossible"), (6, 0, "impossible")}


def test_empty(spark):
    assert found(spark, []) == set()


@pytest.mark.parametrize("sigmas", [-1.0, 1e9])
def test_the_threshold_of_the_details_decides(spark, planted, monkeypatch, sigmas):
    """Opened, it takes ordinary wiggles for spikes; closed, it finds none; the other reasons do not depend on it."""
    data, wanted = planted
    monkeypatch.setattr(spikes, "DETAIL_SIGMAS", sigmas)
    got = found(spark, data)
    assert {g for g in got if g[2] != "spike"} == {w for w in wanted if w[2] != "spike"}
    number = sum(1 for g in got if g[2] == "spike")
    assert number == 0 if sigmas > 0 else number > 3 * sum(1 for w in wanted if w[2] == "spike")


def test_width_is_a_parameter_and_wide_pulses_are_no_spikes(spark):
    chance = random.Random(8)
    data = [[1, T0 + timedelta(hours=k), round(50 + chance.gauss(0, 1), 2), 2000.0, 60] for k in range(900)]
    for at, width in [(100, 5), (400, 9)]:
        for k in range(at, at + width):
            data[k][2] = round(data[k][2] * 4, 2)
    df = spark.createDataFrame([tuple(r) for r in data], SCHEMA)

    def hours(most):
        return {int((r.ts - T0).total_seconds() // 3600) for r in spikes.flag_readings(df, ["s"], "ts", "v", "largest", "period", most).collect()}

    assert hours(5) == set(range(100, 105))
    assert hours(9) == set(range(100, 105)) | set(range(400, 409))
    with pytest.raises(ValueError):
        hours(0)


def test_gaps_and_opposite_spikes(spark):
    """A spike between gaps of hours, two drops with ordinary readings between them, and a series that drifts over a long gap."""
    chance = random.Random(9)
    data = [[1, T0 + timedelta(hours=k), round(50 + chance.gauss(0, 1), 2), 2000.0, 60] for k in range(1200)]
    data[300][2] = 500.0
    data[600][2], data[603][2] = 0.5, 0.7
    for k in range(900, 1200):
        data[k][2] = round(data[k][2] * 1.6, 2)
    gaps = {*range(297, 300), *range(301, 304), *range(850, 900)}
    assert found(spark, [r for k, r in enumerate(data) if k not in gaps]) == {(1, 300, "spike"), (1, 600, "spike"), (1, 603, "spike")}


def test_sparse_blocks_are_judged_like_full_ones(spark, monkeypatch):
    """Blocks of one or two readings each."""
    chance = random.Random(10)
    data = [[1, T0 + timedelta(hours=k), round(50 + chance.gauss(0, 1), 2), 2000.0, 60] for k in range(300)]
    wanted = set()
    for at, width in [(50, 1), (90, 3), (150, 5), (200, 2)]:
        for k in range(at, at + width):
            data[k][2] = round(data[k][2] * 5, 2)
            wanted.add((1, k, "spike"))
    monkeypatch.setattr(spikes, "BLOCK", 2)
    assert found(spark, data) == wanted


def test_periods_of_one_key_are_series_of_their_own(spark):
    chance = random.Random(12)
    hourly = [[1, T0 + timedelta(hours=k), round(50 + chance.gauss(0, 1), 2), 2000.0, 60] for k in range(400)]
    daily = [[1, T0 + timedelta(days=k), round(5 + chance.gauss(0, 0.1), 2), 2000.0, 1440] for k in range(400)]
    hourly[200][2] = 400.0
    assert found(spark, [*hourly, *daily]) == {(1, 200, "spike")}
