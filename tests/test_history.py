import random
from datetime import date, datetime, timedelta

from brezza.operators.history import snapshot_versions
from brezza.plans.pipeline import STATION_ATTRIBUTES, merge_snapshot
from tests.conftest import rows

SCHEMA = "k int, name string, height double, day date, loaded timestamp"
D = [date(2024, 1, 1) + timedelta(days=10 * i) for i in range(6)]
L = datetime(2024, 1, 1, 5)


def versions(spark, data, earlier=None):
    df = spark.createDataFrame(data, SCHEMA)
    before = spark.createDataFrame(earlier, "k int, name string, height double, valid_from date, valid_to date") if earlier is not None else None
    return rows(snapshot_versions(df, ["k"], ["name", "height"], "day", "loaded", before), "k", "valid_from", "valid_to")


def test_changes_absences_and_untidiness(spark):
    data = [
        (1, "Alpha", 1.0, D[0], L), (1, " al\tpha ", 1.0000000004, D[1], L), (1, "ALPHA", 1.5, D[2], L), (1, "Alpha", 1.5, D[4], L), (1, None, 1.5, D[5], L),
        (2, "", None, D[1], L), (2, None, None, D[2], L), (3, "x", 1.0, D[5], L),
        (4, "old", 1.0, D[0], L), (4, "new", 1.0, D[0], L + timedelta(hours=1)), (4, "new", 1.0, D[1], L), (4, "new", 1.0, D[1], L),
        (None, "x", 1.0, D[3], L), (5, "x", 1.0, None, L), (6, "x", 1.0, D[3], None),
    ]
    assert versions(spark, data) == sorted(
        [(1, D[0], D[2]), (1, D[2], D[3]), (1, D[4], D[5]), (1, D[5], None), (2, D[1], D[2]), (2, D[2], D[3]), (3, D[5], None), (4, D[0], D[2]), (6, D[3], D[4])],
        key=lambda r: tuple((x is not None, str(x)) for x in r),
    )


def test_an_earlier_history_goes_on(spark):
    earlier = [(1, "a", 1.0, date(2023, 1, 1), None), (2, "a", 1.0, date(2023, 1, 1), None), (3, "a", 1.0, date(2022, 1, 1), date(2023, 1, 1)), (3, "b", 1.0, date(2023, 1, 1), None), (4, "gone", 1.0, date(2023, 1, 1), None)]
    data = [(1, "A", 1.0, D[0], L), (1, "A", 1.0, D[1], L), (2, "b", 1.0, D[0], L), (3, "b", 1.0, D[1], L)]
    assert versions(spark, data, earlier) == sorted(
        [(1, date(2023, 1, 1), None), (2, date(2023, 1, 1), D[0]), (2, D[0], D[1]), (3, date(2022, 1, 1), date(2023, 1, 1)), (3, date(2023, 1, 1), D[0]), (3, D[1], None), (4, date(2023, 1, 1), D[0])],
        key=lambda r: tuple((x is not None, str(x)) for x in r),
    )


def test_without_snapshots_the_earlier_history_is_the_result(spark):
    assert versions(spark, [], [(1, "a", 1.0, date(2023, 1, 1), None)]) == [(1, date(2023, 1, 1), None)]
    assert versions(spark, []) == []


def test_against_brute_force(spark):
    chance = random.Random(2)
    data = [(k, chance.choice("ab"), 1.0, d, L) for k in range(30) for d in D if chance.random() < 0.8]
    held = {(k, d): n for k, n, _, d, _ in data}
    wanted = []
    for k in range(30):
        open_ = None
        for d in D:
            now = held.get((k, d))
            if open_ and now != open_[0]:
                wanted.append((k, open_[1], d))
                open_ = None
            if now is not None and open_ is None:
                open_ = (now, d)
        if open_:
            wanted.append((k, open_[1], None))
    assert versions(spark, data) == sorted(wanted, key=lambda r: tuple((x is not None, str(x)) for x in r))


def test_merging_snapshots_one_by_one_gives_the_same(spark):
    columns = "station_id int, pollutant_id int, station_name string, municipality string, province string, address string, altitude_m double, longitude double, latitude double, pollutant_name string, unit_original string"

    def snapshot(names):
        return spark.createDataFrame([(k, 1, n, "m", "p", "a", 1.0, 2.0, 3.0, "x", "u") for k, n in names.items()], columns)

    days = [{1: "a", 2: "b"}, {1: "a"}, {1: "c", 2: "b"}]
    history = None
    for d, names in zip(D, days, strict=False):
        history = merge_snapshot(history, snapshot(names), d)
    assert set(STATION_ATTRIBUTES) <= set(history.columns)
    assert rows(history, "station_id", "valid_from", "valid_to") == sorted([(1, D[0], D[2]), (1, D[2], None), (2, D[0], D[1]), (2, D[2], None)], key=lambda r: tuple((x is not None, str(x)) for x in r))


def test_what_counts_as_a_difference_is_a_parameter(spark):
    data = [(1, date(2024, 1, 1), None, "Via Roma", 1.0), (1, date(2024, 2, 1), None, "via  roma", 1.0000001)]
    df = spark.createDataFrame(data, "k int, day date, loaded timestamp, name string, x double")

    def number(**options):
        return snapshot_versions(df, ["k"], ["name", "x"], "day", "loaded", **options).count()

    assert (number(), number(fold=False), number(decimals=None), number(decimals=8), number(decimals=3)) == (1, 2, 2, 2, 1)
