"""Abrupt drops that stop above a tenth of the level around them."""

import random
from datetime import timedelta

from tests.test_spikes import T0, found


def test_far_drops_count_whatever_their_ratio(spark):
    chance = random.Random(5)
    data = [[1, T0 + timedelta(hours=k), round(40 + chance.gauss(0, 1), 2), 2000.0, 60] for k in range(1500)]
    wanted = set()
    for at, width, value in [(200, 1, 8.0), (500, 2, 12.0), (900, 3, 16.0)]:
        for k in range(at, at + width):
            data[k][2] = value + 0.1 * (k - at)
            wanted.add((1, k, "spike"))
    # Six deviations below: not far enough.
    data[1200][2] = 34.0
    assert found(spark, data) == wanted
