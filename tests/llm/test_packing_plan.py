"""Plans of the packing, on counts of lengths, against plain best-fit decreasing and the least possible."""

import collections

import numpy as np
import pytest

from rosterlens.llm import packing

CAPACITY = 4096


def best_fit_decreasing(lengths):
    rooms = []
    for x in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= x]
        room = min(fits) if fits else CAPACITY
        if fits:
            rooms.remove(room)
        rooms.append(room - x)
    return len(rooms)


def planned(lengths, groups=64):
    counts = collections.Counter(lengths)
    large_from, intervals, bins = packing.plan(counts, CAPACITY, groups)
    large = {k: n for k, n in counts.items() if k >= large_from}
    small = {k: n for k, n in counts.items() if k < large_from}
    order = sorted((x for x in lengths if x >= large_from), reverse=True)
    seats = collections.Counter()
    held = collections.Counter()
    for begin, end, first, slot in intervals:
        for at in range(begin, end):
            seats[at] += 1
            held[first + at - begin] += order[at]
    assert set(seats) == set(range(len(order))) and set(seats.values()) <= {1}
    assert sorted(held) == list(range(bins)) and max(held.values(), default=0) <= CAPACITY
    rooms = collections.Counter(CAPACITY - x for x in held.values())
    assert packing.rooms_left(intervals, large, CAPACITY) == dict(rooms)
    return bins + packing.plan_small(rooms, small, CAPACITY)[1]


@pytest.mark.parametrize("mean, spread, rows", [(5.8, 1.0, 4000), (6.4, 1.0, 2000), (5.0, 0.7, 3000)])
def test_mixed_lengths_take_no_more_than_best_fit_decreasing(mean, spread, rows):
    rng = np.random.default_rng(7)
    lengths = np.minimum(CAPACITY, np.maximum(1, rng.lognormal(mean, spread, rows))).astype(int).tolist()
    n = planned(lengths)
    assert -(-sum(lengths) // CAPACITY) <= n <= best_fit_decreasing(lengths)


def test_large_lengths_alone():
    rng = np.random.default_rng(8)
    lengths = rng.integers(513, 4097, 1500).tolist()
    assert planned(lengths) <= 1.01 * best_fit_decreasing(lengths)


@pytest.mark.parametrize("lengths, n", [
    ([], 0), ([1], 1), ([4096] * 3, 3), ([2048] * 6, 3), ([4096, 4096, 4096, 513, 1000, 1000, 5], 4), ([3000, 1096] * 50, 50),
    ([1] * 4097, 2), ([1500] * 2 + [1096] * 1, 1)])
def test_few_lengths(lengths, n):
    assert planned(lengths) == n


def test_the_programme_reaches_the_least_cost():
    # 2 of 2000, 4 of 1000: two sequences, each of 1 x 2000 + 2 x 1000
    sizes, counts = np.array([2000, 1000]), np.array([2, 4])
    cost = np.append(np.zeros(1), np.ones(CAPACITY))
    assert sum(times for _, times in packing._optimal(sizes, counts, cost)) == pytest.approx(2.0)
