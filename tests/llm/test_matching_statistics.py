"""Matching statistics of the FM-index against a brute-force count, and the intervals that it reports."""

import random

import numpy as np
import pytest

from sommelix.llm import substring_dedup


def places_with(sequence, run):
    return sum(sequence[i : i + len(run)] == run for i in range(len(sequence) - len(run) + 1))


def brute(sequence, first, stop, last):
    out = []
    for i in range(first, stop):
        n = 0
        while i + n < last and places_with(sequence, sequence[i : i + n + 1]) >= 2:
            n += 1
        out.append(n)
    return out


@pytest.mark.parametrize(("letters", "seed"), [(1, 1), (2, 2), (3, 3), (40, 4)])
def test_statistics(letters, seed):
    rnd = random.Random(seed)
    sequence, begins, ends = [], [], []
    for _ in range(12):
        begins.append(len(sequence))
        sequence += [rnd.randint(1, letters) for _ in range(rnd.randint(1, 25))]
        ends.append(len(sequence))
        sequence.append(0)
    index = substring_dedup.FmIndex(np.array(sequence), 25)
    got = index.statistics(np.array(sequence), np.array(begins), np.array(ends), np.array(ends))
    assert [x.tolist() for x in got] == [brute(sequence, a, b, b) for a, b in zip(begins, ends)]


def test_nearest_smaller():
    rnd = random.Random(5)
    for top in (1, 2, 50):
        values = np.array([-1] + [rnd.randint(0, top) for _ in range(300)] + list(range(60)) + [0, 0] + [-1])
        wanted = [max((j for j in range(i) if values[j] < values[i]), default=0) for i in range(len(values))]
        assert substring_dedup.FmIndex._nearest_smaller(values).tolist() == wanted


def test_intervals_are_whole_and_not_within_others():
    rnd = random.Random(6)
    words = lambda n: [b"w%d" % rnd.randrange(10**6) for _ in range(n)]
    shared, other = words(11), words(9)
    texts = [words(3) + shared + words(4), words(2) + shared + other, other + words(5), words(2), shared[:4] + words(8)]
    found = substring_dedup.search_shard([b" ".join(t) for t in texts], 8)  # none longer than a stretch
    assert found == [[[3, 11]], [[2, 11], [13, 9]], [[0, 9]], [], []]


def test_long_repeats_are_one_run():
    text = b" ".join([b"a", b"b", b"c"] * 400)
    (found,) = substring_dedup.search_shard([text], 5)
    # the last windows occur once more before, as all do
    assert substring_dedup._runs(found, 5) == [[0, 1196]]
