"""Exact top-k search against all scores, on ties, clusters, odd vectors, repeats and small shards."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sommelix.llm import top_k

SCHEMA = "vec_id bigint, embedding array<float>, shard int, score bigint, v string"


def brute(rows, k=5, every=50):
    usable = {}
    for i, e in rows:
        if i is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        v = [math.floor(256 * float(np.float32(x))) for x in e]
        usable[i] = min(usable.get(i, v), v)
    out = []
    for q, a in usable.items():
        if q % every == 0:
            scores = sorted(((-sum(x * y for x, y in zip(a, b)), i) for i, b in usable.items() if i != q))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def search(spark, rows, k=5):
    frame = spark.createDataFrame([(*r, 3, 4, "x") for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, top_k.top_k(frame, F.col("vec_id") % 50 == 0, k).collect()))


def mixed():
    rnd = random.Random(5)
    centre = [[rnd.gauss(0, 1) for _ in range(12)] for _ in range(4)]
    rows = [(i, [c + rnd.gauss(0, 0.3) for c in centre[i % 4]]) for i in range(400)]
    rows += [(1000 + i, centre[0]) for i in range(150)]  # ties
    rows += [(2000, None), (2001, []), (2002, [0.5, None]), (2003, [float("nan")] * 12), (2004, [float("inf"), 1.0]), (2050, [0.0] * 12), (2006, [1.0])]
    rows += [(None, centre[1]), (3000, centre[2]), (3000, centre[2]), (3000, centre[3]), (3001, [3e38] * 12)]
    return [(i, e and [None if x is None else float(np.float32(x)) for x in e]) for i, e in rows]


@pytest.mark.parametrize("shard_rows,cells", [(4096, 1 << 22), (40, 600)])
def test_every_score(spark, monkeypatch, shard_rows, cells):
    monkeypatch.setattr(top_k, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(top_k, "CELLS", cells)
    rows = [r for r in mixed() if r[0] != 3001]
    for k in (1, 5):
        assert search(spark, rows, k) == brute(rows, k)


def test_large_components_are_held(spark):
    rows = [(0, [1e9, 1e9]), (1, [2e9, 1e9]), (2, [1e9, -1e9]), (3, [-3e38, -3e38]), (4, [0.5, 0.25])]
    big = 1 << 24
    assert search(spark, rows) == [(0, 1, 1, 2 * big * big), (0, 2, 4, 192 * big), (0, 3, 2, 0), (0, 4, 3, -2 * big * big)]


def test_few_and_none(spark):
    assert search(spark, []) == []
    assert search(spark, [(1, [1.0]), (2, [2.0])]) == []
    assert search(spark, [(0, [1.0])]) == []
    assert search(spark, [(0, [1.0]), (3, [0.5])]) == [(0, 1, 3, 256 * 128)]
    assert search(spark, [(0, []), (3, [])]) == [(0, 1, 3, 0)]


def test_lists_are_not_read_to_the_end():
    """In clusters most queries are decided before their lists end, and bounds hold after every round."""
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 60, (200, 16))
    rows = np.floor(centres[np.arange(2000) % 200] + rng.normal(0, 6, (2000, 16)))
    lists = top_k.Lists(np.arange(2000), rows)
    for high, low, _ in lists.reading():
        assert (low <= lists.rows).all() and (lists.rows <= high).all()
    asked, rounds = [], lists.reading
    lists.reading = lambda: (asked.append(r[2]) or r for r in rounds())
    queries = np.arange(0, 2000, 100)
    found = lists.top(queries, rows[queries], 3)
    assert not asked[-1]
    scores = rows[queries] @ rows.T
    scores[np.arange(len(queries)), queries] = -np.inf
    assert sorted(zip(found[0], found[2])) == sorted((q, int(s)) for q, line in zip(queries, scores) for s in np.sort(line)[-3:])
