"""Overlays, outlines, partitions, shared borders and faults of areas, against brute force on small shapes."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sommelix.operators import borders, dissolve, overlay, packaging, partition, tiling, validity
from sommelix.operators.quality import QualityError

SCHEMA = "k long, rings array<array<struct<x: double, y: double>>>"


def box(x, y, w, h=None):
    h = w if h is None else h
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]


def area(ring):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:])) / 2


def clip(subject, convex):
    """A polygon within a convex counterclockwise one (by half planes)."""
    for a, b in zip(convex, convex[1:]):
        inside = lambda p: (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])  # noqa: B023, E731
        out = []
        for p, q in zip(subject, subject[1:] + subject[:1]):
            sp, sq = inside(p), inside(q)
            if sp >= 0:
                out.append(p)
            if sp * sq < 0:
                t = sp / (sp - sq)
                out.append((p[0] + (q[0] - p[0]) * t, p[1] + (q[1] - p[1]) * t))
        subject = out
    return abs(area(subject + subject[:1])) if len(subject) > 2 else 0.0


def convex_ring(rnd, x, y, r):
    angles = sorted(rnd.uniform(0, 2 * math.pi) for _ in range(rnd.randint(3, 7)))
    ring = [(x + r * math.cos(a), y + r * math.sin(a)) for a in angles]
    return [*ring, ring[0]]


def frame(spark, rows):
    return spark.createDataFrame([(k, [[tuple(map(float, p)) for p in r] for r in rings]) for k, rings in rows], SCHEMA)


def test_tiles_keep_every_area(spark):
    rnd = random.Random(1)
    rows = [(k, [convex_ring(rnd, rnd.uniform(-50, 50), rnd.uniform(-50, 50), rnd.uniform(0.1, 40))]) for k in range(5)]
    rows += [(20, [box(-3, -3, 6), box(-1, -1, 2)[::-1], box(0.5, 2, 0.25)]), (21, [box(-60, -60, 120)[::-1]])]
    edges = tiling.directed_edges(frame(spark, rows), ["k"])
    pieces = tiling.pieces(edges, ["k"], tiling.frame(edges))
    wanted = {k: abs(area(r[0])) - sum(abs(area(h)) for h in r[1:]) for k, r in rows}
    for split in (pieces, tiling.split(pieces, ["k"]), tiling.split(tiling.split(pieces, ["k"], 4), ["k"], 4)):
        got = {r.k: r.a for r in split.groupBy("k").agg(F.sum(tiling.piece_area()).alias("a")).collect()}
        assert got == pytest.approx(wanted)
    assert {r.k: r.area for r in tiling.area_of(frame(spark, rows), "k").collect()} == pytest.approx(wanted)
    whole = tiling.split(pieces, ["k"]).where("k = 21 AND x1 = tx AND x2 = tx + size AND y1 = ty + size AND y2 = y1")
    assert whole.count() >= 16  # a tile inside an area is one piece


def test_overlaps_of_slanted_shapes(spark, monkeypatch):
    rnd = random.Random(2)
    shapes = {k: convex_ring(rnd, rnd.uniform(0, 20), rnd.uniform(0, 20), rnd.uniform(1, 8)) for k in range(12)}
    left = frame(spark, [(k, [r]) for k, r in shapes.items() if k < 6])
    right = frame(spark, [(k, [r[::-1]]) for k, r in shapes.items() if k >= 6]).withColumnRenamed("k", "m")
    wanted = {(a, b): clip(shapes[a][:-1], shapes[b]) for a in range(6) for b in range(6, 12)}
    wanted = {p: v for p, v in wanted.items() if v > 1e-9}
    for pairs in (64,):
        monkeypatch.setattr(overlay, "PAIRS", pairs)
        got = {(r.k, r.m): r.overlap_area for r in overlay.overlaps(left, right, "k", "m").collect()}
        assert got == pytest.approx(wanted, rel=1e-9, abs=1e-9)


def test_majority_ties_holes_and_touches(spark):
    areas = frame(spark, [(1, [box(0, 0, 2)]), (2, [box(10, 0, 2)]), (3, [box(4, 4, 2), box(4.5, 4.5, 1)]), (4, [box(100, 100, 1)])])
    regions = frame(spark, [(7, [box(1, 0, 3)]), (8, [box(-2, 0, 3)]), (9, [box(12, 0, 3)]), (10, [box(4.5, 4.5, 1)]), (11, [box(5, 3, 4)])])
    regions = regions.select(F.col("k").alias("region"), "rings")
    got = overlay.majority_overlap(areas, regions, "k").collect()
    assert sorted(map(tuple, got)) == [(1, 7, 2.0, 0.5), (3, 11, 1.5, 0.5)]
    assert overlay.majority_overlap(areas.limit(0), regions, "k").count() == 0


def test_assigned_regions(spark):
    areas = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y")], "aoc_key string, dt string")
    majority = spark.createDataFrame([("a", "North", 0.8), ("b", "South", 0.6)], "aoc_key string, region string, overlap_ratio double")
    got = overlay.assigned_regions(areas, majority, {"b": "East"}, {"y": "West", "z": "None"})
    assert sorted(map(tuple, got.collect())) == [
        ("a", "x", "North", "majority_overlap", 0.8), ("b", "x", "East", "explicit_override", None), ("c", "y", "West", "delegation_fallback", None),
    ]
    for overrides, fallbacks, fault in (({"q": "East"}, {"y": "West"}, "absent q"), ({}, {}, "1 areas without a region, the first c")):
        with pytest.raises(QualityError, match=fault):
            overlay.assigned_regions(areas, majority, overrides, fallbacks)
    with pytest.raises(QualityError, match="repeated a"):
        overlay.assigned_regions(areas.unionByName(areas), majority, {"a": "East"}, {"y": "West"})


def test_dissolve_with_hole_corner_and_divided_border(spark):
    cells = [(1, [box(x, y, 1)]) for x in range(3) for y in range(3) if (x, y) != (1, 1)]
    cells += [(2, [box(0, 0, 1)]), (2, [box(1, 1, 1)])]  # meet in a corner only
    cells += [(3, [box(0, 0, 1, 2)]), (3, [box(1, 0, 1)]), (3, [box(1, 1, 1)[::-1]])]  # one border divided on one side
    cells += [(4, [[(0, 0), (2, 1), (0, 2), (0, 0)]]), (4, [[(2, 1), (4, 1), (0, 2), (2, 1)]]), (5, []), (6, [[(0, 0), (1, 1), (0, 0)]])]
    got = {r.k: [[tuple(p) for p in ring] for ring in r.rings] for r in dissolve.dissolved(frame(spark, cells), "k").collect()}
    assert sorted(got) == [1, 2, 3, 4]
    assert sorted(area(r) for r in got[1]) == [-1.0, 9.0] and [len(r) for r in got[1]] == [5, 5]
    assert [area(r) for r in got[2]] == [1.0, 1.0]
    assert [(len(r), area(r)) for r in got[3]] == [(5, 4.0)]
    assert [(len(r), area(r)) for r in got[4]] == [(5, 3.0)]


def test_holes_find_their_outline(spark):
    rows = frame(spark, [(1, [box(0, 0, 10), box(1, 1, 8), box(2, 2, 4), box(3, 3, 1), box(20, 0, 3), box(21, 1, 1)])])
    made = dissolve.rings(dissolve.cancelled(tiling.directed_edges(rows, ["k"]), ["k"]), ["k"])
    got = dissolve.nested(made, "k", 3.0).collect()
    sizes = {}
    for r in got:
        sizes.setdefault(r.polygon, {})[r.hole] = abs(area([tuple(p) for p in r.ring]))
    assert sorted(sizes.values(), key=lambda s: s[False]) == [{False: 9.0, True: 1.0}, {False: 16.0, True: 1.0}, {False: 100.0, True: 64.0}]


def test_smallest_wins_on_a_lattice(spark, monkeypatch):
    rnd = random.Random(4)
    rows = [(k, [box(rnd.randrange(12), rnd.randrange(12), rnd.randint(1, 6), rnd.randint(1, 6))]) for k in range(25)]
    rows += [(30, rows[0][1]), (31, [box(2, 2, 8), box(4, 4, 3)[::-1]])]
    size = {k: abs(area(r[0])) - sum(abs(area(h)) for h in r[1:]) for k, r in rows}
    order = sorted(size, key=lambda k: (size[k], str(k), k))
    shapes = dict(rows)
    cover = lambda k, x, y: sum(min(p[0] for p in r) < x < max(p[0] for p in r) and min(p[1] for p in r) < y < max(p[1] for p in r) for r in shapes[k]) == 1
    owner = {(x, y): next((k for k in order if cover(k, x + 0.5, y + 0.5)), None) for x in range(20) for y in range(20)}
    left = {k: float(sum(o == k for o in owner.values())) for k in size}
    areas = frame(spark, rows).withColumn("name", F.col("k").cast("string"))
    for few in (12,):
        monkeypatch.setattr(partition, "PIECES", few)
        outlines, report = partition.smallest_wins(areas, "k", "name")
        got = report.orderBy("priority_rank").collect()
        assert [r.k for r in got] == order
        assert {r.k: r.final_area for r in got} == pytest.approx(left)
        assert {r.k for r in got if r.became_empty} == {k for k, v in left.items() if not v}
        rings = {r.k: [[tuple(p) for p in ring] for ring in r.rings] for r in outlines.collect()}
        assert {k: sum(map(area, r)) for k, r in rings.items()} == pytest.approx({k: v for k, v in left.items() if v})
    metrics = partition.overlap_metrics(areas, "k").first()
    assert (metrics.summed_area, metrics.union_area) == pytest.approx((sum(size.values()), sum(left.values())))


def test_slanted_partition_is_disjoint_and_keeps_the_union(spark):
    rnd = random.Random(9)
    rows = [(k, [convex_ring(rnd, rnd.uniform(0, 10), rnd.uniform(0, 10), rnd.uniform(1, 6))]) for k in range(4)]
    areas = frame(spark, rows).withColumn("name", F.lit("same"))
    outlines, report = partition.smallest_wins(areas, "k", "name")
    final = {r.k: r.final_area for r in report.collect() if not r.became_empty}
    assert {r.k: r.area for r in tiling.area_of(outlines, "k").collect()} == pytest.approx(final)
    own = partition.joined(areas, "name")  # disjoint, and nothing of the union is lost
    assert tiling.area_of(own, "name").first().area == pytest.approx(sum(final.values()))


def test_overlapping_keys_are_joined_apart(spark):
    parts = frame(spark, [(1, [box(0, 0, 2)]), (1, [box(1, 1, 2)]), (2, [box(0, 0, 3)]), (2, [box(1, 1, 1)])])
    got = {r.k: [[tuple(p) for p in ring] for ring in r.rings] for r in partition.joined(parts, "k").collect()}
    assert {k: [(len(r), area(r)) for r in rings] for k, rings in got.items()} == {1: [(9, 7.0)], 2: [(5, 9.0)]}


def test_packages_signals_and_gates(spark):
    rows = [(3, "A", "1", "D", "Vin mousseux", [box(0, 0, 1)]), (1, "A ", "1", "D", " Vin tranquille", [box(0.5, 0, 1)]), (2, "B", "2", "D", "Cidre", [box(9, 9, 1)]), (4, "B", "2", "E", None, [box(9, 9, 1)])]
    schema = "source_order long, app string, id_app string, dt string, categorie string, rings array<array<struct<x: double, y: double>>>"
    make = lambda rows: spark.createDataFrame([(*r[:5], [[tuple(map(float, p)) for p in ring] for ring in r[5]]) for r in rows], schema)
    made, out, mixed = packaging.packaged(make(rows), 0.1)
    assert [(r.app, r.id_app, r.dt, r.categorie, area(r.rings[0])) for r in made.collect()] == [("A", "1", "D", "Vin tranquille", 1.5)]
    assert sorted(map(tuple, out.collect()), key=str) == [("B", "2", "Cidre"), ("B", "2", None)]
    assert [list(r.categories) for r in mixed.collect()] == [["Vin mousseux", "Vin tranquille"]]
    with pytest.raises(QualityError, match="no parcel is one of wine"):
        packaging.packaged(make(rows[2:]), 0.1)
    with pytest.raises(QualityError, match="1 groups without just one dt, the first A"):
        packaging.packaged(make([rows[0], (5, "A", "1", "X", "vin", rows[0][5])]), 0.1)
    signals = lambda text: spark.range(1).select(packaging.prompt_signals(F.lit(text).cast("string")).alias("s")).first().s
    assert signals("Vin mousseux, Vin jaune,,Vin pétillant") == ["sparkling", "oxidative_speciality"] and signals("Vin tranquille") == []
    for text, fault in ((None, "no category"), (" , ", "no category"), ("Vin jaune, Vin bleu, Rosé", "without a signal: Rosé, Vin bleu")):
        with pytest.raises(Exception, match=fault):
            signals(text)
    regions, reviews = spark.createDataFrame([("a",), ("b",)], "r string"), spark.createDataFrame([("a", "approved"), ("b", None)], "r string, review_status string")
    assert packaging.review_gate(regions, reviews, "r", False).count() == 0
    assert [tuple(r) for r in packaging.review_gate(regions, reviews, "r", True).collect()] == [("not approved", 1, "b")]
    compared = packaging.legacy_comparison(regions, reviews.limit(1), "r", ["review_status", "gone"]).first()
    assert (compared.candidate_rows, compared.legacy_rows, compared.shared_keys, compared.obsolete_columns) == (2, 1, 1, ["review_status"])


def test_shared_borders_stay_shared(spark):
    rnd = random.Random(6)
    n, fine = 3, 12
    jag = {}

    def border(a, b):
        """Points from corner a to corner b, the same ones both ways."""
        if (b, a) in jag:
            return jag[b, a][::-1]
        if (a, b) not in jag:
            line = [(a[0] + (b[0] - a[0]) * t / fine, a[1] + (b[1] - a[1]) * t / fine) for t in range(fine + 1)]
            jag[a, b] = [a, *[(x + rnd.uniform(-0.04, 0.04), y + rnd.uniform(-0.04, 0.04)) for x, y in line[1:-1]], b]
        return jag[a, b]

    rows = []
    for i in range(n):
        for j in range(n):
            c = [(i, j), (i + 1, j), (i + 1, j + 1), (i, j + 1)]
            ring = sum((border(a, b)[:-1] for a, b in zip(c, c[1:] + c[:1])), [])
            rows.append((3 * i + j, [[*ring, ring[0]]]))
    circle = [(20 + math.cos(t * math.pi / 30), math.sin(t * math.pi / 30)) for t in range(60)]
    rows += [(50, [[*circle, circle[0]]]), (51, [box(30, 0, 0.01)]), (52, [[(0, 0), (1, 1), (0, 0)]])]
    for tolerance in (0.0, 0.06, 5.0):
        got = {r.k: [[tuple(p) for p in ring] for ring in r.rings] for r in borders.simplified(frame(spark, rows), "k", tolerance).collect()}
        assert sorted(got) == [*range(9), 50, 51]
        count = {}
        for k in range(9):
            for a, b in zip(got[k][0], got[k][0][1:]):
                count[min(a, b), max(a, b)] = count.get((min(a, b), max(a, b)), 0) + 1
        inner = sum(1 for (a, b), m in count.items() if m == 2)
        assert set(count.values()) <= {1, 2} and inner >= 12  # each inner border has its edges twice
        outer = sum(area(got[k][0]) for k in range(9))
        assert all(len(r) >= 4 and r[0] == r[-1] for rings in got.values() for r in rings)
        for k, rings in rows[:-1]:
            new = np.array(got[k][0])
            for p in rings[0]:
                far = min(borders._distances(np.array([p]), a, b)[0] for a, b in zip(new, new[1:]))
                assert far <= tolerance + 1e-12
        if tolerance == 0.06:
            assert sum(len(got[k][0]) for k in range(9)) < sum(len(r[0]) for _, r in rows[:9]) / 3
        if tolerance == 0.0:
            assert outer == pytest.approx(sum(area(r[0]) for _, r in rows[:9]))


def test_faults_have_kind_and_place(spark):
    rows = [
        (1, [box(0, 0, 2)]),
        (2, [[(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)]]),
        (3, [[(0, 0), (1, 0), (1, 1)]]),
        (4, [[(0, 0), (1, 0), (1, 0), (1, 1), (0, 0)]]),
        (5, [box(0, 0, 3), box(2, 1, 2)]),
        (6, []),
        (7, [[(0, 0), (4, 0), (4, 1), (2, 1), (2, 0), (1, 0), (1, 1), (0, 1), (0, 0)]]),
        (8, [[(0, 0), (1, 1), (2, 2), (0, 0)]]),
        (9, [[(0, 0), (float("nan"), 0), (1, 1), (0, 0)]]),
        (10, [[]]),
    ]
    for cell in (0.3, 1.0, 50.0):
        got = sorted((r.k, r.kind, r.x, r.y) for r in validity.faults(frame(spark, rows), "k", cell).where("kind <> 'null or non-finite' AND x IS NOT NULL").collect())
        assert got == [
            (2, "crossing", 1.0, 1.0), (2, "no area", 0.0, 0.0), (3, "not closed", 1.0, 1.0), (3, "too few points", 0.0, 0.0), (4, "repeated point", 1.0, 0.0),
            (5, "crossing", 3.0, 1.0), (5, "overlap", 2.0, 3.0), (7, "overlap", 1.0, 0.0),
            (8, "no area", 0.0, 0.0), (8, "overlap", 0.0, 0.0), (8, "overlap", 1.0, 1.0),
        ]
    with pytest.raises(QualityError, match="crossing: 2, first in 2 at \\(1.0, 1.0\\)"):
        validity.require_valid(frame(spark, rows), "k", 1.0)
    assert validity.require_valid(frame(spark, rows[:1]), "k", 1.0).count() == 1
    assert {r.k for r in validity.ring_faults(frame(spark, rows), "k").where("x IS NULL").collect()} == {6, 9, 10}


@pytest.mark.parametrize("different", [0.0, 0.001])
def test_crowded_tiles_with_few_pieces_of_one_side_are_not_split(spark, monkeypatch, different):
    def no_split(*_):
        raise AssertionError("a split makes no pair fewer here")

    monkeypatch.setattr(tiling, "split", no_split)
    box = lambda x, y, side: [[(x, y), (x + side, y), (x + side, y + side), (x, y + side), (x, y)]]
    shape = "array<array<struct<x: double, y: double>>>"
    left = spark.createDataFrame([(k, box(k * different, 0.0, 2.0)) for k in range(1000)], f"k int, rings {shape}")
    right = spark.createDataFrame([(m, box(1.0, 1.0, 2.0)) for m in range(4 if different else 400)], f"m int, rings {shape}")
    got = overlay.overlaps(left, right, "k", "m").groupBy("k").agg(F.count("*").alias("n"), F.max("overlap_area").alias("most")).collect()
    assert len(got) == 1000 and {r.n for r in got} == {4 if different else 400}
    assert all(r.most == pytest.approx(1 + r.k * different) for r in got)


def test_crossings_are_the_same_row_by_row_and_by_cell(spark, monkeypatch):
    rnd = random.Random(9)
    rows = [(k, [[*p, p[0]] for p in [[(rnd.randint(0, 6), rnd.randint(0, 6)) for _ in range(rnd.randint(1, 7))] for _ in range(2)]]) for k in range(60)]
    areas = frame(spark, rows)
    found = []
    for few in (0, 32):
        monkeypatch.setattr(validity, "FEW_EDGES", few)
        made = validity.crossings(areas, "k", 1.5)
        assert few == 0 or "Exchange" not in made._jdf.queryExecution().analyzed().toString()
        found.append(sorted((r.k, r.kind, round(r.x, 9), round(r.y, 9)) for r in made.collect()))
    assert found[0] == found[1] and len(found[0]) > 50


def test_copies_of_an_area_are_divided_once(spark, monkeypatch):
    given, faces = [], partition.faces
    monkeypatch.setattr(partition, "faces", lambda areas, *more: given.append(areas.count()) or faces(areas, *more))
    rows = [(k, "n", [box(0.0, 0.0, 2.0)]) for k in range(30)] + [(30, "n", [box(1.0, 0.0, 2.0)])]
    outlines, report = partition.smallest_wins(spark.createDataFrame(rows, "k long, name string, rings array<array<struct<x: double, y: double>>>"), "k", "name")
    assert given == [2]
    assert {r.k: r.final_area for r in report.collect() if r.final_area} == {0: 4.0, 30: 2.0}
    assert sorted(r.k for r in outlines.collect()) == [0, 30]


def test_areas_are_dealt_before_points_are_made_of_them(spark, monkeypatch):
    tables = []
    monkeypatch.setattr(borders, "saved", lambda rows: tables.append(rows) or rows, raising=False)
    # an enclave of two arcs: where it needs a point to stay, so does the area around it
    rows = [(1, [[(0, 0), (4, 0), (4, 4), (0, 4), (0, 3), (1, 3), (1, 2), (0, 2), (0, 0)]]), (2, [[(0, 2), (1, 2), (1, 3), (0, 3), (0, 2)]])]
    made = borders.simplified(frame(spark, rows).coalesce(1), "k", 9.0)
    plan = tables[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" in plan and plan.rindex("Generate") < plan.index("RepartitionByExpression")  # what is further down comes first
    got = {r.k: [tuple(p) for p in r.rings[0]] for r in made.collect()}
    assert got[2] == [(0, 2), (1, 2), (0, 3), (0, 2)] and {(0, 2), (1, 2), (0, 3)} < set(got[1]) and (1, 3) not in got[1]


def test_holes_among_many_rings_are_found_by_height(spark, monkeypatch):
    rnd = random.Random(11)
    rows = []
    for k in range(6):
        rings = [box(0, 0, 100)]
        for i in range(9):
            for j in range(9):
                nest = [box(10 * i + 1 + d, 10 * j + 1 + d, 8 - 2 * d) for d in range(rnd.randint(0, 4))]
                rings += [r[::-1] if rnd.random() < 0.5 else r for r in nest]
        rnd.shuffle(rings)
        rows.append((k, [[(y, x) for x, y in r] for r in rings] if k % 2 else rings))
    areas, found = frame(spark, rows), []
    for few in (10**6, 0):
        monkeypatch.setattr(tiling, "FEW_RINGS", few)
        sizes = {r.k: r.area for r in tiling.area_of(areas, "k").collect()}
        found.append((sizes, sorted(map(tuple, tiling.directed_edges(areas, ["k"]).collect()))))
    assert found[0] == found[1] and len(found[0][0]) == 6
    monkeypatch.setattr(tiling, "PAIRS", 7)  # looked at in portions
    rings = [box(0, 0, 10), *[box(1, y, 1) for y in range(1, 9, 2)], box(3, 1, 6), box(4, 2, 4)]
    x, y = np.array([p for r in rings for p in r], float).T
    assert tiling.around_odd(x, y, np.array([len(r) for r in rings])).tolist() == [False, True, True, True, True, True, False]


def test_points_of_a_ring_are_not_made_again_for_each_of_them(spark):
    ring = F.transform("rings", lambda r: F.reverse(r))[0]
    rows = frame(spark, [(1, [[(0, 0), (1, 0), (2, 0), (2, 2)]])])
    made = rows.select(dissolve.straightened(ring).alias("line"), tiling.signed_area(ring).alias("a"))
    assert made._jdf.queryExecution().optimizedPlan().toString().count("reverse(") == 2
    assert len(rows.select(dissolve.straightened(ring).alias("line")).first().line) == 3


def test_a_sweep_sizes_areas_in_their_row(spark, monkeypatch):
    def no_edges(*_):
        raise AssertionError("edges are not needed for sizes")

    monkeypatch.setattr(tiling, "directed_edges", no_edges)
    rows = [(1, [box(0, 0, 4), box(1, 1, 2)]), (2, [box(10, 0, 1), box(12, 0, 1)[::-1]]), (3, [[(0, 0), (1, 1), (0, 0)]])]
    got = borders.sweep(frame(spark, rows).withColumn("region", F.lit("r")), "k", "region", [0.0, 0.5]).collect()
    assert sorted(map(tuple, got)) == [("r", 0.0, 2, 4, 20, 14.0), ("r", 0.5, 2, 4, 20, 14.0)]
