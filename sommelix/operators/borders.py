"""Simplification that keeps the borders which areas share.

Every border is cut into arcs at the points where more or fewer than two edges meet, so an arc is a border of the same areas all
along. Areas that share an arc have it with the same points, perhaps in the other direction; it is always reduced in one
direction, so they are left with the same points of it. So no gap and no overlap can come up along a shared border, and no two
areas need to be looked at together.

An arc follows from either of its end edges, as no other edge meets it on the way. So arcs are told from each other by these, and
rings never leave their row: only points go through a shuffle, to be counted and to be found among those where borders meet.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sommelix.operators import tiling
from sommelix.operators.lineage import saved

#: Stretches of fewer points are looked at without numpy, which is slower for a handful.
FEW_POINTS = 32


def _distances(points: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """From each point to the stretch from a to b."""
    along = b - a
    size = along @ along
    share = np.clip((points - a) @ along / size, 0, 1) if size > 0 else np.zeros(len(points))
    return np.hypot(*(points - a - share[:, None] * along).T)


def _farthest(points: list[tuple[float, float]], s: int, e: int) -> tuple[int, float]:
    """Of the points between two, the first of those farthest from the stretch between these, by its place among them."""
    if e - s > FEW_POINTS:
        line = np.array(points[s : e + 1])
        far = _distances(line[1:-1], line[0], line[-1])
        k = int(far.argmax())
        return k, far[k]
    (ax, ay), *between, (bx, by) = points[s : e + 1]
    ux, uy = bx - ax, by - ay
    size = ux * ux + uy * uy
    best, most = 0, -1.0
    for k, (x, y) in enumerate(between):
        share = min(max(((x - ax) * ux + (y - ay) * uy) / size, 0.0), 1.0) if size > 0 else 0.0
        far = math.hypot(x - ax - share * ux, y - ay - share * uy)
        if far > most:
            best, most = k, far
    return best, most


def reduced(points: list[tuple[float, float]], tolerance: float, least: int) -> list[int]:
    """Which points stay, in order: both ends, and of the others the farthest from the stretch between its neighbours that stay, as long
    as it is farther than the tolerance; at least so many others, if there are any. No point is farther than the tolerance from
    the line that is left."""
    stay = [0, len(points) - 1]
    waiting, kept = [(0, len(points) - 1)], 0
    while waiting:
        # those whose points are needed to keep a ring's shape come first: the widest stretch is looked at next
        s, e = waiting.pop(0) if kept < least else waiting.pop()
        if e - s < 2:
            continue
        k, far = _farthest(points, s, e)
        if far > tolerance or kept < least:
            stay.append(s + 1 + k)
            kept += 1
            waiting += [(s, s + 1 + k), (s + 1 + k, e)]
    return sorted(stay)


def _stay(points: list[tuple[float, float]], nodes: list[int], told: set[int], tolerances: list[float]) -> list[list[int]]:
    """For each tolerance, which points of a closed ring stay, the repeated last one too. Nodes are where arcs begin, the first is 0."""
    ends = [*nodes[1:], len(points) - 1]
    out = [[] for _ in tolerances]
    for k, (s, e) in enumerate(zip(nodes, ends)):
        # a ring of one arc needs two more points, of two arcs one on each; then neighbours leave it there too
        least = 2 if len(nodes) == 1 else int(len(nodes) == 2 or k in told)
        line = points[s : e + 1]
        forth = line[:2] <= line[:-3:-1]
        for stay, tolerance in zip(out, tolerances):
            if e - s < 2:
                stay.append(s)
            elif forth:
                stay += [s + i for i in reduced(line, tolerance, least)[:-1]]
            else:
                stay += [e - i for i in reduced(line[::-1], tolerance, least)[:0:-1]]
    return [[*stay, len(points) - 1] for stay in out]


def _staying(tolerances: list[float]):
    """Function of the closed rings' x and y, their nodes and the arcs that need a point: array<array<int>>, places by tolerance."""

    @F.pandas_udf("array<array<int>>")
    def staying(xs: pd.Series, ys: pd.Series, nodes: pd.Series, told: pd.Series) -> pd.Series:
        rows = zip(xs, ys, nodes, told)
        return pd.Series([_stay(list(zip(x.tolist(), y.tolist())), n.tolist(), set() if t is None else set(t.tolist()), tolerances) for x, y, n, t in rows])

    return staying


def simplified(areas: DataFrame, key: str, tolerance: float) -> DataFrame:
    """(key, rings) of the areas with fewer points; see ``simplified_at``."""
    return simplified_at(areas, key, [tolerance]).drop("tolerance")


def simplified_at(areas: DataFrame, key: str, tolerances: list[float]) -> DataFrame:
    """(tolerance, key, rings) for each tolerance; borders are found and cut into arcs once for all of them. With fewer points: every point left out is at most the tolerance away from the new line.

    ``rings`` lists all closed rings of an area; keys are unique. Points where borders meet stay, and so does the first point of
    every ring, in the order of x and y; rings keep three points at least, and never vanish. Areas that share a border must
    have its same points; then they share the simplified one as well. Rings of fewer than four points are left out, and
    repeated points count once. Reduced arcs may cross others where areas are narrower than the tolerance: see ``validity``."""
    c = F.col
    # dealt anew before points are made of them: one split of the input may hold any number of areas
    dealt = areas.select(c(key).alias("owner"), "rings").repartition("owner")
    rings = dealt.select("owner", F.posexplode(F.filter("rings", lambda r: F.size(r) > 3)).alias("ring_no", "ring"))
    open_ = F.slice("ring", F.lit(1), F.size("ring") - 1)
    open_ = F.filter(open_, lambda p, i: p != F.get(c("ring"), i + 1))  # no point twice in a row
    rings = rings.select("owner", "ring_no", open_.alias("ring")).where("size(ring) > 2")
    # starting at its smallest point, which stays, and closed
    start = F.array_position("ring", F.array_min("ring")).cast("int")
    turned = F.concat(F.slice("ring", start, F.size("ring")), F.slice("ring", F.lit(1), start))
    rings = saved(rings.select("owner", "ring_no", turned.alias("ring"), F.monotonically_increasing_id().alias("ring_id")))
    # one row an edge before ends are counted, however many areas have it
    edges = rings.select(F.explode(_edges(c("ring"))).alias("e")).select(*_flat("e.p", "p"), *_flat("e.q", "q")).distinct()
    ends = edges.select(F.explode(F.array(*[F.struct(c(f"{d}x").alias("x"), c(f"{d}y").alias("y")) for d in "pq"])).alias("p"))
    ends = ends.select(*_flat("p"), F.lit(1).alias("n"), F.lit(False).alias("first"))
    firsts = rings.select(c("ring")[0].alias("p")).select(*_flat("p"), F.lit(0).alias("n"), F.lit(True).alias("first"))
    nodes = ends.unionByName(firsts).groupBy("x", "y").agg(F.sum("n").alias("degree"), F.max("first").alias("first")).where("degree <> 2 OR first")
    points = rings.select("ring_id", F.posexplode(F.slice("ring", F.lit(2), F.size("ring") - 2)).alias("i", "p")).select("ring_id", "i", *_flat("p"))
    at = points.join(nodes.select("x", "y"), ["x", "y"]).groupBy("ring_id").agg(F.sort_array(F.collect_list(c("i") + 1)).alias("at"))
    at = F.concat(F.array(F.lit(0)), F.coalesce("at", F.array().cast("array<int>"))), at
    rings = saved(rings.join(at[1], "ring_id", "left").withColumn("at", at[0]))
    # where one of two areas needs a point to stay on an arc, it stays for both
    arcs = rings.where("size(at) > 1").select("ring_id", F.size("at").alias("n_arcs"), F.posexplode(_arcs(c("ring"), c("at"))).alias("arc_no", "arc"))
    needed = arcs.where("n_arcs = 2").select("arc").distinct()
    told = arcs.where("n_arcs > 2").join(needed, "arc").groupBy("ring_id").agg(F.collect_list("arc_no").alias("told"))
    known = rings.join(told, "ring_id", "left")
    staying = _staying([float(t) for t in tolerances])(c("ring.x"), c("ring.y"), "at", "told")
    each = F.arrays_zip(F.array(*[F.lit(float(t)) for t in tolerances]).alias("tolerance"), staying.alias("stay"))
    whole = known.select("owner", "ring_no", "ring", F.explode(each).alias("e")).select("e.tolerance", "owner", "ring_no", "ring", "e.stay")
    ring = F.transform("stay", lambda i: F.get("ring", i))
    whole = whole.groupBy("tolerance", "owner").agg(F.sort_array(F.collect_list(F.struct("ring_no", ring.alias("ring")))).alias("r"))
    return whole.select("tolerance", c("owner").alias(key), F.transform("r", lambda r: r["ring"]).alias("rings"))


def _flat(point: str, name: str = "") -> list[Column]:
    return [F.col(f"{point}.{d}").alias(f"{name}{d}") for d in "xy"]


def _undirected(a: Column, b: Column) -> Column:
    """The two, the smaller first."""
    return F.when(a <= b, F.struct(a.alias("p"), b.alias("q"))).otherwise(F.struct(b.alias("p"), a.alias("q")))


def _edges(ring: Column) -> Column:
    return F.transform(tiling.ring_edges(ring), lambda e: _undirected(e["a"], e["b"]))


def _arcs(ring: Column, at: Column) -> Column:
    """The arcs of a closed ring by one of their end edges, directed inwards: of the two the smaller one."""

    def arc(s: Column, k: Column) -> Column:
        end = F.coalesce(F.get(at, k + 1), F.size(ring) - 1)
        edge = lambda i, j: F.struct(*[F.get(ring, v)[d].alias(f"{p}{d}") for p, v in (("a", i), ("b", j)) for d in "xy"])
        return F.least(edge(s, s + 1), edge(end, end - 1))

    return F.transform(at, arc)


def sweep(areas: DataFrame, key: str, region: str, tolerances: list[float]) -> DataFrame:
    """(region, tolerance, n_areas, n_rings, n_points, area): what each tolerance leaves of each region's areas, in one job.

    Areas of a region that are left out by ``simplified_at`` do not count; points count with the repeated last one."""
    made = tiling.turned(simplified_at(areas, key, tolerances))
    points = F.aggregate("rings", F.lit(0), lambda s, r: s + F.size(r)).cast("long")
    size = tiling.size_of(F.col("rings"), F.col("turn"))
    sizes = made.select("tolerance", key, F.size("rings").cast("long").alias("n_rings"), points.alias("n_points"), size.alias("area"))
    counted = sizes.join(areas.select(key, region), key)
    return counted.groupBy(region, "tolerance").agg(
        F.count("*").alias("n_areas"), F.sum("n_rings").alias("n_rings"), F.sum("n_points").alias("n_points"), F.sum("area").alias("area")
    )
