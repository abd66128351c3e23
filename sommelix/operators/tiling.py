"""Areas cut to square tiles, as signed pieces that can be added up and joined tile by tile.

An area lies between the edges above and the edges below it, so its indicator is a sum of signed regions below edges. A piece
is such an edge within one tile, x1 < x2, with sign s: s times the region between the tile's bottom and the piece. What lies
below edges of tiles further up is added as pieces along the tile's top. All that is asked of an area (its size, what it
shares with another, where it is) follows from its pieces in each tile, without any other tile.

Tiles are split again where they hold many pieces, so a crowded place does not land in one task, and a tile inside an area is
one piece, however large it is. Vertical edges bound nothing from above or below and have no pieces.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sommelix.operators.lineage import saved

TILE = ("tx", "ty", "size")
LINE = ("x1", "y1", "x2", "y2")
#: A tile is split into this many columns and rows.
FAN = 8
#: Splits of splits end here: two areas may share any number of edges, and no split takes those apart.
ROUNDS = 8
POINTS = "array<array<struct<x: double, y: double>>>"
#: Areas of more rings find out by sorted points which of them are holes.
FEW_RINGS = 16
#: So many pairs of an edge and a point are looked at together.
PAIRS = 1 << 20


def shapes(areas: DataFrame, key: str, shape: str) -> tuple[DataFrame, DataFrame]:
    """(shape, rings) of all different rings, with a number, and (key, shape): copies of an area share a shape, so what follows from rings alone
    is worked out once. Areas whose rings are null have no shape."""
    different = saved(areas.select("rings").where("rings IS NOT NULL").distinct().withColumn(shape, F.monotonically_increasing_id()))
    return different, saved(areas.select(key, "rings").join(different, "rings").select(key, shape))


def bound(value: Column, of: Callable[[Column], Column]) -> Column:
    """What a function gives of a value that is worked out once: an expression named within a function of an array's items is worked
    out again for every item."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def ring_edges(ring: Column) -> Column:
    """Array of (a, b), from each point to the next."""
    return F.transform(F.sequence(F.lit(0), F.size(ring) - 2), lambda i: F.struct(F.get(ring, i).alias("a"), F.get(ring, i + 1).alias("b")))


def signed_area(ring: Column) -> Column:
    """Positive where the ring runs counterclockwise. Taken from its first point, so large coordinates lose little."""

    def size(ring: Column) -> Column:
        x0, y0 = ring[0]["x"], ring[0]["y"]
        step = lambda s, e: s + ((e["a"]["x"] - x0) * (e["b"]["y"] - y0) - (e["b"]["x"] - x0) * (e["a"]["y"] - y0))
        return F.aggregate(ring_edges(ring), F.lit(0.0), step) / 2

    return bound(ring, size)


def _around(ring: Column, x: Column, y: Column) -> Column:
    """The ring runs around the point: an odd number of its edges lie to the right."""
    right = F.filter(
        ring_edges(ring),
        lambda e: ((e["a"]["y"] > y) != (e["b"]["y"] > y))
        & (x < (e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) / (e["b"]["y"] - e["a"]["y"]) + e["a"]["x"]),
    )
    return F.size(right) % 2 == 1


def around_odd(x: np.ndarray, y: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether each ring, given by the number of its points, lies within an odd number of the others; by the middle of its first
    edge. An edge is looked at with the points at its height only (or, if they are fewer, those above and below it)."""
    first = np.cumsum(sizes) - sizes
    tail = np.ones(len(x), bool)
    tail[first + sizes - 1] = False
    a = np.flatnonzero(tail)
    ring = np.repeat(np.arange(len(sizes)), sizes)[a]
    spans = []
    for u, v in ((x, y), (y, x)):
        at = (v[first] + v[first + 1]) / 2
        order = np.argsort(at, kind="stable")
        low, high = (np.searchsorted(at[order], f(v[a], v[a + 1])) for f in (np.minimum, np.maximum))
        spans.append((int((high - low).sum()), u, v, (u[first] + u[first + 1]) / 2, at, order, low, high - low))
    _, u, v, pu, pv, order, low, n = min(spans, key=lambda s: s[0])
    held = np.flatnonzero(n)
    upto = np.cumsum(n[held])
    odd = np.zeros(len(sizes), np.int64)
    start = 0
    while start < len(held):
        stop = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + PAIRS)))
        e = held[start:stop]
        start = stop
        k = np.repeat(np.arange(len(e)), n[e])
        p = order[low[e][k] + np.arange(len(k)) - (np.cumsum(n[e]) - n[e])[k]]
        owner, e = ring[e][k], a[e][k]
        right = (owner != p) & (pu[p] < (u[e + 1] - u[e]) * (pv[p] - v[e]) / (v[e + 1] - v[e]) + u[e])
        odd += np.bincount(p[right], minlength=len(sizes))
    return odd % 2 == 1


def _within_odd(xs: pd.Series, ys: pd.Series, sizes: pd.Series) -> pd.Series:
    return pd.Series([None if n is None else around_odd(x, y, n) for x, y, n in zip(xs, ys, sizes)])


def turned(areas: DataFrame) -> DataFrame:
    """areas with ``turn``, for each of the rings: see ``_turns``, which compares all rings of an area with each other. Those of
    areas with very many rings are looked up by height."""
    few = F.size("rings") <= FEW_RINGS
    rest = F.when(~few, F.col("rings"))
    points = F.flatten(rest)
    within = F.pandas_udf(_within_odd, "array<boolean>")(points["x"], points["y"], F.transform(rest, F.size))
    known = areas.withColumn("_within", within)
    many = F.transform("rings", lambda ring, k: (F.signum(signed_area(ring)) * F.when(F.get("_within", k), -1).otherwise(1)).cast("int"))
    return known.withColumn("turn", F.when(few, _turns(F.col("rings"))).otherwise(many)).drop("_within")


def size_of(rings: Column, turn: Column) -> Column:
    """The size of an area, holes left out; null if it has none."""
    sizes = F.zip_with(rings, turn, lambda ring, t: signed_area(ring) * t)
    return F.when(F.exists(turn, lambda t: t != 0), F.aggregate(sizes, F.lit(0.0), lambda s, v: s + v))


def _turns(rings: Column) -> Column:
    """For each ring 1 where the area is to its left, -1 where it is to its right, 0 where it encloses nothing. A ring within
    an odd number of others is a hole; rings of one area may touch in vertices."""

    def turn(ring: Column, k: Column) -> Column:
        a, b = ring[0], ring[1]
        x, y = (a["x"] + b["x"]) / 2, (a["y"] + b["y"]) / 2
        outer = F.filter(rings, lambda other, j: (j != k) & _around(other, x, y))
        return (F.signum(signed_area(ring)) * F.when(F.size(outer) % 2 == 1, -1).otherwise(1)).cast("int")

    return F.transform(rings, turn)


def directed_edges(areas: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Columns to keep and ax, ay, bx, by: every edge, the area to its left. ``rings`` lists the closed rings of an area, of its
    parts and its holes alike, in any direction; rings of fewer than four points have no edges, nor have repeated points."""
    shaped = areas.select(*keep, F.filter("rings", lambda r: F.size(r) > 3).alias("rings")).where("size(rings) > 0")
    each = turned(shaped).select(*keep, F.explode(F.arrays_zip("rings", "turn")).alias("_r"))
    edges = each.select(*keep, F.col("_r.turn").alias("_turn"), F.explode(ring_edges(F.col("_r.rings"))).alias("_e")).where("_turn <> 0")
    a, b = (F.when(F.col("_turn") > 0, F.col(f"_e.{p}")).otherwise(F.col(f"_e.{q}")) for p, q in ("ab", "ba"))
    edges = edges.select(*keep, a.alias("a"), b.alias("b")).where("a <> b")
    return edges.select(*keep, F.col("a.x").alias("ax"), F.col("a.y").alias("ay"), F.col("b.x").alias("bx"), F.col("b.y").alias("by"))


def frame(edges: DataFrame) -> tuple[float, float, float]:
    """Corner and size of one tile around all edges, such that the borders of tiles within it are exact numbers."""
    box = edges.agg(
        *[F.min(F.least(f"a{c}", f"b{c}")).alias(f"low_{c}") for c in "xy"], *[F.max(F.greatest(f"a{c}", f"b{c}")).alias(f"high_{c}") for c in "xy"]
    ).first()  # four numbers
    x0, y0 = math.floor(box.low_x or 0), math.floor(box.low_y or 0)
    return float(x0), float(y0), 2.0 ** math.ceil(math.log2(max(1.0, (box.high_x or 0) - x0, (box.high_y or 0) - y0)))


def pieces(edges: DataFrame, keep: Sequence[str], tile: tuple[float, float, float]) -> DataFrame:
    """All pieces of the areas, in the one tile around everything."""
    back = F.col("bx") < F.col("ax")
    line = [F.when(back, F.col(f"{p}{c}")).otherwise(F.col(f"{q}{c}")).alias(f"{c}{k}") for k, p, q in ((1, "b", "a"), (2, "a", "b")) for c in "xy"]
    return edges.where("ax <> bx").select(*keep, *[F.lit(v).alias(n) for n, v in zip(TILE, tile)], *line, F.when(back, 1).otherwise(-1).alias("s"))


def along(x: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """The line's height at x, between its ends; exact at both."""
    return F.when(x == x1, y1).when(x == x2, y2).otherwise(y1 + (y2 - y1) * ((x - x1) / (x2 - x1)))


def split(rows: DataFrame, keep: Sequence[str], fan: int = FAN) -> DataFrame:
    """The pieces of the tiles that each tile is split into."""
    c = F.col
    rows = rows.withColumn("h", c("size") / fan)
    first, last = F.floor((c("x1") - c("tx")) / c("h")), F.ceil((c("x2") - c("tx")) / c("h")) - 1
    first = F.least(F.greatest(first, F.lit(0)), F.lit(fan - 1))
    rows = rows.withColumn("i", F.explode(F.sequence(first, F.least(F.greatest(first, last), F.lit(fan - 1)))))
    left = c("tx") + c("i") * c("h")
    xa, xb = F.greatest("x1", left), F.least(c("x2"), left + c("h"))
    height = lambda x: along(x, *map(c, LINE))
    strip = rows.select(*keep, *TILE, "h", "i", "s", xa.alias("xa"), height(xa).alias("ya"), xb.alias("xb"), height(xb).alias("yb")).where("xa < xb")

    row_of = lambda y: F.least(F.greatest(F.floor((y - c("ty")) / c("h")), F.lit(0)), F.lit(fan - 1))
    strip = strip.withColumn("j", F.explode(F.sequence(row_of(F.least("ya", "yb")), row_of(F.greatest("ya", "yb")))))
    strip = strip.withColumn("low", c("ty") + c("j") * c("h")).withColumn("high", c("low") + c("h"))

    def at(y: Column) -> Column:
        x = F.when(y == c("ya"), c("xa")).when(y == c("yb"), c("xb")).otherwise(c("xa") + (c("xb") - c("xa")) * ((y - c("ya")) / (c("yb") - c("ya"))))
        return F.least(F.greatest(x, c("xa")), c("xb"))

    held = lambda y: F.least(F.greatest(y, c("low")), c("high"))
    inside = lambda x, y: F.when(held(y) == y, x).otherwise(at(held(y)))
    below = strip.select(
        *keep, *TILE, "h", "i", "j", "s", (c("tx") + c("i") * c("h")).alias("left"), "low",
        inside(c("xa"), c("ya")).alias("x1"), held(c("ya")).alias("y1"), inside(c("xb"), c("yb")).alias("x2"), held(c("yb")).alias("y2"),
    )
    own = below.where("x1 < x2").select(*keep, c("left").alias("tx"), c("low").alias("ty"), c("h").alias("size"), *LINE, "s")

    # A piece covers all rows below its own between its ends. Ends that meet cancel; what is left covers up to the strip's right.
    column = [*keep, *TILE, "h", "i", "left", "at"]
    ends = F.explode(F.array(F.struct(c("x1").alias("at"), c("s").alias("w")), F.struct(c("x2").alias("at"), (-c("s")).alias("w")))).alias("end")
    ends = below.select(*keep, *TILE, "h", "i", "left", "j", ends).select(*keep, *TILE, "h", "i", "left", "j", "end.*").where("at < left + h")
    ends = ends.groupBy(*column, "j").agg(F.sum("w").alias("w")).where("w <> 0")
    down = Window.partitionBy(*column).orderBy(c("j").desc())
    cover = ends.select(
        *column, F.sum("w").over(down.rowsBetween(Window.unboundedPreceding, 0)).cast("int").alias("s"), c("j").alias("above"),
        F.coalesce(F.lead("j").over(down), F.lit(0)).alias("lowest"),
    ).where("s <> 0 AND lowest < above")
    cover = cover.withColumn("j", F.explode(F.sequence(c("lowest"), c("above") - 1)))
    top = c("ty") + (c("j") + 1) * c("h")
    cover = cover.select(
        *keep, c("left").alias("tx"), (c("ty") + c("j") * c("h")).alias("ty"), c("h").alias("size"),
        c("at").alias("x1"), top.alias("y1"), (c("left") + c("h")).alias("x2"), top.alias("y2"), "s",
    )
    # what covers up to the right from two places cancels beyond the second
    return own.unionByName(cover).groupBy(*keep, *TILE, *LINE).agg(F.sum("s").cast("int").alias("s")).where("s <> 0")


def tiled(rows: DataFrame, keep: Sequence[str], counts: dict[str, Column], hot: str, live: str = "true", prune=None, tile: Sequence[str] = TILE) -> DataFrame:
    """Pieces in tiles of which none is hot. ``tile`` may have more columns, of those to keep: planes with tiles of their own. ``counts`` are taken for each tile; ``hot`` and ``live`` are conditions on them: hot
    tiles are split, others than live ones leave. ``prune`` drops pieces that no longer matter, before tiles are counted."""
    done = []
    for _ in range(ROUNDS):
        rows = prune(rows) if prune else rows
        known = rows.groupBy(*tile).agg(*[v.alias(k) for k, v in counts.items()]).where(live).select(*tile, F.expr(hot).alias("hot"))
        rows = saved(rows.join(known, list(tile)))
        done.append(rows.where("NOT hot").drop("hot"))
        if rows.where("hot").isEmpty():
            break
        rows = saved(split(rows.where("hot").drop("hot"), keep))
    else:
        done.append(rows)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def piece_area() -> Column:
    """What a piece adds to its area's size."""
    return F.col("s") * (F.col("x2") - F.col("x1")) * ((F.col("y1") + F.col("y2")) / 2 - F.col("ty"))


def area_of(areas: DataFrame, key: str) -> DataFrame:
    """(key, area): the size of every area, holes left out; areas without any have none."""
    shaped = areas.select(F.col(key).alias("_key"), F.filter("rings", lambda r: F.size(r) > 3).alias("rings")).where("size(rings) > 0")
    sizes = turned(shaped).select(F.col("_key").alias(key), size_of(F.col("rings"), F.col("turn")).alias("area")).where("area IS NOT NULL")
    return sizes.groupBy(key).agg(F.sum("area").alias("area"))
