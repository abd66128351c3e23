"""Outlines of joined areas: edges that two parts share cancel, the others are chained to rings.

Edges are directed, the area to their left. Chaining is pointer jumping: every edge looks twice as far ahead in each round and
keeps the smallest edge it has seen and how far ahead that lies, so a ring of n edges takes log2 n rounds, and its edges know
their ring and their place in it. No ring is followed edge by edge, and no area is held by one task before its rings are made.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sommelix.operators import tiling
from sommelix.operators.lineage import saved
from sommelix.operators.quality import QualityError

ENDS = ("ax", "ay", "bx", "by")
#: Longer rings than 2 to this power are not expected; the loop ends when nothing changes.
ROUNDS = 40


def cancelled(edges: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Edges (keep, ax, ay, bx, by) of joined areas: opposite edges of one owner cancel.

    Vertical and horizontal edges cancel where they overlap, split or not; slanted ones where they have the same two ends."""
    c = F.col
    flat = F.when(c("ax") == c("bx"), "v").when(c("ay") == c("by"), "h")
    rows = edges.withColumn("flat", flat)
    forth = F.struct("ax", "ay") < F.struct("bx", "by")
    low, high = (F.when(forth, F.struct(*[c(f"{p}{d}").alias(d) for d in "xy"])).otherwise(F.struct(*[c(f"{q}{d}").alias(d) for d in "xy"])) for p, q in ("ab", "ba"))
    slanted = rows.where("flat IS NULL").select(*keep, low.alias("p"), high.alias("q"), F.when(forth, 1).otherwise(-1).alias("w"))
    slanted = slanted.groupBy(*keep, "p", "q").agg(F.sum("w").alias("w")).where("w <> 0")

    upright = c("flat") == "v"
    fixed, start, stop = (F.when(upright, c(v)).otherwise(c(h)) for v, h in (("ax", "ay"), ("ay", "ax"), ("by", "bx")))
    w = F.when(start < stop, 1).otherwise(-1)
    ends = F.explode(F.array(F.struct(F.least(start, stop).alias("at"), w.alias("w")), F.struct(F.greatest(start, stop).alias("at"), (-w).alias("w"))))
    line = [*keep, "flat", "fixed"]
    events = rows.where("flat IS NOT NULL").select(*keep, "flat", fixed.alias("fixed"), ends.alias("e")).select(*line, "e.*")
    events = events.groupBy(*line, "at").agg(F.sum("w").alias("w")).where("w <> 0")
    on = Window.partitionBy(*line).orderBy("at")
    runs = events.select(*line, "at", F.lead("at").over(on).alias("upto"), F.sum("w").over(on).alias("w")).where("w <> 0 AND upto IS NOT NULL")
    point = lambda v: F.struct(F.when(upright, c("fixed")).otherwise(c(v)).alias("x"), F.when(upright, c(v)).otherwise(c("fixed")).alias("y"))
    left = slanted.unionByName(runs.select(*keep, point("at").alias("p"), point("upto").alias("q"), "w"))
    # an owner's parts that overlap leave a border more than once; one is enough to run along it
    a, b = F.when(c("w") > 0, c("p")).otherwise(c("q")), F.when(c("w") > 0, c("q")).otherwise(c("p"))
    return left.select(*keep, a.alias("a"), b.alias("b")).select(*keep, c("a.x").alias("ax"), c("a.y").alias("ay"), c("b.x").alias("bx"), c("b.y").alias("by"))


def _turn() -> Column:
    """How far the next edge turns to the left; turning back counts as the least."""
    ux, uy, vx, vy = (F.col(q) - F.col(p) for q, p in (("bx", "ax"), ("by", "ay"), ("n_bx", "bx"), ("n_by", "by")))
    angle = F.atan2(ux * vy - uy * vx, ux * vx + uy * vy)
    return F.when(angle > 3.141592653589, -angle).otherwise(angle)


def rings(edges: DataFrame, keep: Sequence[str]) -> DataFrame:
    """(keep, ring, hole): one row for each closed ring that directed edges without repeats form; holes run clockwise.

    Where more than two edges of one owner meet, the ring takes the leftmost turn: parts that touch in a corner stay apart, and
    a hole that touches its outline in a corner is part of the outline's ring. Points on straight stretches are left out."""
    rows = saved(edges.select(*keep, *ENDS).withColumn("e", F.monotonically_increasing_id()))
    nexts = rows.select(*[F.col(k).alias(f"n_{k}") for k in keep], F.col("ax").alias("n_ax"), F.col("ay").alias("n_ay"), F.col("bx").alias("n_bx"), F.col("by").alias("n_by"), F.col("e").alias("n"))
    same = (F.col("bx") == F.col("n_ax")) & (F.col("by") == F.col("n_ay"))
    for k in keep:
        same = same & F.col(k).eqNullSafe(F.col(f"n_{k}"))
    found = rows.join(nexts, same, "left").groupBy("e").agg(F.max_by("n", _turn()).alias("n"))
    jump = saved(found.select("e", "n", F.col("e").alias("least"), F.lit(0).cast("long").alias("ahead")))
    if not jump.where("n IS NULL").isEmpty():
        raise QualityError("edges do not close to rings")
    for k in range(1, ROUNDS):  # n is 2 ** (k - 1) edges after e; least is the smallest from e to before n
        far = jump.select(F.col("e").alias("n"), F.col("n").alias("f_n"), F.col("least").alias("f_least"), F.col("ahead").alias("f_ahead"))
        better = F.col("f_least") < F.col("least")
        jump = saved(
            jump.join(far, "n").select(
                "e", F.col("f_n").alias("n"), F.least("least", "f_least").alias("least"),
                F.when(better, F.col("f_ahead") + 2 ** (k - 1)).otherwise(F.col("ahead")).alias("ahead"), better.alias("better"),
            )
        )
        if jump.where("better").isEmpty():
            break
        jump = jump.drop("better")
    placed = rows.join(jump.select("e", "least", "ahead"), "e")
    # the smallest edge first; what has it furthest ahead comes right after it
    order = F.struct((F.col("ahead") > 0).alias("later"), (-F.col("ahead")).alias("ahead"), F.col("ax").alias("x"), F.col("ay").alias("y"))
    made = placed.groupBy(*keep, "least").agg(F.sort_array(F.collect_list(order)).alias("points"))
    points = F.transform("points", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    ring = tiling.bound(straightened(points), lambda r: F.concat(r, F.slice(r, 1, 1)))
    made = made.select(*keep, ring.alias("ring")).where("size(ring) > 3")
    return made.withColumn("hole", tiling.signed_area(F.col("ring")) < 0)


def straightened(points: Column) -> Column:
    """Points, not closed, without those on a straight stretch between the points before and after."""

    def bends(points: Column, p: Column, i: Column) -> Column:
        n = F.size(points)
        a, b = F.get(points, F.pmod(i - 1, n)), F.get(points, F.pmod(i + 1, n))
        ux, uy, vx, vy = p["x"] - a["x"], p["y"] - a["y"], b["x"] - p["x"], b["y"] - p["y"]
        cross, dot = ux * vy - uy * vx, ux * vx + uy * vy
        return ~((F.abs(cross) <= 1e-9 * (F.abs(ux * vx) + F.abs(uy * vy) + F.abs(ux * vy) + F.abs(uy * vx))) & (dot > 0))

    return tiling.bound(points, lambda points: F.filter(points, lambda p, i: bends(points, p, i)))


def dissolved(parts: DataFrame, key: str) -> DataFrame:
    """(key, rings): the outline of all parts of each key, which adjoin but do not overlap, without the borders they share.

    A slanted border is shared where both parts have its same points; vertical and horizontal ones may be divided differently.
    Parts without any area have no row; null keys are one key. For parts that overlap, see ``partition.joined``."""
    edges = tiling.directed_edges(parts.select(F.col(key).alias("owner"), "rings"), ["owner"])
    return collected(rings(cancelled(edges, ["owner"]), ["owner"]), key)


def collected(made: DataFrame, key: str) -> DataFrame:
    """(key, rings) from the rings of each owner."""
    return made.groupBy(F.col("owner").alias(key)).agg(F.sort_array(F.collect_list("ring")).alias("rings"))


def nested(made: DataFrame, key: str, cell: float) -> DataFrame:
    """(key, polygon, ring, hole), the holes with the polygon that they lie in: from ``rings``, whose outlines are numbered in
    order. A hole belongs to the smallest outline of its key around it. They meet by grid cell of side ``cell``."""
    size = F.abs(tiling.signed_area(F.col("ring")))
    outlines = made.where("NOT hole").withColumn("polygon", F.row_number().over(Window.partitionBy(key).orderBy("ring")))
    steps = lambda axis: F.explode(F.sequence(F.floor(F.array_min(f"ring.{axis}") / cell), F.floor(F.array_max(f"ring.{axis}") / cell)))
    spread = outlines.select(F.col(key).alias("o_key"), "polygon", F.col("ring").alias("o_ring"), size.alias("o_size"), "ring")
    spread = spread.withColumn("cx", steps("x")).withColumn("cy", steps("y")).drop("ring")
    a, b = F.col("ring")[0], F.col("ring")[1]
    x, y = (a["x"] + b["x"]) / 2, (a["y"] + b["y"]) / 2
    holes = made.where("hole").select(key, "ring", x.alias("hx"), y.alias("hy"), F.floor(x / cell).alias("cx"), F.floor(y / cell).alias("cy"))
    met = holes.join(spread, ["cx", "cy"]).where(F.col(key).eqNullSafe(F.col("o_key")) & tiling._around(F.col("o_ring"), F.col("hx"), F.col("hy")))
    within = met.groupBy(key, "ring").agg(F.min_by("polygon", "o_size").alias("polygon"))
    return outlines.select(key, "polygon", "ring", "hole").unionByName(within.select(key, "polygon", "ring", F.lit(True).alias("hole")))
