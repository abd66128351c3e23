"""Areas that overlap made disjoint: every place goes to the area of the lowest rank that covers it.

In each tile the pieces of all areas, and where they cross, divide it into slabs in which no two of them cross. A slab's pieces
are ordered by height, so an area's part of it is a set of stretches between pieces. The stretches between neighbouring heights
are the faces of the arrangement; a face goes to the lowest rank among the stretches that hold it. All of this is joins and
windows by tile and slab; tiles with many pieces are split before, and what a lower rank hides in a tile leaves it first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sommelix.operators import dissolve, tiling
from sommelix.operators.lineage import saved
from sommelix.operators.tiling import LINE, TILE, along

#: A tile with more pieces is split.
PIECES = 24
#: Heights are rounded to this share of the whole's size, a power of two, so that lines that cross meet in one point.
GRAIN = 2.0**-46


#: Areas of one plane are put in order among themselves only; planes lie in the same tiles, but do not meet.
SHEET = (*TILE, "plane")


def _unhidden(rows: DataFrame) -> DataFrame:
    """Pieces without those of areas of which nothing is seen in a tile: one of lower rank fills it, or looks the same there."""
    c = F.col
    full = (c("x1") == c("tx")) & (c("x2") == c("tx") + c("size")) & (c("y1") == c("ty") + c("size")) & (c("y2") == c("y1")) & (c("s") == 1)
    looks = F.sum(F.xxhash64(*LINE, "s").cast("decimal(38,0)")), F.sum(F.xxhash64("s", *reversed(LINE)).cast("decimal(38,0)"))
    per = rows.groupBy(*SHEET, "rank").agg(F.count("*").alias("n"), F.max(full).alias("full"), F.struct(*looks).alias("looks"))
    first = Window.partitionBy(*SHEET, "n", "looks").orderBy("rank")
    filled = F.min(F.when(c("full") & (c("n") == 1), c("rank"))).over(Window.partitionBy(*SHEET))
    seen = per.withColumn("filled", filled).withColumn("nth", F.row_number().over(first)).where("nth = 1 AND (filled IS NULL OR rank <= filled)")
    return rows.join(seen.select(*SHEET, "rank"), [*SHEET, "rank"])


def _slabs(rows: DataFrame) -> DataFrame:
    """(tile, u, v): stretches of x between neighbouring ends and crossings of the tile's pieces."""
    lines = rows.select(*SHEET, *LINE).distinct()
    other = lines.select(*SHEET, *[F.col(c).alias(f"o_{c}") for c in LINE])
    met = lines.join(other, list(SHEET)).where("struct(x1, y1, x2, y2) < struct(o_x1, o_y1, o_x2, o_y2) AND x1 < o_x2 AND o_x1 < x2")
    low, high = F.greatest("x1", "o_x1"), F.least("x2", "o_x2")
    apart = [along(x, *map(F.col, LINE)) - along(x, *[F.col(f"o_{c}") for c in LINE]) for x in (low, high)]
    crossing = low + (high - low) * (apart[0] / (apart[0] - apart[1]))
    crossings = met.where(apart[0] * apart[1] < 0).select(*SHEET, crossing.alias("u"))
    ends = lines.select(*SHEET, F.explode(F.array("x1", "x2")).alias("u"))
    breaks = ends.unionByName(crossings).distinct()
    return breaks.withColumn("v", F.lead("u").over(Window.partitionBy(*SHEET).orderBy("u"))).where("v IS NOT NULL")


def faces(areas: DataFrame, keep: str, rank: Column, plane: Column | None = None) -> DataFrame:
    """(keep, u, v, high_u, high_v, low_u, low_v): disjoint faces of areas, each of the lowest rank (a long) that covers it.

    A face lies between two lines over x from u to v. Areas of equal rank are one area; ``keep`` must follow from the rank, and
    from the plane (a long), if areas are told apart by planes: then those of different planes may share a place."""
    sheet = [rank.cast("long").alias("rank"), (F.lit(0) if plane is None else plane).cast("long").alias("plane")]
    edges = saved(tiling.directed_edges(areas.select(*sheet, "rings"), ["rank", "plane"]))
    tile = tiling.frame(edges)
    grain = tile[2] * GRAIN
    rows = tiling.tiled(tiling.pieces(edges, ["rank", "plane"], tile), ["rank", "plane"], {"n": F.count("*")}, f"n > {PIECES}", prune=_unhidden, tile=SHEET)
    slab = [*SHEET, "u", "v"]
    c = F.col
    in_slab = rows.join(_slabs(rows), list(SHEET)).where("x1 <= u AND x2 >= v")
    in_slab = in_slab.select(*slab, "rank", "s", *[(c("ty") + F.rint((along(c(x), *map(c, LINE)) - c("ty")) / grain) * grain).alias(f"y_{x}") for x in "uv"])
    # lines of one area that run together there count once, with what they add up to
    in_slab = in_slab.groupBy(*slab, "rank", "y_u", "y_v").agg(F.sum("s").alias("s")).where("s <> 0")
    line = F.struct((c("y_u") + c("y_v")).alias("mid"), c("y_u"), c("y_v"))
    bottom = F.struct((2 * c("ty")).alias("mid"), c("ty").alias("y_u"), c("ty").alias("y_v"))
    down = Window.partitionBy(*slab, "rank").orderBy(c("line").desc())
    runs = in_slab.withColumn("line", line).select(
        *slab, "rank", c("line").alias("high"), F.coalesce(F.lead("line").over(down), bottom).alias("low"),
        F.sum("s").over(down.rowsBetween(Window.unboundedPreceding, 0)).alias("inside"),
    )
    runs = runs.where("inside > 0 AND high.mid > low.mid")
    levels = runs.select(*slab, F.explode(F.array("high", "low")).alias("line")).groupBy(*slab, c("line.mid").alias("mid")).agg(F.min("line").alias("top"))
    below = F.lead("top").over(Window.partitionBy(*slab).orderBy(c("mid").desc()))
    gaps = levels.select(*slab, "top", below.alias("under")).where("under IS NOT NULL")
    held = gaps.join(runs.select(*slab, "rank", "high", "low"), slab).where("high.mid >= top.mid AND low.mid <= under.mid")
    owned = held.groupBy(*slab, "top", "under").agg(F.min("rank").alias("rank"))
    names = areas.select(*sheet, F.col(keep).alias("_keep")).groupBy("rank", "plane").agg(F.min("_keep").alias("_keep"))
    return owned.join(names, ["rank", "plane"]).select(
        c("_keep").alias(keep), "u", "v", *[c(f"{p}.y_{x}").alias(f"{q}_{x}") for p, q in (("top", "high"), ("under", "low")) for x in "uv"]
    )


def face_area() -> Column:
    return F.expr("(v - u) * ((high_u - low_u) + (high_v - low_v)) / 2")


def outlines(made: DataFrame, keep: str) -> DataFrame:
    """(keep, rings): what the faces of each owner form together."""
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    around = [corner("u", "low_u"), corner("v", "low_v"), corner("v", "high_v"), corner("u", "high_u")]
    sides = F.explode(F.array(*[F.struct(a.alias("a"), b.alias("b")) for a, b in zip(around, around[1:] + around[:1])])).alias("side")
    edges = made.select(F.col(keep).alias("owner"), sides).where("side.a <> side.b")
    edges = edges.select("owner", *[F.col(f"side.{p}.{d}").alias(f"{p}{d}") for p in "ab" for d in "xy"])
    return dissolve.collected(dissolve.rings(dissolve.cancelled(edges, ["owner"]), ["owner"]), keep)


def joined(parts: DataFrame, key: str) -> DataFrame:
    """(key, rings): the union of the parts of each key, whether they overlap or not; keys may overlap each other. See
    ``dissolve.dissolved`` for parts that only adjoin."""
    return outlines(faces(parts, key, F.lit(0), F.xxhash64(key)), key)


def smallest_wins(areas: DataFrame, key: str, name: str) -> tuple[DataFrame, DataFrame]:
    """(key, rings) of areas made disjoint, and a report with one row for each area.

    Areas come in the order of their size, then of ``name``, then of the key; each keeps what no earlier one covers. Keys are
    unique. The report has priority_rank, original_area, final_area, removed_area, removed_percent and became_empty; areas
    that nothing is left of have no outline. Areas without any size are empty from the start."""
    sizes = areas.select(key, name).join(tiling.area_of(areas, key), key, "left").na.fill(0.0, ["area"])
    ranked = saved(numbered(sizes, [F.col("area"), F.col(name), F.col(key)], "priority_rank"))
    # of copies the first covers the others
    firsts = areas.join(ranked.select(key, "priority_rank"), key).groupBy("rings").agg(F.min(F.struct("priority_rank", key)).alias("first"))
    made = saved(faces(firsts.select("rings", "first.*"), key, F.col("priority_rank")))
    final = made.groupBy(key).agg(F.sum(face_area()).alias("final"))
    left = F.coalesce("final", F.lit(0.0))
    removed = F.greatest(F.lit(0.0), F.col("area") - left)
    report = ranked.join(final, key, "left").select(
        key, name, "priority_rank", F.col("area").alias("original_area"), left.alias("final_area"), removed.alias("removed_area"),
        F.when(F.col("area") > 0, removed / F.col("area") * 100).otherwise(0.0).alias("removed_percent"), F.col("final").isNull().alias("became_empty"),
    )
    return outlines(made, key), report


def numbered(rows: DataFrame, order: list[Column], name: str, first: int = 1) -> DataFrame:
    """rows with their place in the given order, which must be total. Rows are sorted over partitions and counted by partition;
    no task sees more than its own part."""
    part = saved(rows.sort(*order).withColumn("_part", F.spark_partition_id()).withColumn("_local", F.monotonically_increasing_id()))
    counts = part.groupBy("_part").agg(F.count("*").alias("n"), F.min("_local").alias("_from"))
    before = F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))  # one row for each partition
    offsets = counts.select("_part", (F.coalesce(before, F.lit(0)) - F.col("_from") + first).alias("_offset"))
    return part.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_local") + F.col("_offset")).drop("_part", "_local", "_offset")


def overlap_metrics(areas: DataFrame, key: str) -> DataFrame:
    """One row: the sum of all sizes, the size of the union, and their difference, what is covered more than once."""
    total = tiling.area_of(areas, key).agg(F.coalesce(F.sum("area"), F.lit(0.0)).alias("summed_area"))
    union = faces(areas.withColumn("_all", F.lit(0)), "_all", F.lit(0)).agg(F.coalesce(F.sum(face_area()), F.lit(0.0)).alias("union_area"))
    both = total.crossJoin(union)
    return both.withColumn("overlap_area", F.greatest(F.lit(0.0), F.col("summed_area") - F.col("union_area")))


# Areas in square metres and shares below which an overlap or a change is none, negligible, or fatal above both.
NONE_AREA, NONE_SHARE = 1e-6, 1e-9
NEGLIGIBLE_AREA, NEGLIGIBLE_SHARE = 100.0, 1e-7
FATAL_AREA, FATAL_SHARE = 1000.0, 1e-5
NEGLIGIBLE_CHANGE, NEGLIGIBLE_CHANGE_SHARE = 10.0, 1e-8


def residual_overlap_class(overlap: Column, union: Column, tolerance: Column | None = None) -> Column:
    """``none`` up to the tolerance (by default the larger of an area and a share of the union), ``fatal`` above both fatal
    bounds, ``negligible`` up to either negligible one, else ``review``; without any union the share is 0."""
    tolerance = F.greatest(F.lit(NONE_AREA), union * NONE_SHARE) if tolerance is None else tolerance
    share = F.when(union == 0, 0.0).otherwise(overlap / union)
    return (
        F.when(overlap <= tolerance, "none")
        .when((overlap > FATAL_AREA) & (share > FATAL_SHARE), "fatal")
        .when((overlap <= NEGLIGIBLE_AREA) | (share <= NEGLIGIBLE_SHARE), "negligible")
        .otherwise("review")
    )


def area_change_class(before: Column, after: Column, source: Column, area: float, share: float) -> Column:
    """How a repair changed an area, against the size of its source: ``fatal`` above both given bounds, ``negligible`` up to
    either negligible one, else ``review``. Without any source every change is out of all proportion."""
    change = F.abs(after - before)
    part = F.when(source > 0, change / source).otherwise(float("inf"))
    return (
        F.when((change > area) & (part > share), "fatal")
        .when((change <= NEGLIGIBLE_CHANGE) | (part <= NEGLIGIBLE_CHANGE_SHARE), "negligible")
        .otherwise("review")
    )
