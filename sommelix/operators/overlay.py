"""What areas share: sizes of intersections by tile, and for each area the region that holds most of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sommelix.operators import tiling
from sommelix.operators.lineage import saved
from sommelix.operators.quality import QualityError
from sommelix.operators.tiling import TILE, along

#: A tile is split when more pairs of pieces meet in it, and more than so many of both sides: where one side has few, pairs
#: are in proportion to the other side's pieces, and no split makes them fewer.
PAIRS = 1024
FEW = 32
#: Of the larger side of a tile, so many pieces are dealt to one group.
DEALT = 4096
#: An intersection below this share of the smaller area is a touch.
NEGLIGIBLE = 1e-12


def _shared() -> Column:
    """The integral of the lower one of two pieces over their common stretch, above the tile's bottom."""
    low, high = F.greatest("x1", "r_x1"), F.least("x2", "r_x2")
    line, other = [F.col(c) for c in tiling.LINE], [F.col(f"r_{c}") for c in tiling.LINE]
    a, b, c, d = (along(x, *p) - F.col("ty") for p in (line, other) for x in (low, high))
    first, last = a - c, b - d
    at = first / (first - last)
    crossing = a + (b - a) * at
    ends = F.least(a, c), F.least(b, d)
    crossed = (ends[0] + crossing) * at + (crossing + ends[1]) * (1 - at)
    return (high - low) / 2 * F.when(first * last < 0, crossed).otherwise(ends[0] + ends[1])


def overlaps(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """(left_key, right_key, overlap_area) of all pairs that share more than a touch, from two frames of areas with ``rings``;
    keys are unique and have names that differ.

    Copies of an area are looked at once. Both sides are cut to the same tiles; tiles that only one side has are dropped, so only
    areas that share a tile meet, the larger side in groups. The integrals of a pair are added up where the tile lies before
    they are added over tiles."""
    (lefts, of_left), (rights, of_right) = tiling.shapes(left, left_key, "_l"), tiling.shapes(right, right_key, "_r")
    found = saved(_overlaps(lefts, rights))
    return found.join(of_left, "_l").join(of_right, "_r").select(left_key, right_key, "overlap_area")


def _overlaps(left: DataFrame, right: DataFrame) -> DataFrame:
    """(_l, _r, overlap_area) of shapes."""
    sides = [areas.select(F.lit(side).alias("side"), F.col(f"_{side}").alias("key"), "rings") for side, areas in (("l", left), ("r", right))]
    edges = saved(tiling.directed_edges(sides[0].unionByName(sides[1]), ["side", "key"]))
    counts = {"l": F.count_if(F.col("side") == "l"), "r": F.count_if(F.col("side") == "r")}
    hot = f"l * r > {PAIRS} AND least(l, r) > {FEW}"
    rows = tiling.tiled(tiling.pieces(edges, ["side", "key"], tiling.frame(edges)), ["side", "key"], counts, hot, "l > 0 AND r > 0")
    groups = rows.groupBy(*TILE).agg(*[v.alias(k) for k, v in counts.items()]).withColumn("groups", F.ceil(F.greatest("l", "r") / DEALT))
    dealt = F.array(F.pmod(F.xxhash64("key"), "groups"))
    larger = (F.col("side") == "l") == (F.col("l") >= F.col("r"))
    rows = rows.join(groups, list(TILE)).withColumn("group", F.explode(F.when(larger, dealt).otherwise(F.sequence(F.lit(0), F.col("groups") - 1))))
    others = rows.where("side = 'r'").select(*TILE, "group", F.col("key").alias("r_key"), *[F.col(c).alias(f"r_{c}") for c in (*tiling.LINE, "s")])
    met = rows.where("side = 'l'").join(others, [*TILE, "group"]).where("x1 < r_x2 AND r_x1 < x2")
    found = met.groupBy("key", "r_key").agg(F.sum(F.col("s") * F.col("r_s") * _shared()).alias("overlap_area"))
    sizes = [tiling.area_of(f, k).withColumnRenamed("area", n) for f, k, n in ((left, "_l", "a"), (right, "_r", "b"))]
    found = found.withColumnsRenamed({"key": "_l", "r_key": "_r"}).join(sizes[0], "_l").join(sizes[1], "_r").where(F.col("overlap_area") > NEGLIGIBLE * F.least("a", "b"))
    return found.select("_l", "_r", "overlap_area")


def majority_overlap(areas: DataFrame, regions: DataFrame, key: str = "aoc_key", region: str = "region") -> DataFrame:
    """(key, region, overlap_area, overlap_ratio): the region that holds the largest part of each area, of equal parts the
    one whose name comes first. Areas that share nothing with any region have no row. The ratio is to the area's own size."""
    different, members = tiling.shapes(areas, key, "_shape")
    shares = overlaps(different, regions, "_shape", region)
    best = shares.groupBy("_shape").agg(F.min(F.struct((-F.col("overlap_area")).alias("less"), F.col(region).alias("name"))).alias("best"))
    own = tiling.area_of(different, "_shape")
    overlap = -F.col("best.less")
    best = best.join(own, "_shape").select("_shape", F.col("best.name").alias(region), overlap.alias("overlap_area"), (overlap / F.col("area")).alias("overlap_ratio"))
    return members.join(best, "_shape").select(key, region, "overlap_area", "overlap_ratio")


def assigned_regions(
    areas: DataFrame, majority: DataFrame, overrides: dict[str, str], fallbacks: dict[str, str], key: str = "aoc_key", delegation: str = "dt"
) -> DataFrame:
    """areas with region, region_method and overlap_ratio: an override by key first, then the region that holds most of the
    area, then the fallback of the area's delegation; the ratio goes with the second only.

    Fails where an override's key is absent or occurs more than once, and where an area has no region in the end."""
    lists = [F.create_map(*[F.lit(x) for kv in d.items() for x in kv]) if d else F.lit(None).cast("map<string,string>") for d in (overrides, fallbacks)]
    forced = F.get(F.array(lists[0][F.col(key).cast("string")]), F.lit(0))
    majority = saved(majority)  # asked for by the checks as well
    found = areas.join(majority.select(key, F.col("region").alias("_most"), F.col("overlap_ratio").alias("_ratio")), key, "left")
    found = found.select(
        *areas.columns, forced.alias("_forced"), "_most", "_ratio", lists[1][F.col(delegation)].alias("_fallback"),
    )
    method = F.expr(
        "CASE WHEN _forced IS NOT NULL THEN 'explicit_override' WHEN _most IS NOT NULL THEN 'majority_overlap' WHEN _fallback IS NOT NULL THEN 'delegation_fallback' END"
    )
    out = found.select(
        *areas.columns, F.coalesce("_forced", "_most", "_fallback").alias("region"), method.alias("region_method"),
        F.when(method == "majority_overlap", F.col("_ratio")).alias("overlap_ratio"),
    )
    named = out.where(F.col(key).cast("string").isin(list(overrides))).groupBy(F.col(key).cast("string").alias("k")).agg(F.count("*").alias("n"))
    seen = {r.k: r.n for r in named.collect()}  # at most one row for each override
    faults = [f"override of absent {k}" for k in sorted(set(overrides) - set(seen))] + [f"override of repeated {k}" for k in sorted(seen) if seen[k] > 1]
    lost = out.where("region IS NULL").agg(F.count("*").alias("n"), F.min(key).alias("first")).first()
    if lost.n:
        faults.append(f"{lost.n} areas without a region, the first {lost['first']}")
    if faults:
        raise QualityError("; ".join(faults))
    return out
