"""Points assigned to areas: the area around a point, else the only one near enough."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sommelix.functions import geo
from sommelix.operators.quality import QualityError


def _steps(low: Column, high: Column, cell: float) -> Column:
    return F.explode(F.sequence(F.floor(low / cell), F.floor(high / cell)))


def assign_areas(
    points: DataFrame, areas: DataFrame, reach: float, cell: float, point_group: str | None = None, area_group: str | None = None
) -> DataFrame:
    """(id, code, how) for each row of points (id, x, y), from areas (code, rings); planar coordinates, ids and codes unique.

    ``rings`` lists all rings of an area, of its parts and its holes alike. ``how`` is ``within`` for a point strictly inside
    one area, ``overlap`` inside several, ``nearest`` where it is inside none and just one area is at most ``reach`` away,
    ``ambiguous`` where several are; code is null unless it is decided. Other points, also those with null or non-finite
    coordinates, have null in both. With groups, only areas of the point's group are near; any area may be around it.

    Points meet areas by grid cell: an area is written once for each cell of side ``cell`` that its envelope, widened by
    ``reach``, touches, so cells should not be much smaller than areas.
    """
    near_to = F.col("_point_group") == F.col("_area_group") if point_group else F.lit(True)
    p = points.select(
        F.col("id").alias("_id"),
        F.col("x").cast("double").alias("_x"),
        F.col("y").cast("double").alias("_y"),
        (F.col(point_group) if point_group else F.lit(None).cast("string")).alias("_point_group"),
    ).where("abs(_x) < 1e15 AND abs(_y) < 1e15")
    p = p.withColumns({"_cx": F.floor(F.col("_x") / cell), "_cy": F.floor(F.col("_y") / cell)})
    boxes = areas.where("exists(rings, r -> size(r) > 1)").select(
        F.col("code").alias("_code"),
        F.col("rings").alias("_rings"),
        (F.col(area_group) if area_group else F.lit(None).cast("string")).alias("_area_group"),
        F.flatten("rings").alias("_all"),
    )
    boxes = boxes.withColumn("_box", geo.envelope("_all")).drop("_all")
    a = boxes.withColumn("_cx", _steps(F.col("_box.min_x") - reach, F.col("_box.max_x") + reach, cell))
    a = a.withColumn("_cy", _steps(F.col("_box.min_y") - reach, F.col("_box.max_y") + reach, cell))
    in_box = F.expr(
        f"_x BETWEEN _box.min_x - {reach!r} AND _box.max_x + {reach!r} AND _y BETWEEN _box.min_y - {reach!r} AND _box.max_y + {reach!r}"
    )
    met = p.join(a, ["_cx", "_cy"]).where(in_box)
    met = met.withColumn("_in", geo.within_area("_rings", "_x", "_y"))
    met = met.withColumn("_near", ~F.col("_in") & near_to & (geo.distance_to_area("_rings", "_x", "_y") <= reach))
    found = met.groupBy("_id").agg(
        F.count_if("_in").alias("_n_in"),
        F.min(F.when(F.col("_in"), F.col("_code"))).alias("_in_code"),
        F.count_if("_near").alias("_n_near"),
        F.min(F.when(F.col("_near"), F.col("_code"))).alias("_near_code"),
    )
    how = F.expr(
        "CASE WHEN _n_in = 1 THEN 'within' WHEN _n_in > 1 THEN 'overlap' WHEN _n_near = 1 THEN 'nearest' WHEN _n_near > 1 THEN 'ambiguous' END"
    )
    code = F.expr("CASE WHEN _n_in = 1 THEN _in_code WHEN _n_in = 0 AND _n_near = 1 THEN _near_code END")
    return points.join(found, F.col("id") == F.col("_id"), "left").select("id", code.alias("code"), how.alias("how"))


def require_assigned(assigned: DataFrame) -> DataFrame:
    """Fails unless every point has its one area; gives the number, smallest and largest id of each fault."""
    faults = assigned.where("code IS NULL").groupBy(F.coalesce("how", F.lit("unmatched")).alias("fault")).agg(
        F.count("*").alias("n"), F.min("id").alias("first"), F.max("id").alias("last")
    )
    lost = faults.collect()  # at most three rows
    if lost:
        raise QualityError("; ".join(f"{r.fault}: {r.n} points, from {r.first} to {r.last}" for r in sorted(lost)))
    return assigned
