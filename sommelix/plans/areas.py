"""Queries on areas: shapes placed by the keys of customers and nations, with coordinates that are exact in binary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sommelix.operators import borders, contract, dissolve, overlay, packaging, partition, tiling, validity
from sommelix.plans.registry import query


def _ring(points: list[tuple[Column, Column]]) -> Column:
    corners = [F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")) for x, y in points]
    return F.array(*corners, corners[0])


def _box(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return _ring([(x1, y1), (x2, y1), (x2, y2), (x1, y2)])


# Areas are boxes with a square hole; regions lie on a lattice, with gaps between them and a hole each.
_PLACED = """
a AS (SELECT CAST(c_custkey AS VARCHAR) AS aoc_key, 'D' || (c_custkey % 3) AS dt, (c_custkey * 7 % 96) / 4 AS x1, (c_custkey * 13 % 96) / 4 AS y1,
  (c_custkey * 7 % 96) / 4 + 1 + (c_custkey % 5) / 2 AS x2, (c_custkey * 13 % 96) / 4 + 1 + (c_custkey % 3) / 2 AS y2 FROM customer),
r AS (SELECT n_name AS region, 5 * (n_nationkey % 5) AS x1, 5 * (n_nationkey // 5) AS y1 FROM nation),
"""


def _sql_shared(a: tuple[str, ...], r: tuple[str, ...]) -> str:
    return " * ".join(f"greatest(0, least({a[i + 2]}, {r[i + 2]}) - greatest({a[i]}, {r[i]}))" for i in (0, 1))


_A, _A_HOLE = ("a.x1", "a.y1", "a.x2", "a.y2"), ("a.x1 + 0.25", "a.y1 + 0.25", "a.x1 + 0.75", "a.y1 + 0.75")
_R, _R_HOLE = ("r.x1", "r.y1", "r.x1 + 4.5", "r.y1 + 4.5"), ("r.x1 + 1", "r.y1 + 1", "r.x1 + 2", "r.y1 + 2")
_MAJORITY = f"""{_PLACED}
s AS (SELECT aoc_key, region, (x2a - x1a) * (y2a - y1a) - 0.25 AS size, CAST(o AS DOUBLE) AS o FROM (
  SELECT aoc_key, region, a.x1 AS x1a, a.x2 AS x2a, a.y1 AS y1a, a.y2 AS y2a, {_sql_shared(_A, _R)} - {_sql_shared(_A_HOLE, _R)} - {_sql_shared(_A, _R_HOLE)} + {_sql_shared(_A_HOLE, _R_HOLE)} AS o
  FROM a, r) WHERE o > 0),
m AS (SELECT aoc_key, region, o AS overlap_area, o / size AS overlap_ratio FROM s QUALIFY row_number() OVER (PARTITION BY aoc_key ORDER BY o DESC, region) = 1)
"""


def _placed(table) -> tuple[DataFrame, DataFrame]:
    k = F.col("c_custkey")
    x, y = (k * 7 % 96) / 4, (k * 13 % 96) / 4
    shell, hole = _box(x, y, x + 1 + k % 5 / 2, y + 1 + k % 3 / 2), _box(x + 0.25, y + 0.25, x + 0.75, y + 0.75)
    areas = table("customer").select(k.cast("string").alias("aoc_key"), F.concat(F.lit("D"), k % 3).alias("dt"), F.array(shell, hole).alias("rings"))
    x, y = 5 * (F.col("n_nationkey") % 5), 5 * F.floor(F.col("n_nationkey") / 5)
    shell, hole = _box(x, y, x + 4.5, y + 4.5), _box(x + 1, y + 1, x + 2, y + 2)
    return areas, table("nation").select(F.col("n_name").alias("region"), F.array(shell, hole).alias("rings"))


@query(f"WITH {_MAJORITY} SELECT * FROM m")
def majority_regions(table):
    return overlay.majority_overlap(*_placed(table))


@query(f"""WITH {_MAJORITY} SELECT a.aoc_key, dt, CASE a.aoc_key WHEN '1' THEN 'FORCED' WHEN '4' THEN 'FORCED' ELSE coalesce(region, 'OF ' || dt) END AS region,
  CASE WHEN a.aoc_key IN ('1', '4') THEN 'explicit_override' WHEN region IS NOT NULL THEN 'majority_overlap' ELSE 'delegation_fallback' END AS region_method,
  CASE WHEN a.aoc_key NOT IN ('1', '4') THEN overlap_ratio END AS overlap_ratio FROM a LEFT JOIN m USING (aoc_key)""")
def assigned_regions(table):
    areas, regions = _placed(table)
    fallbacks = {f"D{i}": f"OF D{i}" for i in range(3)}
    named = overlay.assigned_regions(areas.drop("rings"), overlay.majority_overlap(areas, regions), {"1": "FORCED", "4": "FORCED"}, fallbacks)
    return named.select("aoc_key", "dt", "region", "region_method", "overlap_ratio")


# Some unit squares of a lattice, joined by blocks of eight by eight. Outlines less holes are squares less neighbours plus full fours.
@query("""WITH c AS (SELECT c_custkey % 64 AS x, c_custkey // 64 AS y, (c_custkey % 64 // 8) * 1000 + c_custkey // 64 // 8 AS block FROM customer WHERE c_custkey * c_custkey % 11 <> 3),
n AS (SELECT c.*, r.x IS NOT NULL AS rt, u.x IS NOT NULL AS up, r.x IS NOT NULL AND u.x IS NOT NULL AND d.x IS NOT NULL AS four FROM c
  LEFT JOIN c r ON r.x = c.x + 1 AND r.y = c.y AND r.block = c.block LEFT JOIN c u ON u.x = c.x AND u.y = c.y + 1 AND u.block = c.block
  LEFT JOIN c d ON d.x = c.x + 1 AND d.y = c.y + 1 AND d.block = c.block)
SELECT block, CAST(count(*) AS DOUBLE) AS area, CAST(4 * count(*) - 2 * (count(*) FILTER (rt) + count(*) FILTER (up)) AS DOUBLE) AS perimeter,
  count(*) - count(*) FILTER (rt) - count(*) FILTER (up) + count(*) FILTER (four) AS outlines_less_holes FROM n GROUP BY block""")
def dissolved_blocks(table):
    k = F.col("c_custkey")
    x, y = k % 64, F.floor(k / 64)
    block = (F.floor(x / 8) * 1000 + F.floor(y / 8)).alias("block")
    cells = table("customer").where("c_custkey * c_custkey % 11 <> 3").select(block, F.array(_box(x, y, x + 1, y + 1)).alias("rings"))
    rings = dissolve.dissolved(cells, "block").select("block", F.explode("rings").alias("ring"))
    length = F.aggregate(tiling.ring_edges(F.col("ring")), F.lit(0.0), lambda s, e: s + F.abs(e["b"]["x"] - e["a"]["x"]) + F.abs(e["b"]["y"] - e["a"]["y"]))
    area = tiling.signed_area(F.col("ring"))
    return rings.groupBy("block").agg(
        F.sum(area).alias("area"), F.sum(length).alias("perimeter"), F.sum(F.signum(area)).cast("long").alias("outlines_less_holes")
    )


_BOXES = """
b AS (SELECT c_custkey AS k, c_name AS name, c_custkey * 37 % 251 AS x, c_custkey * 53 % 241 AS y, 1 + c_custkey % 4 AS w, 1 + c_custkey // 4 % 3 AS h FROM customer),
p AS (SELECT *, row_number() OVER (ORDER BY w * h, name, k) AS priority_rank FROM b),
u AS (SELECT k, priority_rank, x + i AS cx, unnest(range(y, y + h)) AS cy FROM (SELECT *, unnest(range(w)) AS i FROM p)),
o AS (SELECT cx, cy, min(priority_rank) AS priority_rank FROM u GROUP BY cx, cy)
"""


def _boxes(table) -> DataFrame:
    k = F.col("c_custkey")
    x, y = k * 37 % 251, k * 53 % 241
    rings = F.array(_box(x, y, x + 1 + k % 4, y + 1 + F.floor(k / 4) % 3))
    return table("customer").select(k.alias("k"), F.col("c_name").alias("name"), rings.alias("rings"))


@query(f"""WITH {_BOXES}, f AS (SELECT priority_rank, count(*) AS final FROM o GROUP BY priority_rank)
SELECT k, name, p.priority_rank, CAST(w * h AS DOUBLE) AS original_area, CAST(coalesce(final, 0) AS DOUBLE) AS final_area,
  CAST(w * h - coalesce(final, 0) AS DOUBLE) AS removed_area, CAST(w * h - coalesce(final, 0) AS DOUBLE) / (w * h) * 100 AS removed_percent,
  final IS NULL AS became_empty, CAST(final AS DOUBLE) AS outline_area FROM p LEFT JOIN f USING (priority_rank)""")
def smallest_wins(table):
    outlines, report = partition.smallest_wins(_boxes(table), "k", "name")
    return report.join(tiling.area_of(outlines, "k").withColumnRenamed("area", "outline_area"), "k", "left")


@query(f"""WITH {_BOXES} SELECT CAST((SELECT sum(w * h) FROM b) AS DOUBLE) AS summed_area, CAST((SELECT count(*) FROM o) AS DOUBLE) AS union_area,
  CAST((SELECT sum(w * h) FROM b) - (SELECT count(*) FROM o) AS DOUBLE) AS overlap_area""")
def overlap_metrics(table):
    return partition.overlap_metrics(_boxes(table), "k")


def bulging(table) -> DataFrame:
    """Unit squares whose borders bulge by a sixteenth halfway; neighbours have the same bulge."""
    k = F.col("c_custkey")
    x, y, bulge = k % 50, F.floor(k / 50), 0.0625
    ring = _ring([(x, y), (x + 0.5, y + bulge), (x + 1, y), (x + 1 + bulge, y + 0.5), (x + 1, y + 1), (x + 0.5, y + 1 + bulge), (x, y + 1), (x + bulge, y + 0.5)])
    return table("customer").select(k.alias("k"), F.array(ring).alias("rings"))


@query("""SELECT c_custkey AS k, 9 AS points_before, 5 AS points_after, CAST(1 AS DOUBLE) AS area, CAST(c_custkey % 50 AS DOUBLE) AS west,
  CAST(c_custkey // 50 AS DOUBLE) AS south FROM customer""")
def simplified_borders(table):
    ring = F.col("rings")[0]
    return borders.simplified(bulging(table), "k", 0.1).select(
        "k", F.lit(9).alias("points_before"), F.size(ring).alias("points_after"), F.abs(tiling.signed_area(ring)).alias("area"),
        F.array_min(ring["x"]).alias("west"), F.array_min(ring["y"]).alias("south"),
    )


# Every eighth area has the same fault, at a place of its own.
@query("""WITH p AS (SELECT c_custkey AS k, CAST(c_custkey % 101 AS DOUBLE) AS x, CAST(c_custkey % 89 AS DOUBLE) AS y FROM customer)
SELECT k, 'crossing' AS kind, x + 1 AS x, y + 1 AS y FROM p WHERE k % 8 = 1 UNION ALL SELECT k, 'no area', x, y FROM p WHERE k % 8 = 1
UNION ALL SELECT k, 'not closed', x + 1, y + 1 FROM p WHERE k % 8 = 2 UNION ALL SELECT k, 'too few points', x, y FROM p WHERE k % 8 = 2
UNION ALL SELECT k, 'repeated point', x + 2, y FROM p WHERE k % 8 = 3 UNION ALL SELECT k, 'no rings', NULL, NULL FROM p WHERE k % 8 = 4
UNION ALL SELECT k, 'overlap', x + 2, y FROM p WHERE k % 8 = 5""")
def area_faults(table):
    k = F.col("c_custkey")
    x, y = (k % 101).cast("double"), (k % 89).cast("double")
    at = lambda *points: [(x + a, y + b) for a, b in points]
    made = {
        1: F.array(_ring(at((0, 0), (2, 2), (2, 0), (0, 2)))),
        2: F.array(F.slice(_ring(at((0, 0), (1, 0), (1, 1))), 1, 3)),
        3: F.array(_ring(at((0, 0), (2, 0), (2, 0), (2, 1)))),
        4: F.array().cast(tiling.POINTS),
        5: F.array(_box(x, y, x + 3, y + 3), _ring(at((2, 0), (3, 0), (2.5, -1)))),
    }
    rings = F.array(_box(x, y, x + 2, y + 2))
    for fault, shape in made.items():
        rings = F.when(k % 8 == fault, shape).otherwise(rings)
    return validity.faults(table("customer").select(k.alias("k"), rings.alias("rings")), "k", 2.0)


# Lattice squares as parcels of overlapping appellations: each square belongs to its block, every fifth to the next block too.
@query("""WITH c AS (SELECT c_custkey AS k, c_custkey % 60 AS x, c_custkey // 60 AS y, c_custkey % 60 // 6 AS b, CASE c_custkey % 9 WHEN 0 THEN 'Cidre' WHEN 1 THEN ' Vin mousseux ' ELSE 'vin tranquille' END AS kind FROM customer),
p AS (SELECT k * 2 AS o, x, y, b, kind FROM c UNION ALL SELECT k * 2 + 1, x, y, (b + 1) % 10, kind FROM c WHERE k % 5 = 0),
w AS (SELECT * FROM p WHERE kind <> 'Cidre')
SELECT 'App ' || b AS app, CAST(b AS VARCHAR) AS id_app, 'D' || (b % 2) AS dt, trim(arg_min(kind, o)) AS categorie, CAST(count(DISTINCT (x, y)) AS DOUBLE) AS area FROM w GROUP BY b""")
def packaged_areas(table):
    k = F.col("c_custkey")
    x, y, block = k % 60, F.floor(k / 60), F.floor(k % 60 / 6)
    kind = F.when(k % 9 == 0, "Cidre").when(k % 9 == 1, " Vin mousseux ").otherwise("vin tranquille")
    rings = F.array(_box(x, y, x + 1, y + 1)).alias("rings")
    own = table("customer").select((k * 2).alias("source_order"), block.alias("b"), kind.alias("categorie"), rings)
    more = table("customer").where("c_custkey % 5 = 0").select((k * 2 + 1).alias("source_order"), ((block + 1) % 10).alias("b"), kind.alias("categorie"), rings)
    parcels = own.unionByName(more).select(
        "source_order", F.concat(F.lit("App "), "b").alias("app"), F.col("b").cast("string").alias("id_app"), F.concat(F.lit("D"), F.col("b") % 2).alias("dt"), "categorie", "rings"
    )
    made = packaging.packaged(parcels, 0.1)[0]
    return made.join(tiling.area_of(made.withColumnRenamed("app", "key").select("key", "rings"), "key").withColumnRenamed("key", "app"), "app").drop("rings")


@query("""WITH o AS (SELECT o_orderkey AS k FROM orders)
SELECT k, CASE k % 4 WHEN 0 THEN '[]' WHEN 1 THEN '["sparkling"]' WHEN 2 THEN '["late_harvest","cremant"]' ELSE '["sparkling","straw_wine"]' END AS signals FROM o""")
def prompt_signals(table):
    k = F.col("o_orderkey") % 4
    kinds = (
        F.when(k == 0, "Vin tranquille").when(k == 1, "Vin mousseux, Vin tranquille,, Vin pétillant ")
        .when(k == 2, 'Vin de vendanges tardives,Vin mousseux "Crémant"').otherwise("Vin pétillant, Vin de paille, Vin mousseux")
    )
    return table("orders").select(F.col("o_orderkey").alias("k"), F.to_json(packaging.prompt_signals(kinds)).alias("signals"))


@query("""WITH r AS (SELECT c_custkey AS k FROM customer), v AS (SELECT k, CASE k % 10 WHEN 1 THEN 'rejected' WHEN 2 THEN ' rerun_required' WHEN 3 THEN '' WHEN 4 THEN NULL WHEN 5 THEN 'perhaps' ELSE 'approved' END AS s FROM r WHERE k % 10 > 0)
SELECT 'rejected or to be run again' AS "check", count(*) AS n, min(CAST(k AS VARCHAR)) AS first FROM v WHERE k % 10 IN (1, 2)
UNION ALL SELECT 'no review', count(*), min(CAST(k AS VARCHAR)) FROM r WHERE k % 10 = 0
UNION ALL SELECT 'not approved', count(*), min(CAST(k AS VARCHAR)) FROM r WHERE k % 10 <= 5
UNION ALL SELECT 'unknown state', count(*), min(CAST(k AS VARCHAR)) FROM v WHERE k % 10 = 5""")
def review_gate(table):
    k = F.col("c_custkey") % 10
    regions = table("customer").select(F.col("c_custkey").alias("region"))
    state = F.when(k == 1, "rejected").when(k == 2, " rerun_required").when(k == 3, "").when(k == 5, "perhaps").when(k != 4, "approved")
    reviews = table("customer").where("c_custkey % 10 > 0").select(F.col("c_custkey").alias("region"), state.alias("review_status"))
    return packaging.review_gate(regions, reviews, "region", True)


# A product's feature for each customer; of fifty, each of the first twelve is wrong in a way of its own.
@query("""WITH f AS (SELECT c_custkey AS k, c_custkey % 50 AS m, CAST(c_custkey AS VARCHAR) AS t FROM customer)
SELECT "check", count(*) AS n, min(t) AS first FROM f JOIN (VALUES (1, 'missing property'), (1, 'properties or their order'), (2, 'properties or their order'),
  (3, 'blank app'), (4, 'no area in square metres'), (5, 'no area in square metres'), (6, 'no geometry'), (7, 'neither Polygon nor MultiPolygon'),
  (8, 'geometry: crossing'), (8, 'geometry: no area'), (9, 'signals not those of the category'), (10, 'signals not those of the category'),
  (11, 'identity: repeated rows')) c(m, "check") USING (m) GROUP BY 1""")
def product_contract(table):
    k, m = F.col("c_custkey"), F.col("c_custkey") % 50
    kind = F.when(m == 10, "Vin inconnu").otherwise("Vin mousseux, Vin de paille")
    texts = {
        "region": F.concat(F.lit("R"), F.floor(k / 50)), "app": F.when(m == 3, " ").otherwise(F.concat(F.lit("App "), F.when(m == 11, k + 1).otherwise(k))),
        "display_name": F.lit("Name"), "colour": F.lit("red"), "categorie": kind, "prompt_signals": F.when(m == 9, "[]").otherwise('["sparkling","straw_wine"]'),
    }
    size = F.when(m == 4, "-1.5").when(m == 5, '"12"').otherwise("12.5")
    member = lambda c: F.concat(F.lit(f'"{c}":'), F.concat(F.lit('"'), F.regexp_replace(texts[c], '"', r'\\"'), F.lit('"')))
    members = F.array(*[F.when(F.lit(c != "colour") | (m != 1), member(c)) for c in texts], F.concat(F.lit('"source_area_m2":'), size))
    members = F.array_compact(members)
    properties = F.concat(F.lit("{"), F.array_join(F.when(m == 2, F.reverse(members)).otherwise(members), ","), F.lit("}"))
    x = (k * 2).cast("string")
    at = lambda a, b: F.format_string("[%d,%d]", k * 2 + a, F.lit(b))
    ring = lambda *points: F.concat(F.lit("[["), F.concat_ws(",", *points), F.lit("]]"))
    box, bow = ring(at(0, 0), at(1, 0), at(1, 1), at(0, 1), at(0, 0)), ring(at(0, 0), at(1, 1), at(1, 0), at(0, 1), at(0, 0))
    coordinates = F.when(m == 7, F.concat(F.lit("["), x, F.lit(",0]"))).when(m == 8, bow).otherwise(box)
    geometry = F.when(m != 6, F.struct(F.when(m == 7, "Point").otherwise("Polygon").alias("type"), coordinates.alias("coordinates")))
    return contract.product_faults(table("customer").select(k.alias("feature"), properties.alias("properties"), geometry.alias("geometry")), "feature", 1.0)
