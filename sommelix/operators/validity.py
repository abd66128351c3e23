"""Faults of areas, each with its kind and place: rings that are no rings, and edges that cross."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sommelix.operators import tiling
from sommelix.operators.quality import QualityError


#: Up to so many edges of an area are compared where the area is; more meet by grid cell.
FEW_EDGES = 32


def _steps(low: Column, high: Column, cell: float) -> Column:
    return F.explode(F.sequence(F.floor(low / cell), F.floor(high / cell)))


def ring_faults(areas: DataFrame, key: str) -> DataFrame:
    """(key, kind, ring, x, y): faults that a ring shows by itself, one row for each kind and ring.

    ``no rings`` (null or empty, ring -1), ``null or non-finite`` (which hides the others), ``not closed``, ``too few points``
    (fewer than four), ``repeated point`` (two in a row, the first place), ``no area`` (of rings without other faults)."""
    none = areas.where("rings IS NULL OR size(rings) = 0").select(
        F.col(key), F.lit("no rings").alias("kind"), F.lit(-1).alias("ring"), *[F.lit(None).cast("double").alias(d) for d in "xy"]
    )
    rows = areas.select(F.col(key).alias("owner"), F.posexplode("rings").alias("no", "r"))
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    broken = F.col("r").isNull() | F.exists("r", lambda p: p.isNull() | bad(p["x"]) | bad(p["y"]))
    place = lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))
    here = lambda kind, p: F.struct(F.lit(kind).alias("kind"), place(p).alias("p"))
    first, last, n = F.get("r", F.lit(0)), F.get("r", F.size("r") - 1), F.size("r")
    again = F.filter("r", lambda p, i: (i > 0) & (p == F.get("r", i - 1)))
    nowhere = F.struct(F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y"))
    found = F.array_compact(
        F.array(
            F.when((n > 0) & (first != last), here("not closed", last)),
            F.when(n < 4, F.struct(F.lit("too few points").alias("kind"), F.coalesce(first, nowhere).alias("p"))),
            F.when(F.size(again) > 0, here("repeated point", F.get(again, F.lit(0)))),
            F.when((n > 3) & (first == last) & (F.size(again) == 0) & (tiling.signed_area(F.col("r")) == 0), here("no area", first)),
        )
    )
    alone = F.array(F.struct(F.lit("null or non-finite").alias("kind"), nowhere.alias("p")))
    shown = rows.select("owner", "no", F.explode(F.when(broken, alone).otherwise(found)).alias("f"))
    return none.unionByName(shown.select(F.col("owner").alias(key), "f.kind", F.col("no").alias("ring"), "f.p.x", "f.p.y"))


def crossings(areas: DataFrame, key: str, cell: float) -> DataFrame:
    """(key, kind, x, y): places where two edges of one area cross inside both (``crossing``) or run along each other
    (``overlap``, the first common point), once each.

    Areas of few edges are looked at row by row. Edges of others meet by area and grid cell of side ``cell``; a pair is looked at in the cell of its lower left common corner only, so
    cells should be of the order of an edge's length."""
    ends = lambda e, d: (F.least(e["a"][d], e["b"][d]), F.greatest(e["a"][d], e["b"][d]))
    near = lambda e: (F.abs(e["a"]["x"]) < 1e15) & (F.abs(e["a"]["y"]) < 1e15) & (F.abs(e["b"]["x"]) < 1e15) & (F.abs(e["b"]["y"]) < 1e15)
    of_ring = lambda r: F.filter(tiling.ring_edges(r), lambda e: (e["a"] != e["b"]) & near(e))
    shaped = areas.select(F.col(key).alias("owner"), F.filter("rings", lambda r: F.size(r) > 1).alias("rings"))
    n_edges = F.aggregate("rings", F.lit(0), lambda s, r: s + F.size(r) - 1)
    # areas of few edges: what each edge may cross among those after it
    few = shaped.where(n_edges <= FEW_EDGES).select("owner", F.flatten(F.transform("rings", of_ring)).alias("all"))
    few = few.select("owner", "all", F.posexplode("all").alias("i", "e"))

    def meet(e: Column, f: Column) -> Column:
        (e_x, e_x2), (e_y, e_y2), (f_x, f_x2), (f_y, f_y2) = (ends(v, d) for v in (e, f) for d in "xy")
        return (e_x <= f_x2) & (f_x <= e_x2) & (e_y <= f_y2) & (f_y <= e_y2)

    few = few.select("owner", "e", F.explode(F.filter("all", lambda f, j: (j > F.col("i")) & meet(F.col("e"), f))).alias("f"))
    # others: edges meet by area and cell
    edges = shaped.where(n_edges > FEW_EDGES).select("owner", F.posexplode("rings").alias("no", "r"))
    edges = edges.select("owner", "no", F.posexplode(of_ring(F.col("r"))).alias("i", "e"))
    edges = edges.withColumns({f"{f}_{d}": v for d in "xy" for f, v in zip(("low", "high"), ends(F.col("e"), d))})
    cells = edges.withColumn("cx", _steps(F.col("low_x"), F.col("high_x"), cell)).withColumn("cy", _steps(F.col("low_y"), F.col("high_y"), cell))
    other = cells.select(
        "owner", "cx", "cy", F.struct("no", "i").alias("o"), F.col("e").alias("f"), *[F.col(f"{p}_{d}").alias(f"o_{p}_{d}") for p in ("low", "high") for d in "xy"]
    )
    met = cells.join(other, ["owner", "cx", "cy"]).where(
        "struct(no, i) < o AND low_x <= o_high_x AND o_low_x <= high_x AND low_y <= o_high_y AND o_low_y <= high_y"
    )
    for d in "xy":
        met = met.where(F.floor(F.greatest(f"low_{d}", f"o_low_{d}") / cell) == F.col(f"c{d}"))
    met = few.unionByName(met.select("owner", "e", "f"))
    at = lambda p, d: F.col(f"{p}.{d}")
    side = lambda a, b, p: (at(b, "x") - at(a, "x")) * (at(p, "y") - at(a, "y")) - (at(b, "y") - at(a, "y")) * (at(p, "x") - at(a, "x"))
    met = met.select(
        "owner", F.col("e.a").alias("a"), F.col("e.b").alias("b"), F.col("f.a").alias("c"), F.col("f.b").alias("d")
    ).withColumns({"sc": side("a", "b", "c"), "sd": side("a", "b", "d"), "sa": side("c", "d", "a"), "sb": side("c", "d", "b")})
    share = F.col("sa") / (F.col("sa") - F.col("sb"))
    cross = F.struct(*[(at("a", d) + (at("b", d) - at("a", d)) * share).alias(d) for d in "xy"])
    # on one line: the larger of the two first ends, if it comes before both last ends
    low, high = F.greatest(F.least("a", "b"), F.least("c", "d")), F.least(F.greatest("a", "b"), F.greatest("c", "d"))
    proper = (F.col("sc") * F.col("sd") < 0) & (F.col("sa") * F.col("sb") < 0)
    along = (F.col("sc") == 0) & (F.col("sd") == 0) & (low < high)
    found = met.where(proper | along).select("owner", F.when(proper, "crossing").otherwise("overlap").alias("kind"), F.when(proper, cross).otherwise(low).alias("p"))
    return found.distinct().select(F.col("owner").alias(key), "kind", "p.x", "p.y")


def faults(areas: DataFrame, key: str, cell: float) -> DataFrame:
    """(key, kind, x, y) of all faults; areas without any have no row."""
    return ring_faults(areas, key).select(key, "kind", "x", "y").unionByName(crossings(areas, key, cell))


def require_valid(areas: DataFrame, key: str, cell: float) -> DataFrame:
    """Fails unless no area has a fault; names the number, the first key and place of each kind."""
    found = faults(areas, key, cell).groupBy("kind").agg(F.count("*").alias("n"), F.min(F.struct(F.col(key), "x", "y")).alias("first"))
    lost = found.collect()  # one row a kind
    if lost:
        raise QualityError("; ".join(f"{r.kind}: {r.n}, first in {r['first'][0]} at ({r['first'].x}, {r['first'].y})" for r in sorted(lost)))
    return areas
