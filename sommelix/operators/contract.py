"""What each feature of a wine product must hold, as a report of its faults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sommelix.operators import evidence, packaging, validity
from sommelix.operators.lineage import saved
from sommelix.sources.files import polygons

# The product's properties in their order, those that tell one feature from another, and those that are texts.
PROPERTIES = ("region", "app", "display_name", "colour", "categorie", "prompt_signals", "source_area_m2")
IDENTITY = ("region", "app", "display_name", "colour", "categorie")
NAMES = ("region", "app", "display_name")


def rings_of(geometry: Column) -> Column:
    """All rings of a Polygon or MultiPolygon as arrays of x, y; null for other kinds and for coordinates that are none."""
    place = lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))
    return F.transform(F.flatten(polygons(geometry)), lambda ring: F.transform(ring, place))


def product_faults(features: DataFrame, key: str, cell: float, properties: tuple[str, ...] = PROPERTIES) -> DataFrame:
    """(check, n, first) of features: key, properties (JSON text) and geometry (kind, and coordinates as JSON text).

    Properties that are null, no object, or hold a name twice lack all. Numbers are JSON numbers, no texts. Signals, if they are
    among the properties, are what the category gives, letter by letter. Geometries without any ring are empty and are not
    looked at further; others that are areas must have no fault that ``validity.faults`` finds with this cell. Of features
    with one identity all but one count, any value and its absence being values."""
    dealt = features.select(F.col(key).alias("k"), "properties", "geometry").repartition("k")  # few files may hold many features
    rows = dealt.withColumn("v", F.try_parse_json("properties"))
    wanted = F.array(*map(F.lit, properties))
    value = lambda c: F.try_variant_get("v", f"$.{c}", "variant")
    kind = lambda c: F.coalesce(F.schema_of_variant(value(c)), F.lit("VOID"))
    said = lambda c: F.when(kind(c) == "STRING", F.try_variant_get("v", f"$.{c}", "string"))
    names = F.coalesce(F.when(F.col("v").isNotNull(), F.json_object_keys("properties")), F.array().cast("array<string>"))
    number = kind("source_area_m2").rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    made = rows.select(
        "k", "geometry", names.alias("names"), *[F.to_json(value(c)).alias(f"i_{c}") for c in IDENTITY],
        *[F.coalesce(F.trim(said(c)) == "", F.lit(True)).alias(f"b_{c}") for c in NAMES],
        F.coalesce(number & (F.try_variant_get("v", "$.source_area_m2", "double") >= 0), F.lit(False)).alias("area"),
        said("prompt_signals").eqNullSafe(packaging.canonical_signals(said("categorie"))).alias("canonical"),
        said("prompt_signals").alias("signals"), rings_of(F.col("geometry")).alias("rings"),
    )
    rows = saved(made)  # parsed once; read for the properties, the shapes and the identities
    is_area = F.coalesce(F.col("geometry.type").isin("Polygon", "MultiPolygon"), F.lit(False))
    empty = F.coalesce(F.regexp_replace("geometry.coordinates", r"[\[\],\s]", "") == "", F.lit(False))
    here = lambda fault, check: F.when(fault, F.array(F.lit(check)))
    found = [
        here(F.size(F.array_except(wanted, "names")) > 0, "missing property"),
        here(F.col("names") != wanted, "properties or their order"),
        *[here(F.col(f"b_{c}"), f"blank {c}") for c in NAMES],
        here(~F.col("area"), "no area in square metres"),
        here(F.col("geometry").isNull() | empty, "no geometry"),
        here(F.col("geometry").isNotNull() & ~is_area, "neither Polygon nor MultiPolygon"),
    ]
    if "prompt_signals" in properties:
        found.append(here(F.col("signals").isNull() | ~F.col("canonical"), "signals not those of the category"))
    alone = rows.select("k", F.explode(F.flatten(F.array_compact(F.array(*found)))).alias("check"))
    shapes = rows.where(F.col("geometry").isNotNull() & is_area & ~empty).select("k", "rings")
    bad = validity.faults(shapes, "k", cell).select("k", F.concat(F.lit("geometry: "), "kind").alias("check")).distinct()
    every = alone.unionByName(bad).groupBy("check").agg(F.count("*").alias("n"), F.min(F.col("k").cast("string")).alias("first"))
    same = rows.select("k", *[F.coalesce(f"i_{c}", F.lit("null")).alias(c) for c in IDENTITY])
    return evidence.together(every, evidence.repeated_rows(same, list(IDENTITY), "k", "identity"))
