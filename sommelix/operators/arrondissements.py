"""Restaurants by arrondissement: those of a capital by postcode, all others by where they lie; counts and coordinates of each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sommelix.functions import geo
from sommelix.operators import spatial
from sommelix.operators.evidence import counts_reconcile, filled, keys, required, together
from sommelix.operators.joins import checked_join
from sommelix.operators.rollups import CLASSES, locations_text, star_counts


def ordinal_table(cells: DataFrame, number: str, name: str) -> DataFrame:
    """(arrondissement_number, ordinal, name, label) from the text of a table's cells: a number of one or two digits that may
    have its English ending, and what follows it; rows without a number are headings and leave."""
    text = F.trim(F.regexp_replace(F.col(number), r"\s+", " "))
    digits = F.regexp_extract(text, r"(\d{1,2})", 1)
    ending = F.regexp_extract(text, r"(\d{1,2}(?:st|nd|rd|th))", 1)
    value = F.when(digits != "", digits.cast("int"))
    last = F.when(value.between(11, 13), "th").otherwise(F.element_at(F.array(*[F.lit(x) for x in ("th", "st", "nd", "rd", *["th"] * 6)]), value % 10 + 1))
    ordinal = F.when(ending != "", ending).otherwise(F.concat(value, last))
    rows = cells.select(value.alias("arrondissement_number"), ordinal.alias("ordinal"), F.trim(name).alias("name")).where("arrondissement_number IS NOT NULL")
    return rows.withColumn("label", F.concat("ordinal", F.lit(" ("), "name", F.lit(")")))


def located(restaurants: DataFrame, outlines: DataFrame, row: str = "source_row", reach: float = 5000.0, cell: float = 50_000.0) -> DataFrame:
    """(row, code, how): restaurants (longitude, latitude, department_num) in outlines (code, rings in degrees) by their places in
    metres; one that lies in none takes the only one of its department within ``reach`` metres. See ``spatial.assign_areas``."""
    point = geo.lambert93(F.col("longitude"), F.col("latitude"))
    points = restaurants.select(F.col(row).alias("id"), point.alias("p"), F.col("department_num").cast("string").alias("department"))
    points = points.select("id", F.col("p.x").alias("x"), F.col("p.y").alias("y"), "department")
    metres = F.transform("rings", lambda r: F.transform(r, lambda p: geo.lambert93(p["x"], p["y"])))
    areas = outlines.select("code", metres.alias("rings"), F.substring("code", 1, 2).alias("of"))
    return spatial.assign_areas(points, areas, reach, cell, "department", "of").select(F.col("id").alias(row), "code", "how")


def product(assigned: DataFrame, outlines: DataFrame, departments: DataFrame, key: str = "arrondissement") -> DataFrame:
    """One row for each outline (code, key): its department's names, counts of its restaurants by class, zeros included, the
    stars they have in all, and their coordinates by class as text, ``None`` for classes without any.

    Fails where keys repeat, an outline has no department, or the counts do not add up to the restaurants."""
    classes = [c for _, _, c in CLASSES]
    counts = star_counts(assigned, [key])
    base = outlines.select("code", key, F.substring("code", 1, 2).alias("department_num"))
    base = checked_join(base, departments.select("department_num", "department", "capital", "region"), [("department_num", "department_num")])
    required(together(keys(base, key, "outlines"), filled(base, ["department", "capital", "region"], "code", "outlines")))
    made = base.join(counts, key, "left").na.fill(0, counts.columns[1:])
    required(counts_reconcile(made, classes, assigned, "arrondissements"))
    nowhere = "{" + ", ".join(f"'{label}': None" for _, label, _ in CLASSES) + "}"
    return made.join(locations_text(assigned, [key]), key, "left").na.fill(nowhere, ["locations"])


def with_prefix(code: Column, prefix: str) -> Column:
    """The code begins with the prefix; null does not."""
    return F.coalesce(code.startswith(prefix), F.lit(False))
