"""Parcels of wine areas packaged to one outline each, what their categories say, and whether reviews let them out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sommelix.operators import borders, evidence, partition
from sommelix.operators.lineage import saved
from sommelix.operators.quality import QualityError

# What makes a category one of wine, the category without a signal, and the signals of the others.
WINE = r"(?i)\bVin\b"
STILL = "Vin tranquille"
SIGNALS = {
    "Vin mousseux": "sparkling",
    'Vin mousseux "Crémant"': "cremant",
    'Vin mousseux "Méthode ancestrale"': "ancestral_method",
    "Vin pétillant": "sparkling",
    "Vin de sélection de grains nobles": "noble_rot_botrytis",
    "Vin de vendanges tardives": "late_harvest",
    "Vin de triees successives": "successive_pickings",
    "Vin doux naturel": "fortified_sweet",
    "Vin de liqueur": "fortified_or_liqueur_wine",
    "Vin jaune": "oxidative_speciality",
    "Vin de paille": "straw_wine",
    "Vin primeur": "primeur",
    "Vin sur lie": "sur_lie",
}
# What a reviewer may say, and what holds a region back.
REVIEWS = ("", "pending", "approved", "rejected", "rerun_required")
BLOCKING = ("rejected", "rerun_required")
FIELDS = ("app", "id_app", "dt", "categorie")


def is_wine(category: Column) -> Column:
    """The category holds the word for wine, in any case; null does not."""
    return F.coalesce(F.trim(category).rlike(WINE), F.lit(False))


def packaged(parcels: DataFrame, tolerance: float, order: str = "source_order") -> tuple[DataFrame, DataFrame, DataFrame]:
    """One row for each app and id_app of wine parcels, with the outline of all of them; what was left out; mixed groups.

    Texts are trimmed. Parcels (FIELDS, rings, and their place in the source) are simplified with their shared borders kept, then
    joined, whether they adjoin or overlap. dt is the same in all rows of a group; the category is that of the first row, and
    groups with several are listed. Fails without any wine, where dt differs or is missing, or an outline is lost."""
    trimmed = parcels.select(order, *[F.trim(F.col(c).cast("string")).alias(c) for c in FIELDS], "rings")
    wine = saved(trimmed.where(is_wine(F.col("categorie"))))
    left_out = trimmed.where(~is_wine(F.col("categorie"))).select("app", "id_app", "categorie").distinct()
    group = ["app", "id_app"]
    kinds = F.array_sort(F.collect_set("categorie"))  # as many as a group has categories
    groups = saved(
        wine.groupBy(*group).agg(
            F.count_distinct("dt").alias("n_dt"), F.min("dt").alias("dt"), F.min_by("categorie", order).alias("categorie"), kinds.alias("categories")
        )
    )
    faults = groups.where("n_dt <> 1").agg(F.count("*").alias("n"), F.min("app").alias("first")).first()
    if faults.n or groups.isEmpty():
        raise QualityError(f"{faults.n} groups without just one dt, the first {faults['first']}" if faults.n else "no parcel is one of wine")
    lines = borders.simplified(wine.select(F.col(order).alias("part"), "rings"), "part", tolerance)
    key = F.to_json(F.struct(*group), {"ignoreNullFields": "false"})
    parts = saved(lines.join(wine.select(F.col(order).alias("part"), key.alias("key")), "part"))
    made = groups.withColumn("key", key).join(partition.joined(parts, "key"), "key", "left")
    made = saved(made.select(*FIELDS, "rings", "categories"))
    evidence.required(evidence.filled(made, ["rings"], "app", "packages"))
    return made.drop("categories"), left_out, made.where("size(categories) > 1").select(*group, "categories")


def _signals(category: Column) -> tuple[Column, Column, Column]:
    """Of a list of categories with commas between them: how many, those that are unknown, and the signals in order without repeats."""
    items = F.filter(F.transform(F.split(category, ","), lambda c: F.trim(c)), lambda c: c != "")
    table = F.create_map(*[F.lit(x) for kv in SIGNALS.items() for x in kv])
    unknown = F.array_sort(F.array_distinct(F.filter(items, lambda c: (c != STILL) & F.get(F.array(table[c]), F.lit(0)).isNull())))
    return F.size(items), unknown, F.array_distinct(F.array_compact(F.transform(items, lambda c: table[c])))


def prompt_signals(category: Column) -> Column:
    """Signals of a list of categories; an error for a category that is unknown, and where there is none. As compact JSON, use
    ``F.to_json``."""
    n, unknown, signals = _signals(category)
    return (
        F.when(category.isNull() | (n == 0), F.raise_error(F.lit("a product has no category")).cast("array<string>"))
        .when(F.size(unknown) > 0, F.raise_error(F.concat(F.lit("categories without a signal: "), F.array_join(unknown, ", "))).cast("array<string>"))
        .otherwise(signals)
    )


def canonical_signals(category: Column) -> Column:
    """The signals as compact JSON; null where ``prompt_signals`` gives an error."""
    n, unknown, signals = _signals(category)
    return F.when((n > 0) & (F.size(unknown) == 0), F.to_json(signals))


def review_gate(regions: DataFrame, reviews: DataFrame, region: str, strict: bool) -> DataFrame:
    """What holds a candidate back, as a report: regions rejected or to be run again, states that are none, and, if strict,
    regions without a review or not approved. Regions and reviews have unique names; a null state is blank."""
    state = F.trim(F.coalesce(F.col("review_status"), F.lit("")))
    said = reviews.select(F.col(region).alias("_region"), state.alias("_state"))
    met = regions.select(region).join(said, F.col(region) == F.col("_region"), "left")
    what = [
        F.when(F.col("_state").isin(*BLOCKING), "rejected or to be run again"),
        F.when(F.lit(strict) & F.col("_region").isNull(), "no review"),
        F.when(F.lit(strict) & ~F.coalesce(F.col("_state") == "approved", F.lit(False)), "not approved"),
    ]
    held = met.select(F.explode(F.array_compact(F.array(*what))).alias("check"), F.col(region).alias("r"))
    odd = said.where(~F.col("_state").isin(*REVIEWS)).select(F.lit("unknown state").alias("check"), F.col("_region").alias("r"))
    return held.unionByName(odd).groupBy("check").agg(F.count("*").alias("n"), F.min(F.col("r").cast("string")).alias("first"))


def legacy_comparison(candidate: DataFrame, legacy: DataFrame, key: str, obsolete: list[str]) -> DataFrame:
    """One row: how many rows and keys an earlier table shares with a candidate, and which of its columns are obsolete."""
    shared = candidate.select(key).distinct().join(legacy.select(key).distinct(), key, "left_semi").agg(F.count("*").alias("shared_keys"))
    sizes = candidate.agg(F.count("*").alias("candidate_rows")).crossJoin(legacy.agg(F.count("*").alias("legacy_rows")))  # one row each
    found = F.array(*[F.lit(c) for c in legacy.columns if c in obsolete]).cast("array<string>")
    return sizes.crossJoin(shared).withColumn("obsolete_columns", found)
