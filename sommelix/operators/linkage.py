"""Record linkage between two yearly tables: an ordered waterfall of exact keys, reviewable fuzzy candidates, and labels
of what changed."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sommelix.functions import text
from sommelix.functions.geo import haversine_km
from sommelix.operators.joins import first_by, unique_match
from sommelix.operators.lineage import saved
from sommelix.operators.quality import QualityError

# The tiers in order (method, keys), distances and the least score of a candidate.
TIERS = (
    ("exact_url_postal", ("normalized_url", "postal_code")),
    ("exact_url", ("normalized_url",)),
    ("exact_name_postal", ("normalized_name", "postal_code")),
    ("exact_address_postal", ("normalized_address", "postal_code")),
    ("exact_address", ("normalized_address",)),
    ("exact_name_coordinates", ("normalized_name", "latitude", "longitude")),
)
NEAR_NAME_KM = 5.0
FUZZY_KM = 2.0
FUZZY_SCORE = 0.72
FUZZY_PER_ROW = 3
#: Rows of one postcode or address meet by their names if there are more pairs of them; then so many names of either year meet at once.
DIRECT = 1024
NAMES_PREVIOUS, NAMES_CURRENT = 65536, 256
MATERIAL = ("promoted", "demoted", "newly_starred", "green_star_gained", "green_star_lost")


def prepare(frame: DataFrame) -> DataFrame:
    """Adds the four keys; the postcode comes from the location if there is one, else from the address. Rows are dealt before
    their texts are made plain, however few files they come from."""
    frame = frame.repartition("source_row")
    place = F.col("location") if "location" in frame.columns else F.col("address")
    url = text.normalized_url(F.col("url")) if "url" in frame.columns else F.lit("")
    return frame.withColumns(
        {
            "normalized_name": text.normalized_text(F.col("name")),
            "normalized_address": text.normalized_text(F.col("address")),
            "normalized_url": url,
            "postal_code": text.postal_code(place),
        }
    )


@dataclass
class Linkage:
    matches: DataFrame
    previous_left: DataFrame
    current_left: DataFrame
    conflicts: DataFrame
    candidates: DataFrame


def _without(frame: DataFrame, matches: DataFrame, side: str) -> DataFrame:
    return frame.join(matches.select(F.col(side).alias("source_row")), "source_row", "left_anti")


def _sided(frame: DataFrame, prefix: str, columns: list[str]) -> DataFrame:
    return frame.select(*[F.col(c).alias(f"{prefix}_{c}") for c in columns])


def duplicate_conflicts(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Over all keys: keys on both sides that are not unique on one of them, with the number of rows involved."""
    keys = [*[k for _, k in TIERS], ("normalized_name",)]

    def counted(frame: DataFrame, columns, name: str) -> DataFrame:
        good = reduce(Column.__and__, [F.col(c).isNotNull() & (F.col(c).cast("string") != "") for c in columns])
        return frame.where(good).groupBy(*columns).agg(F.count("*").alias(name))

    found = [
        counted(previous, list(k), "a").join(counted(current, list(k), "b"), list(k)).where("a <> 1 OR b <> 1")
        .select(F.lit("+".join(k)).alias("key"), (F.col("a") + F.col("b")).alias("rows"))
        for k in keys
    ]
    return reduce(DataFrame.unionByName, found)


def _searched(previous: pd.DataFrame, current: pd.DataFrame, per_row: int) -> pd.DataFrame:
    """(block, name, p_name, n, score): for each current name the previous ones that its rows may need."""
    names = text.Names(previous["p_name"].tolist())
    found = [(name, *hit) for name in current["name"] for hit in names.nearest(name, FUZZY_SCORE, previous["n"].to_numpy(), per_row)]
    made = pd.DataFrame(found, columns=["name", "place", "score"])
    at = previous.iloc[made["place"].astype(int)]
    return made.assign(block=previous["block"].iloc[0] if len(previous) else "", p_name=at["p_name"].to_numpy(), n=at["n"].to_numpy())[["block", "name", "p_name", "n", "score"]]


def _same_block(previous: DataFrame, current: DataFrame, per_row: int) -> DataFrame:
    """(p_source_row, c_source_row) of rows with one postcode or address: all pairs of small blocks. In others names are compared,
    each once, and a row meets those with the most similar names: ``per_row`` rows and all that tie with the last of them."""
    c = F.col

    def blocks(frame: DataFrame, s: str) -> DataFrame:
        keys = [F.when(c(f"{s}_{k}") != "", F.concat(F.lit(f"{k}:"), c(f"{s}_{k}"))) for k in ("postal_code", "normalized_address")]
        return frame.select(f"{s}_source_row", c(f"{s}_normalized_name").alias(f"{s}_name"), F.explode(F.array_compact(F.array(*keys))).alias("block"))

    a, b = blocks(previous, "p"), blocks(current, "c")
    size = lambda f, s: f.groupBy("block").agg(F.count("*").alias(f"{s}_rows"), F.count_distinct(f"{s}_name").alias(f"{s}_names"))
    sizes = saved(size(a, "p").join(size(b, "c"), "block"))
    few, many = (sizes.where(f"p_rows * c_rows {o} {DIRECT}") for o in ("<=", ">"))
    ids = ["p_source_row", "c_source_row"]
    direct = a.join(few.select("block"), "block").join(b, "block").select(*ids)
    parts, pieces = F.ceil(c("p_names") / NAMES_PREVIOUS), F.ceil(c("c_names") / NAMES_CURRENT)
    dealt = lambda name, n: F.pmod(F.xxhash64(name), n)
    names_a = a.join(many, "block").groupBy("block", "p_name", "p_names", "c_names").agg(F.count("*").alias("n"))
    names_a = names_a.select("block", "p_name", "n", dealt("p_name", parts).alias("part"), F.explode(F.sequence(F.lit(0), pieces - 1)).alias("piece"))
    names_b = b.join(many, "block").select("block", c("c_name").alias("name"), "p_names", "c_names").distinct()
    names_b = names_b.select("block", "name", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), dealt("name", pieces).alias("piece"))
    meet = ["block", "part", "piece"]
    found = names_a.groupBy(*meet).cogroup(names_b.groupBy(*meet)).applyInPandas(
        lambda p, q: _searched(p, q, per_row), "block string, name string, p_name string, n long, score double"
    )
    of_name = Window.partitionBy("block", "name")
    upto = F.sum("n").over(of_name.orderBy(F.desc("score")).rangeBetween(Window.unboundedPreceding, Window.currentRow))
    before = upto - F.sum("n").over(Window.partitionBy("block", "name", "score"))
    found = saved(found.withColumn("before", before).where(f"before < {per_row}").select("block", c("name").alias("c_name"), "p_name"))
    return direct.union(found.join(a, ["block", "p_name"]).join(b, ["block", "c_name"]).select(*ids))


def fuzzy_candidates(previous: DataFrame, current: DataFrame, per_row: int = FUZZY_PER_ROW) -> DataFrame:
    """At most three candidates for each current row, by name similarity, among rows with the same postcode or address or
    within 2 km. Rows meet by postcode or address, see ``_same_block``, and by cells of a latitude-longitude grid."""
    columns = ["source_row", "normalized_name", "normalized_address", "postal_code", "latitude", "longitude"]
    a, b = _sided(previous, "p", columns), _sided(current, "c", columns)
    # a degree of latitude is 111.2 km; longitude cells widen with latitude, so neighbours are taken by latitude band
    lat_cell = lambda s: F.floor(F.col(f"{s}_latitude") * 50)
    width = lambda band: F.greatest(F.cos(F.radians((F.abs(band) + 1) / 50)), F.lit(0.01)) * 50
    near_a = a.withColumn("band", lat_cell("p")).withColumn("cell", F.floor(F.col("p_longitude") * width(F.col("band"))))
    near_b = (
        b.withColumn("band", F.explode(F.sequence(lat_cell("c") - 1, lat_cell("c") + 1)))
        .withColumn("mid", F.floor(F.col("c_longitude") * width(F.col("band"))))
        .withColumn("cell", F.explode(F.sequence(F.col("mid") - 2, F.col("mid") + 2)))
    )
    ids = ["p_source_row", "c_source_row"]
    near = near_a.join(near_b.drop("mid"), ["band", "cell"]).select(*ids)
    pairs = saved(near.union(_same_block(a, b, per_row)).distinct())
    full = pairs.join(a, "p_source_row").join(b, "c_source_row")
    distance = haversine_km(F.col("p_latitude"), F.col("p_longitude"), F.col("c_latitude"), F.col("c_longitude"))
    same = lambda c: F.coalesce((F.col(f"p_{c}") == F.col(f"c_{c}")) & (F.col(f"p_{c}") != ""), F.lit(False))
    scored = full.withColumns({"distance": distance, "same_postal": same("postal_code"), "same_address": same("normalized_address")})
    scored = scored.where(F.col("same_postal") | F.col("same_address") | (F.col("distance") <= FUZZY_KM))
    scored = scored.withColumn("confidence", text.sequence_similarity("p_normalized_name", "c_normalized_name")).where(F.col("confidence") >= FUZZY_SCORE)
    yes = lambda c: F.initcap(F.col(c).cast("string"))
    evidence = F.concat(
        F.format_string("name_similarity=%.3f;", "confidence"),
        F.coalesce(F.format_string("distance_km=%.3f;", "distance"), F.lit("distance_km=nan;")),
        F.lit("same_postal="), yes("same_postal"), F.lit(";same_address="), yes("same_address"),
    )
    order = [F.desc("confidence"), F.asc_nulls_last("distance"), F.desc("p_source_row"), F.desc("evidence")]
    return first_by(scored.withColumn("evidence", evidence), ["c_source_row"], order, per_row).select(
        F.col("p_source_row").alias("previous_row"), F.col("c_source_row").alias("current_row"), "confidence", "evidence"
    )


def link(previous: DataFrame, current: DataFrame, overrides: DataFrame | None = None) -> Linkage:
    """The waterfall over prepared frames. ``overrides`` (previous_row, current_row, evidence) come first. Tiers carry rows'
    numbers, keys and places only; what a tier finds is written, so the next one's plan is its own."""
    if overrides is not None:
        for side in ("previous_row", "current_row"):
            if not overrides.groupBy(side).count().where("count > 1").isEmpty():
                raise QualityError(f"an override uses a {side} twice")
    previous, current = saved(previous), saved(current)
    needed = ["source_row", *dict.fromkeys([k for _, keys in TIERS for k in keys] + ["normalized_name", "latitude", "longitude"])]
    a, b = previous.select(needed), current.select(needed)
    found = []

    def take(tier: DataFrame) -> None:
        nonlocal a, b
        tier = saved(tier)
        found.append(tier)
        a, b = _without(a, tier, "previous_row"), _without(b, tier, "current_row")

    if overrides is not None:
        take(overrides.select("previous_row", "current_row", F.lit("override").alias("method"), F.lit(1.0).alias("confidence"), "evidence"))
    for method, keys in TIERS:
        named = {"method": F.lit(method), "confidence": F.lit(1.0), "evidence": F.lit("+".join(keys))}
        take(unique_match(a, b, list(keys)).withColumns(named))
    near = unique_match(a, b, ["normalized_name"])
    sides = ["source_row", "latitude", "longitude"]
    near = near.join(_sided(a, "previous", sides).withColumnRenamed("previous_source_row", "previous_row"), "previous_row").join(
        _sided(b, "current", sides).withColumnRenamed("current_source_row", "current_row"), "current_row"
    )
    km = haversine_km(F.col("previous_latitude"), F.col("previous_longitude"), F.col("current_latitude"), F.col("current_longitude"))
    near = near.withColumn("km", km).where(F.col("km") <= NEAR_NAME_KM).select(
        "previous_row", "current_row", F.lit("exact_name_nearby").alias("method"), F.lit(1.0).alias("confidence"),
        F.format_string("unique normalized name;distance_km=%.3f", "km").alias("evidence"),
    )
    take(near)
    matches = reduce(DataFrame.unionByName, found)
    a, b = saved(_without(previous, matches, "previous_row")), saved(_without(current, matches, "current_row"))
    return Linkage(matches, a, b, duplicate_conflicts(a, b), fuzzy_candidates(a, b))


def classification(stars: Column) -> Column:
    return F.when(stars >= 1, "starred").when(stars == 0.5, "bib_gourmand").when(stars == 0.25, "selected").otherwise("other")


def change_labels(p: str = "previous_", c: str = "current_", green: bool = True) -> Column:
    """Array of labels of a matched pair, in fixed order; ['unchanged'] if none."""
    old, new = F.col(f"{p}stars"), F.col(f"{c}stars")
    differs = lambda n: ~F.col(f"{p}{n}").eqNullSafe(F.col(f"{c}{n}"))
    started = (old < 1) & (new >= 1)
    labels = [
        F.when(started, "newly_starred"),
        F.when(started | ((old >= 1) & (new >= 1) & (new > old)), "promoted"),
        F.when((old >= 1) & (new < old), "demoted"),
        F.when(classification(old) != classification(new), "classification_changed"),
        F.when(differs("normalized_name"), "renamed"),
        F.when(differs("normalized_address") | differs("postal_code"), "relocated"),
    ]
    if green:
        was, is_ = F.col(f"{p}greenstar"), F.col(f"{c}greenstar")
        labels += [F.when((was == 0) & (is_ == 1), "green_star_gained"), F.when((was == 1) & (is_ == 0), "green_star_lost")]
    made = F.array_compact(F.array(*labels))
    return F.when(F.size(made) == 0, F.array(F.lit("unchanged"))).otherwise(made)


def is_material(labels: Column, old: Column, new: Column) -> Column:
    old, new = F.coalesce(old, F.lit(0.0)), F.coalesce(new, F.lit(0.0))
    has = lambda x: F.array_contains(labels, x)
    return (
        F.arrays_overlap(labels, F.array(*[F.lit(x) for x in MATERIAL]))
        | (has("new_entry") & (new >= 1))
        | (has("removed_from_guide") & (old >= 1))
        | (has("needs_review") & (F.greatest(old, new) >= 1))
    )


SHOWN = ("name", "address", "location", "award", "stars", "greenstar")


def compare(previous: DataFrame, current: DataFrame, previous_year: int, current_year: int, overrides: DataFrame | None = None) -> DataFrame:
    """One record for each matched pair, removed row, new row and candidate, with labels, materiality and evidence."""
    if current_year != previous_year + 1:
        raise QualityError("only consecutive years are compared")
    green = "greenstar" in previous.columns and "greenstar" in current.columns
    previous, current = saved(prepare(previous)), saved(prepare(current))
    linked = link(previous, current, overrides)

    def side(frame: DataFrame, prefix: str) -> DataFrame:
        missing = {c: F.lit(None).cast("string" if c not in ("stars", "greenstar") else "double") for c in (*SHOWN, "department", "region") if c not in frame.columns}
        return _sided(frame.withColumns(missing), prefix, ["source_row", *SHOWN, "department", "region", "normalized_name", "normalized_address", "postal_code"]).withColumnRenamed(
            f"{prefix}_source_row", f"{prefix}_row"
        )

    p, c = side(previous, "previous"), side(current, "current")
    one = lambda x: F.array(F.lit(x))
    both = linked.matches.join(p, "previous_row").join(c, "current_row").withColumn("labels", change_labels(green=green))
    both = both.withColumn("review_status", F.when(F.col("method") == "override", "reviewed").otherwise("not_required"))
    plain = {"method": F.lit("unmatched"), "confidence": F.lit(0.0), "evidence": F.lit("no deterministic match"), "review_status": F.lit("unmatched")}
    gone = p.join(linked.previous_left.select(F.col("source_row").alias("previous_row")), "previous_row", "left_semi").withColumns(plain | {"labels": one("removed_from_guide")})
    new = c.join(linked.current_left.select(F.col("source_row").alias("current_row")), "current_row", "left_semi").withColumns(plain | {"labels": one("new_entry")})
    maybe = linked.candidates.join(p, "previous_row").join(c, "current_row").withColumns(
        {"labels": one("needs_review"), "method": F.lit("fuzzy_candidate"), "review_status": F.lit("needs_review")}
    )
    records = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), [both, gone, new])
    records = records.withColumn("record_type", F.lit("comparison")).unionByName(maybe.withColumn("record_type", F.lit("match_candidate")), allowMissingColumns=True)
    filled = lambda n: F.coalesce(F.nullif(F.col(f"current_{n}"), F.lit("")), F.col(f"previous_{n}")).alias(n)
    return records.select(
        "record_type", F.lit(previous_year).alias("previous_year"), F.lit(current_year).alias("current_year"),
        "previous_row", "current_row", *[f"{s}_{n}" for n in ("name", "address", "location") for s in ("previous", "current")],
        filled("department"), filled("region"), *[f"{s}_{n}" for n in ("award", "stars", "greenstar") for s in ("previous", "current")],
        F.array_join("labels", "|").alias("change_types"),
        is_material(F.col("labels"), F.col("previous_stars"), F.col("current_stars")).alias("material"),
        F.col("method").alias("matching_method"), F.round("confidence", 4).alias("matching_confidence"),
        "review_status", F.col("evidence").alias("match_evidence"),
    )


def report_order() -> list[Column]:
    return [F.asc("record_type"), F.desc("material"), F.asc("change_types"), F.asc_nulls_last("current_name"), F.asc_nulls_last("previous_name"), F.asc("previous_row"), F.asc("current_row")]


def summary(records: DataFrame) -> DataFrame:
    """Label counts over comparisons, each label of a record counted."""
    return records.where("record_type = 'comparison'").select(F.explode(F.split("change_types", r"\|")).alias("label")).groupBy("label").count()


def check_accounting(records: DataFrame, n_previous: int, n_current: int) -> None:
    one = records.where("record_type = 'comparison'").agg(
        F.count_if(F.expr("previous_row IS NOT NULL AND current_row IS NOT NULL")).alias("matched"),
        F.count_if(F.expr("current_row IS NULL")).alias("removed"),
        F.count_if(F.expr("previous_row IS NULL")).alias("new"),
        F.count_distinct("previous_row").alias("p"),
        F.count_distinct("current_row").alias("c"),
    ).first()
    if (one["matched"] + one["removed"], one["matched"] + one["new"], one["p"], one["c"]) != (n_previous, n_current, n_previous, n_current):
        raise QualityError("the comparison does not account for each yearly row once")
