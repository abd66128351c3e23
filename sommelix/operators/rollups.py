"""Enrichment with reference tables and rollups at several grains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sommelix.functions.text import department_code, paris_arrondissement, without_nbsp
from sommelix.operators.joins import checked_join, mapped, zero_filled
from sommelix.operators.quality import Checks, QualityError, require_columns

# Award classes (ordinal, label in locations, column), and regions named in English in the reference table.
CLASSES = ((0.25, "Selected", "selected"), (0.5, "Bib", "bib_gourmand"), (1.0, "1", "1_star"), (2.0, "2", "2_star"), (3.0, "3", "3_star"))
REGIONS = {"Brittany": "Bretagne", "Corsica": "Corse", "Normandy": "Normandie"}
#: Metrics averaged by population.
WEIGHTED = (
    "poverty_rate_percent",
    "census_unemployment_rate_15_64_percent",
    "average_net_monthly_wage_fte_eur",
    "median_living_standard_eur",
)


def conditional_counts(frame: DataFrame, keys: list[str], column: str, classes: dict, more: dict[str, Column] | None = None) -> DataFrame:
    """One row for each key (null keys left out) with a count for each class; ``more`` adds further conditions."""
    known = frame.dropna(subset=keys)
    counts = [F.count_if(F.col(column) == v).alias(c) for v, c in classes.items()]
    counts += [F.count_if(cond).alias(c) for c, cond in (more or {}).items()]
    return known.groupBy(*keys).agg(*counts)


def star_counts(restaurants: DataFrame, keys: list[str]) -> DataFrame:
    more = {"green_stars": F.col("greenstar") == 1} if "greenstar" in restaurants.columns else {}
    counts = conditional_counts(restaurants, keys, "stars", {v: c for v, _, c in CLASSES}, more)
    one, two, three = (F.col(f"{n}_star") for n in (1, 2, 3))
    return counts.withColumns({"total_stars": one + 2 * two + 3 * three, "starred_restaurants": one + two + three})


def weighted_means(frame: DataFrame, keys: list[str], weight: str, columns: list[str]) -> DataFrame:
    w = F.col(weight)
    return frame.groupBy(*keys).agg(*[(F.sum(F.col(c) * w) / F.sum(w)).alias(c) for c in columns])


def ordered_lists(frame: DataFrame, keys: list[str], order: str, fields: list[str], name: str) -> DataFrame:
    """The fields of each key's rows in source order, as an array of structs."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("_order"), *fields)))
    return frame.groupBy(*keys).agg(F.transform(rows, lambda r: F.struct(*[r[f].alias(f) for f in fields])).alias(name))


def locations_text(frame: DataFrame, keys: list[str]) -> DataFrame:
    """Coordinates by award class in the text form of a mapping from label to a list of (latitude, longitude) pairs, or None."""
    lists = frame.where("stars IS NOT NULL").groupBy(*keys)
    rows = [
        F.filter(F.array_sort(F.collect_list(F.struct("source_row", "stars", "latitude", "longitude"))), lambda r, v=v: r["stars"] == v).alias(label)
        for v, label, _ in CLASSES
    ]

    def pairs(label: str) -> Column:
        one = F.transform(F.col(label), lambda r: F.concat(F.lit("("), r["latitude"].cast("string"), F.lit(", "), r["longitude"].cast("string"), F.lit(")")))
        return F.concat(F.lit(f"'{label}': "), F.when(F.size(label) == 0, "None").otherwise(F.concat(F.lit("["), F.array_join(one, ", "), F.lit("]"))))

    return lists.agg(*rows).select(*keys, F.concat(F.lit("{"), F.concat_ws(", ", *[pairs(label) for _, label, _ in CLASSES]), F.lit("}")).alias("locations"))


def parse_address(address: Column) -> dict[str, Column]:
    """Postcode, town and short location of 'street, town, 75001, France'; problem says what is wrong, null if nothing."""
    text = without_nbsp(address)
    parts = F.transform(F.split(text, ","), lambda p: F.trim(p))
    n = F.size(parts)
    codes = F.regexp_count(text, F.lit(r"\b\d{5}\b"))
    code = F.when(n >= 2, F.element_at(parts, F.when(n >= 2, -2).otherwise(-1)))
    town = F.when(n >= 4, F.element_at(parts, F.when(n >= 4, -3).otherwise(-1)))
    problem = (
        F.when(codes != 1, "not exactly one postcode")
        .when(n < 4, "fewer than four parts")
        .when(F.element_at(parts, -1) != "France", "not in France")
        .when(~code.rlike(r"^\d{5}$"), "postcode not before the country")
    )
    return {"postcode": code, "town": town, "location": F.concat_ws(", ", town, code), "problem": problem}


def enrich_restaurants(partition: DataFrame, departments: DataFrame) -> DataFrame:
    """Restaurants with short location, department, capital and region; fails on an address or department it cannot place."""
    require_columns(departments, ["department_num", "department", "capital", "region"], "department reference")
    texts = {c: without_nbsp(F.col(c)) for c, t in partition.dtypes if t == "string"}
    made = partition.withColumns(texts)
    made = made.withColumns({f"_{k}": v for k, v in parse_address(F.col("address")).items()})
    bad = made.where("_problem IS NOT NULL OR address IS NULL").limit(5).collect()
    if bad:
        raise QualityError(f"addresses that cannot be read: {[(r['address'], r['_problem']) for r in bad]}")
    placed = made.withColumn("department_num", department_code(F.col("_postcode"))).withColumn("location", F.col("_location"))
    joined = checked_join(placed, departments, [("department_num", "department_num")], matched="region")
    kept = [c for c in partition.columns if c not in ("name", "address", "city", "country", "source_row")]
    rows = ["source_row"] if "source_row" in partition.columns else []
    return joined.select(*rows, "name", "address", "location", "department_num", "department", "capital", "region", *kept)


def department_rollup(restaurants: DataFrame, statistics: DataFrame) -> DataFrame:
    """Statistics of every department with counts, 0 where there is no restaurant."""
    counts = star_counts(restaurants, ["department_num"])
    names = [c for c in counts.columns if c != "department_num"]
    joined = zero_filled(statistics, counts, [("department_code", "department_num")], names)
    places = locations_text(restaurants, ["department_num"])
    return checked_join(joined, places, [("department_code", "department_num")])


def region_rollup(restaurants: DataFrame, statistics: DataFrame) -> DataFrame:
    """Counts of every region with restaurants, and its statistics: sums, population-weighted means and ratios of sums."""
    named = lambda f: f.withColumn("region", F.coalesce(mapped(F.col("region"), REGIONS), F.col("region")))
    counts = star_counts(named(restaurants), ["region"])
    stats = named(statistics)
    sums = stats.groupBy("region").agg(
        F.sum("municipal_population").alias("municipal_population"),
        F.sum("gdp_current_prices_million_eur").alias("gdp_current_prices_million_eur"),
        F.sum("area_sq_km").alias("area_sq_km"),
        *[(F.sum(F.col(c) * F.col("municipal_population")) / F.sum("municipal_population")).alias(c) for c in WEIGHTED],
    )
    gdp, people, area = F.col("gdp_current_prices_million_eur"), F.col("municipal_population"), F.col("area_sq_km")
    sums = sums.withColumns({"gdp_per_capita_eur": gdp * 1e6 / people, "population_density_per_sq_km": F.bround(people / area, 2)})
    joined = checked_join(counts, sums, [("region", "region")], matched="municipal_population")
    return checked_join(joined, locations_text(named(restaurants), ["region"]), [("region", "region")])


def parse_monaco_address(address: Column) -> dict[str, Column]:
    text = without_nbsp(address)
    parts = F.transform(F.split(text, ","), lambda p: F.trim(p))
    n = F.size(parts)
    code = F.when(n >= 4, F.get(parts, n - 2))
    town = F.when(n >= 4, F.get(parts, n - 3))
    problem = (
        F.when(F.regexp_count(text, F.lit(r"\b\d{5}\b")) != 1, "not exactly one postcode")
        .when(n < 4, "fewer than four parts")
        .when(~F.element_at(parts, -1).isin("Principality of Monaco", "France"), "not in Monaco")
        .when(town != "Monaco", "town is not Monaco")
        .when(~code.rlike(r"^98\d{3}$"), "no postcode of Monaco")
    )
    return {"location": F.concat_ws(", ", town, code), "problem": problem}


def prepare_monaco(partition: DataFrame) -> DataFrame:
    made = partition.withColumns({c: without_nbsp(F.col(c)) for c, t in partition.dtypes if t == "string"})
    made = made.withColumns({f"_{k}": v for k, v in parse_monaco_address(F.col("address")).items()})
    Checks(made).none("address", F.col("_problem").isNotNull() | F.col("address").isNull()).require()
    fixed = {"location": F.col("_location"), "department_num": F.lit("98"), "department": F.lit("Monaco"), "capital": F.lit("Monaco"), "region": F.lit("Monaco")}
    return made.withColumns(fixed).drop("_location", "_problem", "city", "country")


def monaco_rollup(restaurants: DataFrame) -> DataFrame:
    counts = star_counts(restaurants, ["department"])
    Checks(counts).rows("one department", 1).require()
    return checked_join(counts, locations_text(restaurants, ["department"]), [("department", "department")])


def paris_labels(restaurants: DataFrame, arrondissements: DataFrame) -> DataFrame:
    """``arrondissement`` becomes 'ordinal (name)' for Paris and stays as it is elsewhere."""
    number = paris_arrondissement(F.col("location"))
    label = F.format_string("%s (%s)", "ordinal", "_name")
    names = arrondissements.select("arrondissement_number", label.alias("_label")) if "_name" in arrondissements.columns else arrondissements.select(
        "arrondissement_number", F.format_string("%s (%s)", "ordinal", "name").alias("_label")
    )
    joined = checked_join(restaurants.withColumn("_n", number), names, [("_n", "arrondissement_number")])
    current = F.col("arrondissement") if "arrondissement" in restaurants.columns else F.lit(None).cast("string")
    return joined.withColumn("arrondissement", F.coalesce("_label", current)).drop("_n", "_label")
