"""Cleaning a yearly guide snapshot and splitting it into disjoint partitions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sommelix.operators.joins import mapped
from sommelix.operators.quality import Checks, QualityError, any_null, require_columns

# Award labels and their ordinals, by guide edition.
AWARDS_TO_2023 = {"3 MICHELIN Stars": 3.0, "2 MICHELIN Stars": 2.0, "1 MICHELIN Star": 1.0, "Bib Gourmand": 0.5}
AWARDS_2024 = {"3 Stars": 3.0, "2 Stars": 2.0, "1 Star": 1.0, "Bib Gourmand": 0.5}
AWARDS_FROM_2025 = AWARDS_2024 | {"Selected Restaurants": 0.25}
# Locations that name a city without its country.
CITY_STATES = {
    "Hong Kong": "Hong Kong, Hong Kong SAR China",
    "Macau": "Macau, Macau SAR China",
    "Singapore": "Singapore, Singapore",
    "Dubai": "Dubai, United Arab Emirates",
    "Luxembourg": "Luxembourg, Luxembourg",
    "Abu Dhabi": "Abu Dhabi, United Arab Emirates",
}


@dataclass(frozen=True)
class Edition:
    """What is particular to a year's snapshot."""

    year: int
    awards: dict[str, float]
    price: tuple[str, ...] = ("Price",)
    green: bool = False
    monaco: str = "France"
    without_coordinates: tuple[tuple[str, int], ...] = ()

    @property
    def source(self) -> list[str]:
        green = ["GreenStar"] if self.green else []
        return ["Name", "Address", "Location", *self.price, "Cuisine", "WebsiteUrl", "Award", *green, "Longitude", "Latitude"]

    @property
    def output(self) -> list[str]:
        green = ["greenstar"] if self.green else []
        return ["name", "address", "city", "country", "price", "cuisine", "url", "award", *green, "stars", "longitude", "latitude"]


def edition(year: int) -> Edition:
    if year < 2022:
        raise QualityError(f"no edition of {year} is known")
    if year == 2022:
        return Edition(year, AWARDS_TO_2023, price=("MaxPrice", "Currency"))
    if year == 2023:
        return Edition(year, AWARDS_TO_2023)
    if year == 2024:
        return Edition(year, AWARDS_2024, without_coordinates=(("france", 52), ("uk", 12)))
    return Edition(year, AWARDS_FROM_2025, green=True, monaco="Principality of Monaco" if year >= 2026 else "France")


def parse_location(location: Column) -> tuple[Column, Column]:
    """City and country: the first and the last of at most three parts, split from the right, each trimmed."""
    whole = F.coalesce(mapped(location, CITY_STATES), location)
    strip = lambda c: F.regexp_replace(c, r"^[\s ]+|[\s ]+$", "")
    parts = F.split(strip(whole), ",")
    n = F.size(parts)
    city = F.when(n <= 2, F.get(parts, F.lit(0))).otherwise(F.array_join(F.slice(parts, F.lit(1), F.greatest(F.lit(1), n - 2)), ","))
    return strip(city), F.when(n >= 2, strip(F.element_at(parts, -1)))


def clean(raw: DataFrame, year: int) -> DataFrame:
    """Lower-cased, renamed and parsed columns in the edition's order, ``source_row`` kept if there."""
    spec = edition(year)
    require_columns(raw, spec.source, f"snapshot {year}")
    city, country = parse_location(F.col("location"))
    low = raw.toDF(*[c.lower() for c in raw.columns])
    renamed = low.withColumnsRenamed({"websiteurl": "url", "maxprice": "price"})
    made = renamed.withColumns({"city": city, "country": country, "stars": mapped(F.col("award"), spec.awards)})
    rows = ["source_row"] if "source_row" in low.columns else []
    return made.select(*rows, *spec.output)


def partition_key(spec: Edition) -> Column:
    """Where Monaco is a country of its own, all of its rows are monaco; where it is listed under France, its city's are. The
    city of Monaco is never france, so a row of it that fits neither has no partition; nor have other countries."""
    is_ = lambda c, v: F.coalesce(F.col(c) == v, F.lit(False))
    city, france = is_("city", "Monaco"), is_("country", "France")
    monaco = (city & france) if spec.monaco == "France" else is_("country", spec.monaco)
    return F.when(monaco, "monaco").when(france & ~city, "france").when(is_("country", "United Kingdom"), "uk")


def partitioned(cleaned: DataFrame, year: int) -> DataFrame:
    return cleaned.withColumn("partition", partition_key(edition(year)))


def partitions(cleaned: DataFrame, year: int) -> dict[str, DataFrame]:
    keyed = partitioned(cleaned, year)
    return {p: keyed.where(F.col("partition") == p).drop("partition") for p in ("france", "monaco", "uk")}


def snapshot_checks(cleaned: DataFrame, year: int, rows: int | None = None) -> Checks:
    spec = edition(year)
    checks = Checks(partitioned(cleaned, year))
    if rows is not None:
        checks.rows("row count", rows)
    checks.none("blank city or country", any_null(["city", "country"]) | (F.col("city") == "") | (F.col("country") == ""))
    checks.none("unknown award", F.col("stars").isNull())
    lon, lat = (F.expr(f"try_cast({c} AS double)") for c in ("longitude", "latitude"))
    checks.none("coordinate that is no number", (lon.isNull() & F.col("longitude").isNotNull()) | (lat.isNull() & F.col("latitude").isNotNull()))
    checks.none("half a coordinate pair", lon.isNull() != lat.isNull())
    checks.none("coordinate out of range", ~lon.between(-180, 180) | ~lat.between(-90, 90))
    allowed = dict(spec.without_coordinates)
    for p in ("france", "monaco", "uk"):
        checks.exactly(f"missing coordinates in {p}", (F.col("partition") == p) & lon.isNull(), allowed.get(p, 0))
    return checks
