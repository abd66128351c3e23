"""Department statistics from long tables of observations, and their assembly into one row a department."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sommelix.functions.text import normalized_name
from sommelix.operators.cubes import pivoted
from sommelix.operators.joins import checked_join
from sommelix.operators.lineage import saved
from sommelix.operators.quality import Checks, QualityError, require_columns, require_unique


@dataclass(frozen=True)
class Slice:
    """The observations of one measure: wanted values by column, and where the pivoted codes go. ``balance`` names codes of which
    the first two sum to the third, within a tolerance."""

    wanted: dict[str, tuple[str, ...]]
    outputs: dict[str, str]
    by: str | None = None
    balance: tuple[str, str, str] | None = None
    tolerance: float = 0.0
    keep: tuple[str, ...] = field(default=())


# Codes of the statistical office's tables.
WAGES = Slice(
    {"GEO_OBJECT": ("DEP",), "FREQ": ("A",), "SEX": ("_T",), "AGE": ("_T",), "DERA_MEASURE": ("SALAIRE_NET_EQTP_MENSUEL_MOYENNE",)},
    {"SALAIRE_NET_EQTP_MENSUEL_MOYENNE": "average_net_monthly_wage_fte_eur"},
    keep=("CONF_STATUS",),
)
LIVING_STANDARD = Slice({"GEO_OBJECT": ("DEP",), "FILOSOFI_MEASURE": ("MED_SL",)}, {"MED_SL": "median_living_standard_eur"})
POVERTY = Slice({"GEO_OBJECT": ("DEP",), "FILOSOFI_MEASURE": ("PR_MD60",)}, {"PR_MD60": "poverty_rate_percent"})
EMPLOYMENT = Slice(
    {"GEO_OBJECT": ("DEP",), "FREQ": ("A",), "PCS": ("_T",), "AGE": ("Y15T64",), "EMPSTA_ENQ": ("1", "2", "1T2")},
    {"1": "employed_population_15_64", "2": "unemployed_population_15_64", "1T2": "active_population_15_64"},
    by="EMPSTA_ENQ",
    balance=("1", "2", "1T2"),
    tolerance=0.01,
)
POPULATION = Slice(
    {"GEO_OBJECT": ("DEP",), "FREQ": ("A",), "POPREF_MEASURE": ("PMUN", "PCAP", "PTOT")},
    {"PMUN": "municipal_population", "PCAP": "population_counted_separately", "PTOT": "total_population"},
    by="POPREF_MEASURE",
    balance=("PMUN", "PCAP", "PTOT"),
)
GDP = {
    "COUNTRY": "FRA", "TERRITORIAL_LEVEL": "TL3", "MEASURE": "GDP", "ACTIVITY": "_T", "PRICES": "V", "UNIT_MEASURE": "XDC", "UNIT_MULT": "6",
    "CURRENCY": "EUR",
}


def code_order(code: Column) -> Column:
    """Department codes by number; 2A and 2B between 20 and 21. Other texts fail."""
    return F.when(code == "2A", 20.1).when(code == "2B", 20.2).otherwise(code.cast("int").cast("double"))


def in_year(year: int) -> Column:
    """A period that is no number fails."""
    return F.col("TIME_PERIOD").cast("double") == year


def observations(raw: DataFrame, spec: Slice, year: int, label: str) -> DataFrame:
    require_columns(raw, ["GEO", "TIME_PERIOD", "OBS_VALUE", *spec.wanted, *spec.keep], label)
    conditions = [F.col(c).isin(*values) for c, values in spec.wanted.items()]
    return raw.where(reduce(Column.__and__, conditions)).where(in_year(year)).withColumn("OBS_VALUE", F.col("OBS_VALUE").cast("double"))


def complete(frame: DataFrame, departments: DataFrame, label: str) -> DataFrame:
    """Rows of the given departments, of which each must have exactly one; other rows go."""
    known = departments.select("department_code")
    found = frame.join(known, "department_code", "left_semi")
    counted = known.join(found.groupBy("department_code").agg(F.count("*").alias("n")), "department_code", "left")
    code = lambda condition: F.min(F.when(condition, F.col("department_code")))
    lost = counted.agg(
        F.count_if(F.col("n").isNull()).alias("n_missing"), code(F.col("n").isNull()).alias("missing"), F.count_if(F.col("n") > 1).alias("n_more"), code(F.col("n") > 1).alias("more")
    ).first()
    if lost.n_missing:
        raise QualityError(f"departments without {label}: {lost.n_missing}, first {lost.missing}")
    if lost.n_more:
        raise QualityError(f"{label} is not unique by department_code: {lost.n_more}, first {lost.more}")
    return found


def measured(raw: DataFrame, spec: Slice, year: int, departments: DataFrame, label: str) -> DataFrame:
    """department_code and the slice's columns, one row for each given department."""
    found = observations(raw, spec, year, label).withColumnRenamed("GEO", "department_code")
    if spec.by is None:
        (name,) = spec.outputs.values()
        return complete(found.select("department_code", F.col("OBS_VALUE").alias(name), *spec.keep), departments, label)
    require_unique(found, ["department_code", spec.by], label)
    known = found.join(departments.select("department_code"), "department_code", "left_semi")
    wide = pivoted(known, "department_code", spec.by, "OBS_VALUE", list(spec.outputs)).withColumnsRenamed(spec.outputs)
    whole = complete(wide, departments, label)
    a, b, total = (F.col(spec.outputs[c]) for c in spec.balance)
    checks = Checks(whole).none(f"{label} does not reconcile", F.coalesce(F.abs(a + b - total) > spec.tolerance, F.lit(True)))
    return checks.require()


def employment(raw: DataFrame, year: int, departments: DataFrame) -> DataFrame:
    found = measured(raw, EMPLOYMENT, year, departments, "employment")
    active = F.col("active_population_15_64")
    Checks(found).none("nobody active", active <= 0).require()
    return found.withColumn("census_unemployment_rate_15_64_percent", F.col("unemployed_population_15_64") / active * 100)


def gross_product(raw: DataFrame, year: int, departments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Product by department, found by normalized name, and the areas that have no department (overseas ones, as a rule)."""
    require_columns(raw, [*GDP, "REF_AREA", "Reference area", "TIME_PERIOD", "OBS_VALUE", "OBS_STATUS", "Observation status"], "product")
    rows = raw.where(reduce(Column.__and__, [F.col(c) == v for c, v in GDP.items()])).where(F.col("TIME_PERIOD") == str(year))
    found = require_unique(rows, ["REF_AREA", "TIME_PERIOD"], "product").select(
        F.col("REF_AREA").alias("oecd_tl3_code"), F.col("Reference area").alias("oecd_reference_area_name"),
        F.col("OBS_VALUE").cast("double").alias("gdp_current_prices_million_eur"), F.col("OBS_STATUS").alias("gdp_observation_status"),
        F.col("Observation status").alias("gdp_observation_status_label"), normalized_name(F.col("Reference area")).alias("_key"),
    )
    names = departments.select("department_code", "department_name", normalized_name(F.col("department_name")).alias("_key"))
    joined = checked_join(found, names, [("_key", "_key")]).drop("_key")
    apart = joined.where("department_code IS NULL").select("oecd_tl3_code", "oecd_reference_area_name").distinct()
    return complete(joined.where("department_code IS NOT NULL"), departments, "product"), apart


def assembled(year: int, departments: DataFrame, slices: list[DataFrame]) -> DataFrame:
    """Departments with the columns of all slices, each unique by department, and people by square kilometre. Slices are made
    once, and are told to be unique together, in one aggregation."""
    slices = [saved(s.drop("department_name", "CONF_STATUS")) for s in slices]
    named = [s.select(F.lit(i).alias("slice"), "department_code") for i, s in enumerate([departments, *slices])]
    require_unique(reduce(DataFrame.unionByName, named), ["slice", "department_code"], "departments and slices")
    whole = reduce(lambda a, b: a.join(b, "department_code", "left"), slices, departments)
    density = F.col("municipal_population") / F.col("area_sq_km")
    return whole.withColumns({"reference_year": F.lit(year), "population_density_per_sq_km": density})
