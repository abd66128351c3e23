"""CSV and GeoJSON as Spark readers and writers. Results are folders of part files; existing ones are never overwritten."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sommelix.operators.quality import Checks, QualityError, require_columns, same_rows

# Texts that stand for a missing value in a CSV file.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN",
    "None", "n/a", "nan", "null",
)
#: Features that one line of a GeoJSON result holds.
LINE_FEATURES = 5_000
GEOMETRY = "struct<type: string, coordinates: string>"


def read_text_csv(spark: SparkSession, path: str, sep: str = ",", line_breaks: bool = False, required: tuple[str, ...] = ()) -> DataFrame:
    """Every column as text, named by the header. Quotes are doubled inside quoted fields. ``line_breaks``: fields may hold
    line breaks, so a file cannot be split among tasks."""
    frame = spark.read.option("header", True).option("sep", sep).option("quote", '"').option("escape", '"').option("multiLine", line_breaks).csv(path)
    require_columns(frame, list(required), path)
    return frame


def read_csv(spark: SparkSession, path: str, schema: str, sep: str = ",", line_breaks: bool = False) -> DataFrame:
    """The schema's columns, found by name; others are not read. MISSING texts give null, in text columns too; a text that is no
    value of its column's type fails the query that reads it."""
    wanted = T.StructType.fromDDL(schema)
    raw = read_text_csv(spark, path, sep, line_breaks, tuple(wanted.names))
    return raw.select(*[_value(F.col(f"`{f.name}`")).cast(f.dataType).alias(f.name) for f in wanted])


def _value(text: Column) -> Column:
    return F.when(~text.isin(*MISSING), text)


def read_overrides(spark: SparkSession, path: str | None, years: tuple[int, int]) -> DataFrame:
    """previous_name, current_name and reason of the overrides between two years; none where there is no file."""
    schema = "previous_year int, current_year int, previous_name string, current_name string, reason string"
    if path is None or not exists(spark, path):
        return spark.createDataFrame([], schema).drop("previous_year", "current_year")
    both = (F.col("previous_year") == years[0]) & (F.col("current_year") == years[1])
    return read_csv(spark, path, schema).where(both).drop("previous_year", "current_year")


def exists(spark: SparkSession, path: str) -> bool:
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(found)


def latest_year(spark: SparkSession, folder: str, partition: str) -> int:
    """The newest year among the files <partition>_<year>.csv of a folder."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    listed = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(root)
    names = [s.getPath().getName() for s in listed]
    years = [int(n[len(partition) + 1 : -4]) for n in names if n.startswith(f"{partition}_") and n.endswith(".csv") and n[len(partition) + 1 : -4].isdigit()]
    if not years:
        raise QualityError(f"no {partition}_<year>.csv in {folder}")
    return max(years)


def write_csv(frame: DataFrame, path: str, decimals: int | None = None) -> None:
    """Header, UTF-8, LF. ``decimals`` fixes the digits after the point of every double, so that equal numbers give equal bytes."""
    fixed = {c: F.format_string(f"%.{decimals}f", F.col(f"`{c}`")) for c, t in frame.dtypes if t == "double" and decimals is not None}
    fixed = {c: F.when(F.col(f"`{c}`").isNotNull(), text) for c, text in fixed.items()}
    frame.withColumns(fixed).write.option("header", True).option("escape", '"').option("emptyValue", "").mode("errorifexists").csv(path)


def _features(spark: SparkSession, path: str, properties: str, one_document: bool) -> DataFrame:
    schema = f"type string, features array<struct<type: string, properties: {properties}, geometry: {GEOMETRY}>>"
    read = spark.read.schema(schema).option("multiLine", one_document).option("mode", "FAILFAST").json(path)
    return read.where("features IS NOT NULL").select(F.explode("features").alias("f"))


def read_geojson(spark: SparkSession, path: str, properties: str, one_document: bool = False) -> DataFrame:
    """One row for each feature: the properties named by the schema, and ``geometry`` with its coordinates as JSON text.
    ``one_document``: a file is one FeatureCollection over many lines; else each line is one, and lines are read apart."""
    return _features(spark, path, f"struct<{properties}>", one_document).select("f.properties.*", "f.geometry")


def read_features(spark: SparkSession, path: str, one_document: bool = False) -> DataFrame:
    """One row for each feature as it stands in the file: ``properties`` as JSON text with its keys in order, and ``geometry``."""
    return _features(spark, path, "string", one_document).select("f.properties", "f.geometry")


def polygons(geometry: Column) -> Column:
    """Parts, rings and points of a Polygon or MultiPolygon; null for other kinds."""
    part, parts = "array<array<array<double>>>", "array<array<array<array<double>>>>"
    text = geometry["coordinates"]
    return F.when(geometry["type"] == "Polygon", F.array(F.from_json(text, part))).when(geometry["type"] == "MultiPolygon", F.from_json(text, parts))


def write_geojson(frame: DataFrame, path: str, kind: str, coordinates: str, line_features: int = LINE_FEATURES) -> None:
    """Compact FeatureCollections, one on each line, of about ``line_features`` features each: a single one if there are no
    more. ``coordinates`` is a column of nested arrays of ``kind``; all others become properties, nulls written out. A
    number that JSON cannot hold is refused."""
    names = [c for c in frame.columns if c != coordinates]
    checks = Checks(frame)
    for c, t in frame.dtypes:
        if t == "double":
            checks.none(f"{c} without a JSON number", F.isnan(c) | (F.abs(F.col(f"`{c}`")) == F.lit(float("inf"))))
    text = F.to_json(coordinates)
    checks.none("coordinates without JSON numbers", text.rlike("NaN|Infinity"))
    checks.none("no coordinates", F.col(coordinates).isNull())
    rows = checks.require()
    lines = max(1, -(-rows.count() // line_features))
    keep = {"ignoreNullFields": "false"}
    geometry = F.concat(F.lit(f'{{"type":"{kind}","coordinates":'), text, F.lit("}"))
    properties = F.to_json(F.struct(*[f"`{c}`" for c in names]), keep)
    feature = F.concat(F.lit('{"type":"Feature","properties":'), properties, F.lit(',"geometry":'), geometry, F.lit("}"))
    part = F.pmod(F.xxhash64(*[f"`{c}`" for c in names], text), F.lit(lines))
    collected = rows.select(part.alias("part"), feature.alias("feature")).groupBy("part").agg(F.array_sort(F.collect_list("feature")).alias("features"))
    whole = F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join("features", ","), F.lit("]}"))
    collected.select(whole.alias("value")).write.mode("errorifexists").text(path)


def verified(frame: DataFrame, write: Callable[[DataFrame], None], read: Callable[[], DataFrame]) -> DataFrame:
    """What was written, read again; fails unless schema and rows are those of the frame, repeats counted."""
    write(frame)
    again = read()
    if not same_rows(frame, again):
        raise QualityError("a written table differs from what was to be written")
    return again
