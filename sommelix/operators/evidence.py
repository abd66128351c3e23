"""Checks that say what is wrong and where: a row for each fault found, with how many rows show it and the first of them.

A report has (check, n, first), ``first`` as text; what is in order has no row. ``required`` fails with all rows of a report.
Reports are aggregations and joins on keys, and may be put together with ``union`` before anything runs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sommelix.operators.quality import QualityError


def _report(faults: DataFrame, check: Column, first: Column) -> DataFrame:
    """Rows that are faults, counted by check."""
    return faults.groupBy(check.cast("string").alias("check")).agg(F.count("*").alias("n"), F.min(first.cast("string")).alias("first"))


def together(*reports: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def required(report: DataFrame) -> None:
    """Fails unless the report is empty."""
    rows = report.orderBy("check").collect()  # one row a check
    if rows:
        raise QualityError("; ".join(f"{r.check}: {r.n}, first {r['first']}" for r in rows))


def keys(frame: DataFrame, key: str, name: str) -> DataFrame:
    """Keys are not null and occur once."""
    counted = frame.groupBy(F.col(key).alias("k")).agg(F.count("*").alias("rows"))
    what = F.when(F.col("k").isNull(), f"{name}: null key").when(F.col("rows") > 1, f"{name}: repeated key")
    return _report(counted.withColumn("what", what).where("what IS NOT NULL"), F.col("what"), F.col("k"))


def filled(frame: DataFrame, columns: list[str], key: str, name: str) -> DataFrame:
    """Required columns have no nulls."""
    lost = F.explode(F.array_compact(F.array(*[F.when(F.col(f"`{c}`").isNull(), c) for c in columns])))
    return _report(frame.select(F.col(key).alias("k"), lost.alias("c")), F.concat(F.lit(f"{name}: null in "), "c"), F.col("k"))


def repeated_rows(frame: DataFrame, columns: list[str], key: str, name: str) -> DataFrame:
    """No two rows agree in all the columns; nulls agree with nulls. Counts the rows beyond the first of each."""
    groups = frame.groupBy(*columns).agg((F.count("*") - 1).alias("more"), F.min(key).alias("k")).where("more > 0")
    return groups.groupBy(F.lit(f"{name}: repeated rows").alias("check")).agg(F.sum("more").alias("n"), F.min(F.col("k").cast("string")).alias("first"))


def same_keys(frames: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """All frames have the same keys; names those that each one lacks."""
    seen = reduce(DataFrame.unionByName, [f.select(F.col(k).cast("string").alias("k"), F.lit(n).alias("name")) for n, (f, k) in frames.items()])
    by = seen.where("k IS NOT NULL").groupBy("k").agg(F.collect_set("name").alias("in"))  # one entry for each frame at most
    lacking = by.select("k", F.explode(F.array_except(F.array(*map(F.lit, frames)), "in")).alias("name"))
    return _report(lacking, F.concat("name", F.lit(": missing key")), F.col("k"))


def disagreements(a: DataFrame, b: DataFrame, on: tuple[str, str], columns: dict[str, str], name: str) -> DataFrame:
    """Rows of a and b with one key agree, as text, in the columns of a that are paired with columns of b; nulls differ from
    all but nulls. Keys that only one of them has are for ``same_keys``."""
    right = b.select(F.col(on[1]).cast("string").alias("k"), *[F.col(c).cast("string").alias(f"b{i}") for i, c in enumerate(columns.values())])
    left = a.select(F.col(on[0]).cast("string").alias("k"), *[F.col(c).cast("string").alias(f"a{i}") for i, c in enumerate(columns)])
    differ = F.array_compact(F.array(*[F.when(~F.col(f"a{i}").eqNullSafe(F.col(f"b{i}")), c) for i, c in enumerate(columns)]))
    return _report(left.join(right, "k").select("k", F.explode(differ).alias("c")), F.concat(F.lit(f"{name}: differs in "), "c"), F.col("k"))


def within(frame: DataFrame, column: str, allowed: DataFrame, of: str, key: str, name: str) -> DataFrame:
    """Values are among the allowed ones; nulls are for ``filled``."""
    lost = frame.where(F.col(column).isNotNull()).join(allowed.select(F.col(of).alias("_allowed")).distinct(), F.col(column) == F.col("_allowed"), "left_anti")
    return _report(lost, F.lit(f"{name}: unknown {column}"), F.col(key))


def partition_of(whole: DataFrame, parts: dict[str, DataFrame], belongs: dict[str, Column], row: str) -> DataFrame:
    """The parts are disjoint, each row lies in the part that it belongs to and is the same there, and none is lost or added.

    ``row`` numbers the rows of the whole; a row that belongs to no part is in none. Rows of parts are compared by a hash of
    all columns of the whole."""
    same = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(whole.columns)]).alias("same")
    target = reduce(lambda done, p: done.when(p[1], F.lit(p[0])), list(belongs.items())[1:], F.when(list(belongs.values())[0], F.lit(list(belongs)[0])))
    wanted = whole.select(F.col(row).alias("row"), target.alias("wanted"), same)
    got = reduce(DataFrame.unionByName, [p.select(F.col(row).alias("row"), F.lit(n).alias("part"), same.alias("is")) for n, p in parts.items()])
    counted = got.groupBy("row").agg(F.count("*").alias("times"), F.min("part").alias("part"), F.min("is").alias("is"))
    met = wanted.join(counted, "row", "full").withColumn("times", F.coalesce("times", F.lit(0)))
    what = (
        F.when(F.col("same").isNull(), "row of no source")
        .when(F.col("times") > 1, "row in several parts")
        .when((F.col("times") == 0) & F.col("wanted").isNotNull(), "row lost")
        .when((F.col("times") == 1) & ~F.col("part").eqNullSafe(F.col("wanted")), "row in a wrong part")
        .when((F.col("times") == 1) & (F.col("is") != F.col("same")), "row changed")
    )
    return _report(met.withColumn("what", what).where("what IS NOT NULL"), F.col("what"), F.col("row"))


def counts_reconcile(rollup: DataFrame, classes: list[str], rows: DataFrame, name: str) -> DataFrame:
    """The counts by class add up to the number of rows that were counted."""
    counted = rollup.agg(F.coalesce(F.sum(reduce(lambda a, b: a + b, [F.coalesce(F.col(f"`{c}`"), F.lit(0)) for c in classes])), F.lit(0)).alias("counted"))
    both = counted.crossJoin(rows.agg(F.count("*").alias("rows")))  # one row each
    return both.where("counted <> rows").select(
        F.lit(f"{name}: counts do not add up").alias("check"), F.abs(F.col("counted") - F.col("rows")).alias("n"), F.concat("counted", F.lit(" of "), "rows").alias("first")
    )


def number_of_rows(frame: DataFrame, wanted: int, name: str) -> DataFrame:
    found = frame.agg(F.count("*").alias("rows")).where(F.col("rows") != wanted)
    return found.select(F.lit(f"{name}: not {wanted} rows").alias("check"), F.abs(F.col("rows") - wanted).alias("n"), F.col("rows").cast("string").alias("first"))


def columns_in_order(frame: DataFrame, wanted: list[str], name: str) -> DataFrame:
    """The frame has just these columns in this order; a check of the schema, which reads no rows."""
    faults = [] if frame.columns == wanted else [(f"{name}: columns", len(set(frame.columns) ^ set(wanted)), ", ".join(frame.columns))]
    return frame.sparkSession.createDataFrame(faults, "check string, n long, first string")
