"""Joins with a stated cardinality, unique-key matching, and ordered choices."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sommelix.operators.quality import QualityError, require_unique


def checked_join(
    left: DataFrame, right: DataFrame, on: list[tuple[str, str]], how: str = "left", one_to_one: bool = False, matched: str | None = None
) -> DataFrame:
    """Equi-join whose right side must be unique by its keys (and the left too, if one to one).

    ``matched`` names a column of the right side that must not be null after the join; if it is, some left row had no
    partner and the join fails. The right keys are dropped unless they have the left keys' names.
    """
    require_unique(right, [b for _, b in on], "right side")
    if one_to_one:
        require_unique(left, [a for a, _ in on], "left side")
    renamed = right.withColumnsRenamed({b: f"_{b}" for _, b in on})
    joined = left.join(renamed, reduce(Column.__and__, [left[a] == renamed[f"_{b}"] for a, b in on]), how)
    if matched is not None:
        lost = joined.where(F.col(matched).isNull()).select(*[left[a] for a, _ in on]).distinct().limit(5).collect()
        if lost:
            raise QualityError(f"keys without a partner: {[tuple(r) for r in lost]}")
    return joined.drop(*[f"_{b}" for _, b in on])


def zero_filled(left: DataFrame, counts: DataFrame, on: list[tuple[str, str]], columns: list[str]) -> DataFrame:
    return checked_join(left, counts, on).na.fill(0, columns)


def reconcile(a: DataFrame, b: DataFrame, key: str, names: tuple[str, str]) -> DataFrame:
    """Full outer join of two key-to-name tables; rows on one side only or with different names."""
    x = a.select(F.col(key).alias("a_key"), F.col(names[0]).alias("a_name"))
    y = b.select(F.col(key).alias("b_key"), F.col(names[1]).alias("b_name"))
    joined = x.join(y, F.col("a_key") == F.col("b_key"), "full_outer")
    return joined.where("a_key IS NULL OR b_key IS NULL OR NOT (a_name <=> b_name)").select(
        F.coalesce("a_key", "b_key").alias("key"), "a_name", "b_name"
    )


def unique_keys(frame: DataFrame, keys: list[str], row: str) -> DataFrame:
    """Keys, all non-empty, that exactly one row has, with that row's number."""
    good = reduce(Column.__and__, [F.col(k).isNotNull() & (F.col(k).cast("string") != "") for k in keys])
    return frame.where(good).groupBy(*keys).agg(F.count("*").alias("n"), F.min(row).alias(row)).where("n = 1").drop("n")


def unique_match(previous: DataFrame, current: DataFrame, keys: list[str], row: str = "source_row") -> DataFrame:
    """previous_row, current_row of rows whose key is unique on both sides and equal."""
    a = unique_keys(previous, keys, row).withColumnRenamed(row, "previous_row")
    b = unique_keys(current, keys, row).withColumnRenamed(row, "current_row")
    return a.join(b, keys).select("previous_row", "current_row")


def first_by(frame: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first n rows of each key in the given total order, which must break its own ties."""
    return (
        frame.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
        .where(F.col("_rank") <= n)
        .drop("_rank")
    )


def ranked(frame: DataFrame, keys: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    return frame.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def mapped(column: Column, values: dict) -> Column:
    """Dictionary lookup; a missing key gives null."""
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[column]
