"""Long statistical cubes: slices, pivots that refuse repeated cells, and reconciliation of components."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sommelix.operators.quality import QualityError, duplicate_keys, require_columns


def cube_slice(cube: DataFrame, fixed: dict[str, str | list[str]]) -> DataFrame:
    """Rows whose dimensions have the given values; the conjunction reaches the scan."""
    require_columns(cube, list(fixed), "cube")
    tests = [F.col(c).isin(v) if isinstance(v, list) else F.col(c) == v for c, v in fixed.items()]
    return cube.where(reduce(Column.__and__, tests))


def pivoted(cube: DataFrame, key: str, measure: str, value: str, measures: list[str]) -> DataFrame:
    """One row for each key with a column for each measure. A cell given twice is an error, as is a missing measure."""
    wanted = cube.where(F.col(measure).isin(measures))
    if not duplicate_keys(wanted, [key, measure]).isEmpty():
        raise QualityError(f"a {key} has a {measure} twice")
    wide = wanted.groupBy(key).pivot(measure, measures).agg(F.first(value))
    if not wide.where(reduce(Column.__or__, [F.col(f"`{m}`").isNull() for m in measures])).isEmpty():
        raise QualityError(f"a {key} lacks a {measure}")
    return wide


def pivot_counts(frame: DataFrame, key: str, column: str, values: list[str]) -> DataFrame:
    """Counts of each value as columns, 0 where there is none."""
    return frame.groupBy(key).agg(*[F.count_if(F.col(column) == v).alias(v) for v in values])


def require_components(frame: DataFrame, parts: list[str], total: str, most: float) -> DataFrame:
    """The frame, if the parts add up to the total within ``most`` everywhere."""
    gap = F.abs(reduce(Column.__add__, [F.col(p) for p in parts]) - F.col(total))
    worst = frame.agg(F.max(gap).alias("gap"), F.count_if(gap.isNull()).alias("unknown")).first()
    if worst["unknown"] or (worst["gap"] or 0) > most:
        raise QualityError(f"{' + '.join(parts)} and {total} do not reconcile: {worst['gap']}")
    return frame
