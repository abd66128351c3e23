"""Checks that fail closed. A frame's checks are gathered and evaluated together in one aggregation."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class QualityError(ValueError):
    """Data that must not be published."""


@dataclass
class Checks:
    """Named counts that must be zero (or equal a wanted number), computed by a single pass over the frame."""

    frame: DataFrame
    counts: dict[str, tuple[Column, int]] = field(default_factory=dict)

    def none(self, name: str, bad: Column) -> Checks:
        """No row may fulfil ``bad``; null counts as not fulfilling."""
        self.counts[name] = (F.count_if(F.coalesce(bad, F.lit(False))), 0)
        return self

    def rows(self, name: str, wanted: int) -> Checks:
        self.counts[name] = (F.count("*"), wanted)
        return self

    def distinct(self, name: str, columns: list[str], wanted: int) -> Checks:
        self.counts[name] = (F.count_distinct(*columns), wanted)
        return self

    def exactly(self, name: str, condition: Column, wanted: int) -> Checks:
        self.counts[name] = (F.count_if(F.coalesce(condition, F.lit(False))), wanted)
        return self

    def report(self) -> DataFrame:
        """name, passed, observed and expected of each check, one row each."""
        one = self.frame.agg(*[c.alias(f"c{i}") for i, (c, _) in enumerate(self.counts.values())])
        rows = F.array(
            *[
                F.struct(F.lit(n).alias("name"), (F.col(f"c{i}") == w).alias("passed"), F.col(f"c{i}").cast("long").alias("observed"), F.lit(w).cast("long").alias("expected"))
                for i, (n, (_, w)) in enumerate(self.counts.items())
            ]
        )
        return one.select(F.inline(rows))

    def require(self) -> DataFrame:
        """The frame, if all checks pass."""
        failed = [r for r in self.report().collect() if not r["passed"]]
        if failed:
            raise QualityError("; ".join(f"{r['name']}: {r['observed']} instead of {r['expected']}" for r in failed[:8]))
        return self.frame


def require_columns(frame: DataFrame, columns: list[str], label: str) -> None:
    if missing := [c for c in columns if c not in frame.columns]:
        raise QualityError(f"{label} lacks columns: {', '.join(missing)}")


def any_null(columns: list[str]) -> Column:
    return reduce(Column.__or__, [F.col(c).isNull() for c in columns])


def duplicate_keys(frame: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, nulls being equal."""
    return frame.groupBy(*keys).count().where("count > 1")


def exact_duplicates(frame: DataFrame) -> DataFrame:
    return duplicate_keys(frame, frame.columns)


def require_unique(frame: DataFrame, keys: list[str], label: str) -> DataFrame:
    found = duplicate_keys(frame, keys).limit(5).collect()
    if found:
        raise QualityError(f"{label} is not unique by {keys}: {[tuple(r)[:-1] for r in found]}")
    return frame


def null_profile(frame: DataFrame) -> DataFrame:
    """column, nulls: one row for each column."""
    counts = frame.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in frame.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in frame.columns])
    return counts.select(F.inline(pairs))


def value_counts(frame: DataFrame, column: str) -> DataFrame:
    """Frequency of each value, nulls kept."""
    return frame.groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("n"))


def schema_drift(previous: list[str], candidate: list[str]) -> dict[str, list[str]]:
    a, b = set(previous), set(candidate)
    return {"added": sorted(b - a), "removed": sorted(a - b), "shared": sorted(a & b)}


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Equal schemas in order and equal rows, counting repeats."""
    if a.dtypes != b.dtypes:
        return False
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.exceptAll(b).unionAll(b.exceptAll(a))


def close(a: Column, b: Column, rtol: float = 1e-12, atol: float = 1e-9) -> Column:
    return F.abs(a - b) <= atol + rtol * F.abs(b)
