"""Whether a new snapshot differs from the last accepted one widely and credibly enough to be accepted."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sommelix.functions.text import normalized_text
from sommelix.operators.linkage import Linkage

# Columns that are compared, and the bounds of a credible and of a material comparison.
EXPECTED = ("name", "address", "city", "country", "price", "cuisine", "url", "award", "stars", "longitude", "latitude")
AWARD = ("award", "stars")
DESCRIPTIVE = ("name", "address", "city", "price", "cuisine")
LEAST_MATCHED = 0.80
MOST_AMBIGUOUS = 0.05
MOST_CONFLICTS = 0.02
MOST_DESCRIPTIVE = 0.50
LEAST_MATERIAL = 50
LEAST_AWARD_CHANGES = 10
LEAST_CATEGORIES = 2


def rate(n: Column, *of: Column) -> Column:
    """A share of the largest of some counts, of 1 at least."""
    return n / F.greatest(*of, F.lit(1))


def matched_changes(previous: DataFrame, current: DataFrame, matches: DataFrame) -> DataFrame:
    """previous_row, current_row, both awards, and ``change``: award, descriptive or none. A null differs from everything, another
    null included, among award columns, and is an empty text among descriptive ones."""

    def side(frame: DataFrame, name: str) -> DataFrame:
        kept = [c for c in (*AWARD, *DESCRIPTIVE) if c in frame.columns]
        return frame.select(F.col("source_row").alias(f"{name}_row"), *[F.col(c).alias(f"{name}_{c}") for c in kept])

    p, c = side(previous, "previous"), side(current, "current")
    both = matches.select("previous_row", "current_row").join(p, "previous_row").join(c, "current_row")
    shared = [x for x in (*AWARD, *DESCRIPTIVE) if x in previous.columns and x in current.columns]
    any_of = lambda tests: reduce(Column.__or__, tests, F.lit(False))
    award = any_of([F.coalesce(F.col(f"previous_{x}") != F.col(f"current_{x}"), F.lit(True)) for x in shared if x in AWARD])
    text = lambda name: normalized_text(F.col(name).cast("string"))
    told = any_of([text(f"previous_{x}") != text(f"current_{x}") for x in shared if x in DESCRIPTIVE])
    change = F.when(award, "award").when(told, "descriptive").otherwise("none")
    return both.select("previous_row", "current_row", "previous_award", "current_award", change.alias("change"))


def transitions(changes: DataFrame) -> DataFrame:
    """transition, 'old -> new', and how many matched rows made it."""
    moved = F.concat_ws(" -> ", *[F.coalesce(F.col(f"{s}_award"), F.lit("nan")) for s in ("previous", "current")])
    return changes.where("change = 'award'").groupBy(moved.alias("transition")).agg(F.count("*").alias("n"))


def compared(previous: DataFrame, current: DataFrame, linked: Linkage, changes: DataFrame) -> DataFrame:
    """One row of counts and rates. Each table is reduced to a row of its own before the rows are put side by side."""
    one = [
        previous.agg(F.count("*").alias("previous_rows")),
        current.agg(F.count("*").alias("candidate_rows")),
        linked.candidates.agg(F.count("*").alias("ambiguous_matches")),
        linked.conflicts.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("duplicate_conflicts")),  # rows that share a key
        linked.previous_left.agg(F.count("*").alias("removed_restaurants")),
        linked.current_left.agg(
            F.count("*").alias("added_restaurants"), F.count_if(F.col("award") == "Selected Restaurants").alias("added_selected_restaurants")
        ),
        changes.agg(
            F.count("*").alias("matched_restaurants"),
            F.count_if(F.col("change") == "award").alias("award_label_changes"),
            F.count_if(F.col("change") == "descriptive").alias("other_changed_rows"),
            F.count_if(F.col("change") == "none").alias("unchanged_restaurants"),
        ),
        changes.where("change = 'award'").select(F.explode(F.array(*[F.coalesce(c, F.lit("nan")) for c in ("previous_award", "current_award")])).alias("a"))
        .agg(F.array_sort(F.collect_set("a")).alias("award_categories_changed")),
    ]
    row = reduce(lambda a, b: a.join(b, F.lit(True)), one)  # each side has one row
    n, m = F.col("previous_rows"), F.col("candidate_rows")
    return row.withColumns(
        {
            "match_rate": rate(F.col("matched_restaurants"), n, m),
            "ambiguous_rate": rate(F.col("ambiguous_matches"), n, m),
            "duplicate_rate": rate(F.col("duplicate_conflicts"), n, m),
            "descriptive_rate": rate(F.col("other_changed_rows"), F.col("matched_restaurants")),
        }
    )


def judged(row: DataFrame, missing: list[str]) -> DataFrame:
    """``reliable``, ``accepted`` and ``verdict``, the first rule that speaks against the candidate or 'accepted'.
    ``missing``: expected columns that a side lacks."""
    c = F.col
    doubtful = (
        F.when(F.lit(bool(missing)), "missing columns: " + ", ".join(missing))
        .when(c("match_rate") < LEAST_MATCHED, "too few restaurants matched")
        .when(c("ambiguous_rate") > MOST_AMBIGUOUS, "too many ambiguous candidates")
        .when(c("duplicate_rate") > MOST_CONFLICTS, "too many conflicts of repeated keys")
        .when(c("descriptive_rate") > MOST_DESCRIPTIVE, "too many descriptive changes")
    )
    still = (c("removed_restaurants") == 0) & (c("award_label_changes") == 0)
    immaterial = (
        F.when((c("added_restaurants") > 0) & (c("added_selected_restaurants") == c("added_restaurants")) & still, "only adds selected restaurants")
        .when(c("added_restaurants") + c("removed_restaurants") + c("award_label_changes") < LEAST_MATERIAL, "too few material changes")
        .when(c("award_label_changes") < LEAST_AWARD_CHANGES, "too few changes of award")
        .when(F.size("award_categories_changed") < LEAST_CATEGORIES, "changes of award in one category only")
    )
    told = row.withColumns({"reliable": doubtful.isNull(), "verdict": F.coalesce(doubtful, immaterial, F.lit("accepted"))})
    return told.withColumn("accepted", c("verdict") == "accepted")


def missing_columns(previous: DataFrame, current: DataFrame) -> list[str]:
    return [c for c in EXPECTED if c not in previous.columns or c not in current.columns]
