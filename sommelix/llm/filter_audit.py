"""How quality filters interact: what each removes at each step of every order in which they can be applied.

1. Every document gets one flag a filter, true where it fails, and its part. Rows are added up by part and flags at once, so
   what follows has at most 2 to the power of the number of filters rows a part.
2. A SQL CUBE over the flags and the part adds those rows up for every selection of them. A row of the cube whose selected
   flags are all false, with the part selected and the other flags added up, counts the survivors of that subset.
3. A step of an order leads from one subset to the next, with one filter more. Joining the two subsets' survivors gives what
   the step removes; the subsets of one filter, of all and of all but one give the rest.

"The same text as a smaller doc_id" is told without joining copies with each other: texts are hashed (SHA-256), rows of one
hash, part and flags are added up with the smallest id kept aside, and of one hash only the smallest id of all survives.
No step puts the copies of one text into one task.

Defined cases: null and empty texts are equal texts without words; a null language and an empty one are the part ``''``; rows
that repeat a doc_id share its fate (no id is smaller than itself); rows without doc_id come after all others and do not
precede each other; labels of a doc_id that occur several times count as the largest of each; labels without a document and
null labels count for nothing; other columns are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sommelix.llm.common import cut, table, words

COUNTED = ("n", "good", "toxic")
SPECIAL = r"[#$%&*|]"


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in COUNTED]


def subset_survivors(flagged: DataFrame, filters: Sequence[str]) -> DataFrame:
    """(part, subset, n, good, toxic) for every part and every subset of the filters, a bit each in their order.

    ``flagged`` has part, a boolean column named after each filter, and counts n, good and toxic."""
    # the sums are used twice and are small: some rows a part
    flagged = cut(flagged.groupBy("part", *filters).agg(*_sums()))
    cube = flagged.cube("part", *filters).agg(*_sums(), F.grouping_id().alias("added_up"))
    whole = 1 << len(filters)
    # grouping_id has a bit for each column that is added up, the part's first, then the filters' in order
    selected = sum((F.when(~F.getbit("added_up", F.lit(len(filters) - 1 - i)).cast("boolean"), 1 << i).otherwise(0) for i in range(len(filters))), F.lit(0))
    passing = [F.coalesce(~F.col(f), F.lit(True)) for f in filters]
    alive = cube.where(F.col("added_up") < whole)
    for p in passing:
        alive = alive.where(p)
    alive = alive.select("part", selected.alias("subset"), *COUNTED)
    # subsets that nothing survives have no row in the cube
    every = flagged.select("part").distinct().select("part", F.explode(F.sequence(F.lit(0), F.lit(whole - 1))).alias("subset"))
    return every.join(alive, ["part", "subset"], "left").na.fill(0, list(COUNTED))


def steps_of_orders(spark, filters: Sequence[str]) -> DataFrame:
    """(filter_order, step, filter, alone, before, after): one row for each step of every order; subsets as bits."""
    bit = {f: 1 << i for i, f in enumerate(filters)}
    rows = []
    for order in permutations(filters):
        before = 0
        for k, f in enumerate(order):
            rows.append(("".join(order), k + 1, f, bit[f], before, before | bit[f]))
            before |= bit[f]
    return spark.createDataFrame(rows, "filter_order string, step int, filter string, alone int, before int, after int")


def filter_interactions(flagged: DataFrame, filters: Sequence[str]) -> DataFrame:
    """One row for every part, order and step; the number of rows does not depend on the number of documents."""
    survivors = cut(subset_survivors(flagged, filters))
    everything = (1 << len(filters)) - 1

    def side(name: str) -> DataFrame:
        return survivors.select(F.col("part").alias(f"{name}_part"), F.col("subset").alias(f"{name}_subset"), F.struct(*COUNTED).alias(name))

    steps = steps_of_orders(survivors.sparkSession, filters).crossJoin(survivors.where("subset = 0").select("part", F.col("n").alias("all_n")))
    wanted = {
        "s_before": F.col("before"),
        "s_after": F.col("after"),
        "s_alone": F.col("alone"),
        "s_all": F.lit(everything),
        "s_others": F.lit(everything) - F.col("alone"),
    }
    for name, subset in wanted.items():
        steps = steps.join(side(name), (F.col(f"{name}_part") == F.col("part")) & (F.col(f"{name}_subset") == subset))
    removed = F.col("s_before.n") - F.col("s_after.n")
    rows = steps.select(
        "part", "filter_order", "step", "filter",
        F.col("s_after.n").alias("kept"),
        removed.alias("removed"),
        (F.col("all_n") - F.col("s_alone.n") - removed).alias("redundant"),
        (F.col("s_others.n") - F.col("s_all.n")).alias("unique_fails"),
        (F.col("s_before.good") - F.col("s_after.good")).alias("good_lost"),
        (F.col("s_before.toxic") - F.col("s_after.toxic")).alias("toxic_lost"),
    )
    shares = rows.groupBy("part", "filter").agg(F.sum("removed").alias("shapley"))
    return rows.join(shares, ["part", "filter"])


def text_flags(text: Column) -> dict[str, Column]:
    """Filters that look at one text: A few words, B few different words, C many capitals, D special signs."""
    found = words(text)
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    return {
        "A": F.size(found) < 200,
        "B": 100 * F.size(F.array_distinct(found)) < 50 * F.size(found),
        "C": 100 * capitals > 3 * F.length(text),
        "D": text.rlike(SPECIAL),
    }


def flagged_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, A to E, n, good, toxic): documents counted by part and failed filters; E is a text equal to that of a smaller
    doc_id in the whole table."""
    text = F.coalesce("text", F.lit(""))
    flags = text_flags(text)
    rows = docs.select(
        "doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("hash"),
        *[f.alias(name) for name, f in flags.items()],
    )
    marked = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")
    )
    same = ["hash", "part", *flags]
    # the join deals rows out by doc_id, so this grouping moves nothing
    known = rows.where("doc_id IS NOT NULL").join(marked, "doc_id", "left").na.fill(0, ["good", "toxic"])
    known = known.groupBy("doc_id", *same).agg(F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    known = known.select(*same, *COUNTED, F.struct("doc_id", *COUNTED).alias("first"))
    unknown = rows.where("doc_id IS NULL").select(
        *same, F.lit(1).cast("long").alias("n"), *[F.lit(0).cast("long").alias(c) for c in COUNTED[1:]],
        F.lit(None).cast(known.schema["first"].dataType).alias("first"),
    )
    copies = known.unionByName(unknown).groupBy(*same).agg(*_sums(), F.min("first").alias("first"))
    smallest = copies.groupBy("hash").agg(F.min("first.doc_id").alias("smallest"))
    copies = copies.join(smallest, "hash")
    # of rows with one text, part and flags: those of the smallest id of all pass E; without any id, all do
    stays = [
        F.when(F.col("smallest").isNull(), F.col(c)).when(F.col("first.doc_id") == F.col("smallest"), F.col(f"first.{c}")).otherwise(0).alias(c)
        for c in COUNTED
    ]
    split = copies.select("part", *flags, F.struct(*COUNTED).alias("of_all"), F.struct(*stays).alias("stay"))
    split = split.select(
        "part", *flags,
        F.explode(F.array(
            F.struct(F.lit(False).alias("E"), *[F.col(f"stay.{c}").alias(c) for c in COUNTED]),
            F.struct(F.lit(True).alias("E"), *[(F.col(f"of_all.{c}") - F.col(f"stay.{c}")).alias(c) for c in COUNTED]),
        )).alias("half"),
    )
    return split.select("part", *flags, "half.*").where("n > 0")


def op11_filter_audit(spark, sf_dir) -> DataFrame:
    flagged = flagged_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return filter_interactions(flagged, "ABCDE").drop("filter")


OP11_SQL = r"""
WITH RECURSIVE t AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first_id FROM t),
l AS (SELECT doc_id, max(coalesce(quality = 1, FALSE)) AS good, max(coalesce(toxic = 1, FALSE)) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part,
    CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 3 * length(text) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN first_id IS NOT NULL AND (w.doc_id IS NULL OR w.doc_id > first_id) THEN 16 ELSE 0 END AS mask,
    coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic FROM w LEFT JOIN l USING (doc_id)),
c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY ALL),
o AS (SELECT '' AS filter_order, 0 AS step, 0 AS bit, 0 AS done
  UNION ALL SELECT filter_order || chr(65 + i::INT), step + 1, (1 << i)::INT, (done | (1 << i))::INT FROM o, range(5) r(i) WHERE (done & (1 << i)) = 0),
orders AS (SELECT filter_order FROM o WHERE step = 5),
s AS (SELECT a.filter_order, o.step, o.bit, o.done - o.bit AS before FROM orders a JOIN o ON o.step > 0 AND o.filter_order = a.filter_order[1:o.step]),
x AS (SELECT part, filter_order, step, bit,
    sum(n) FILTER (mask & (before | bit) = 0) AS kept,
    sum(n) FILTER (mask & before = 0 AND mask & bit > 0) AS removed,
    sum(n) FILTER (mask & before > 0 AND mask & bit > 0) AS redundant,
    sum(n) FILTER (mask = bit) AS unique_fails,
    sum(good) FILTER (mask & before = 0 AND mask & bit > 0) AS good_lost,
    sum(toxic) FILTER (mask & before = 0 AND mask & bit > 0) AS toxic_lost FROM c, s GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
  coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost,
  coalesce(toxic_lost, 0)::BIGINT AS toxic_lost, (sum(coalesce(removed, 0)) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM x
"""
