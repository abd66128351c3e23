"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

1. Targets: the wanted total is shared by weight; a source stops at ``max_repeats`` times its size and what is left is
   shared again. With the sources sorted by size per weight this is one running sum (water filling).
2. Blocks of ``block_words`` words are the seats. Highest quotients give seats to sources, then to the source's groups of
   shards, then to the shards of each group, so a hot source is never one window: a shard holds about
   ``shard_words`` words, a group ``group_shards`` shards.
3. A shard's documents stand in an order that the seed gives; its quota chooses blocks of that line: every block as often
   as the quota covers all, and the rest evenly spaced from a seeded start, so what a document gives is two evaluations
   of one running count and no block is ever a row.

Only (doc_id, source, size) is shuffled. Sources are assumed to be few (one row each in one window).

Defined cases: a null text has size 0 and gives nothing; null sources are one source, last in order; repeated rows are
rows of their own, in an order by id, size and source only, so equal rows are interchangeable; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sommelix.llm.common import cut, n_words

WEIGHTS = (5, 2, 1)
TOTAL_PERCENT = 150
MAX_REPEATS = 2
BLOCK_WORDS = 64
SHARD_WORDS = 65536
GROUP_SHARDS = 1024
SEED = "mix-1"


def targets(sources: DataFrame, weights=WEIGHTS, percent: int = TOTAL_PERCENT, repeats: int = MAX_REPEATS) -> DataFrame:
    """Adds ``target`` to rows (source, source_size). Sums are of integers, so every engine gets the same."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    cycle = F.array(*[F.lit(w) for w in weights])
    weighed = sources.withColumn("weight", F.element_at(cycle, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    before = Window.orderBy(
        (F.col("source_size") * repeats / F.col("weight")).asc(), F.col("source").asc_nulls_last()
    ).rowsBetween(Window.unboundedPreceding, -1)
    left = weighed.select(
        "*",
        (F.sum("source_size").over(every) * percent / 100 - F.coalesce(F.sum(F.col("source_size") * repeats).over(before), F.lit(0))).alias("words_left"),
        (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("weight_left"),
    )
    level = F.max(F.col("words_left") / F.col("weight_left")).over(every)
    return left.select(
        "source",
        "source_size",
        F.least((F.col("source_size") * repeats).cast("double"), level * F.col("weight")).alias("target"),
    )


def apportion(parties: DataFrame, parents: list[str], key: list[str], votes: str, seats: str, out: str) -> DataFrame:
    """Sainte-Lague: of ``seats`` (the same in a parent's rows) each party gets those of its quotients votes / (2k - 1)
    that are among the highest; ties go to the smaller key.

    With n parties, every party surely has the seats of a divisor that would give seats - n / 2 in all, and none has
    more than a divisor for seats + n / 2 gives, so only about 2 n quotients are ranked, however many seats there are.
    """
    w = Window.partitionBy(*parents)
    total, n = F.sum(votes).over(w), F.count("*").over(w)
    share = F.when(total > 0, F.col(votes) / total).otherwise(0.0)
    bounds = parties.withColumns({"_share": share, "_n": n}).withColumns(
        {
            "_sure": F.greatest(F.lit(0), F.floor(F.col("_share") * (F.col(seats) - F.col("_n") / 2) + 0.5)).cast("long"),
            "_most": F.floor(F.col("_share") * (F.col(seats) + F.col("_n") / 2) + 0.5).cast("long") + 1,
        }
    )
    tried = bounds.withColumn("_left", F.col(seats) - F.sum("_sure").over(w)).withColumn(
        "_k", F.explode(F.sequence(F.col("_sure") + 1, F.greatest(F.col("_most"), F.col("_sure") + 1)))
    )
    ranked = tried.withColumn(
        "_rank",
        F.row_number().over(
            w.orderBy((F.col("_share") / (2 * F.col("_k") - 1)).desc(), *[F.col(k).asc_nulls_last() for k in key], "_k")
        ),
    )
    return ranked.groupBy(*parties.columns, "_sure").agg(
        F.count_if((F.col("_rank") <= F.col("_left")) & (F.col("_share") > 0)).alias("_more")
    ).select(*parties.columns, (F.col("_sure") + F.col("_more")).alias(out))


def mix(
    docs: DataFrame,
    weights=WEIGHTS,
    percent: int = TOTAL_PERCENT,
    repeats: int = MAX_REPEATS,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    group_shards: int = GROUP_SHARDS,
    seed: str = SEED,
) -> DataFrame:
    """doc_id, source, size, source_size, target and taken (words the mix takes, repeats counted) of every document."""
    # equal rows are counted and told apart by a number, so neither they nor null ids share a mark, and reruns agree
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("hash"))
    counted = sized.groupBy("doc_id", "source", "size", "hash").agg(F.count("*").alias("n"))
    copies = counted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n"))))
    name = F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string"), "hash", "copy")
    sized = cut(copies.select("doc_id", "source", "size", F.md5(name.cast("binary")).alias("mark")))
    by_source = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, percent, repeats)
    seats = F.floor(F.sum("source_size").over(Window.partitionBy()) * percent / 100 / block_words + 0.5)
    quotas = apportion(by_source.withColumn("seats", seats), [], ["source"], "target", "seats", "source_quota")
    quotas = cut(
        quotas.select(
            F.col("source").alias("s"), "source_size", "target", "source_quota",
            F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("long").alias("n_shards"),
        )
    )

    def of_source(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.join(right, left["source"].eqNullSafe(right["s"])).drop("s")

    number = F.conv(F.substring("mark", 1, 8), 16, 10).cast("long")
    dealt = of_source(sized, quotas.select("s", "source_size", "target", "n_shards")).withColumn(
        "shard", number % F.col("n_shards")
    )
    dealt = cut(dealt.select("doc_id", "source", "size", "mark", "source_size", "target", "shard"))
    shards = dealt.groupBy("source", "shard").agg(F.sum("size").alias("words"))
    shards = shards.withColumn("pack", F.floor(F.col("shard") / group_shards))
    packs = shards.groupBy("source", "pack").agg(F.sum("words").alias("pack_words"))
    packs = apportion(of_source(packs, quotas.select("s", "source_quota")), ["source"], ["pack"], "pack_words", "source_quota", "pack_quota")
    packs = packs.select(F.col("source").alias("s"), F.col("pack").alias("p"), "pack_quota")
    shards = shards.join(packs, shards["source"].eqNullSafe(packs["s"]) & (shards["pack"] == packs["p"])).drop("s", "p")
    shards = apportion(shards, ["source", "pack"], ["shard"], "words", "pack_quota", "quota")

    n = F.greatest(F.lit(1), F.ceil(F.col("words") / block_words)).cast("long")
    start = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce("source", F.lit("")), F.lit(":"), F.col("shard").cast("string")).cast("binary"))
    plan = shards.withColumn("n", n).withColumn("quota", F.least("quota", repeats * F.col("n"))).select(
        F.col("source").alias("s"),
        F.col("shard").alias("h"),
        "n",
        F.floor(F.col("quota") / F.col("n")).alias("whole"),
        (F.col("quota") % F.col("n")).alias("extra"),
        (F.conv(F.substring(start, 1, 8), 16, 10).cast("long") % F.col("n")).alias("offset"),
    )
    line = Window.partitionBy("source", "shard").orderBy("mark", F.col("doc_id").asc_nulls_last(), "size")
    placed = dealt.withColumn("end", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    placed = placed.join(plan, placed["source"].eqNullSafe(plan["s"]) & (placed["shard"] == plan["h"])).drop("s", "h")

    def chosen(block):  # extra blocks chosen before this one
        return F.floor((block * F.col("extra") + F.col("offset")) / F.col("n"))

    def upto(p):
        block = F.floor(p / block_words)
        return chosen(block) * block_words + (chosen(block + 1) - chosen(block)) * (p - block * block_words)

    taken = F.col("whole") * F.col("size") + upto(F.col("end")) - upto(F.col("end") - F.col("size"))
    return placed.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


def op5_mixing(spark, sf_dir) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken")
