"""The bits that tell which rows may be wanted."""

from pyspark.sql import functions as F

from sommelix.llm.common import maybe_in


def test_nothing_wanted_is_lost_and_little_else_kept(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 100 != 7, F.col("id")).alias("k"), F.col("id").alias("v"))
    wanted = rows.where("v % 50 = 0").select("k").unionByName(spark.range(1).select(F.lit(None).cast("long").alias("k")))
    there = rows.where("v % 50 = 0 OR k IS NULL").count()
    kept = maybe_in(rows, ["k"], wanted)
    assert kept.columns == rows.columns
    assert kept.where("v % 50 = 0 OR k IS NULL").count() == there
    assert there <= kept.count() < there + 50
    assert maybe_in(rows, ["k"], wanted, "left_anti").count() + kept.count() == 20_000


def test_few_bits_and_too_many_wanted(spark):
    rows = spark.range(1_000).select(F.col("id").alias("k"))
    assert maybe_in(rows, ["k"], rows.limit(5), n=64).where("k < 0").count() == 0
    assert maybe_in(rows, ["k"], rows, n=64).count() == 1_000
    assert maybe_in(rows, ["k"], rows, "left_anti", n=64).count() == 0
    assert maybe_in(rows, ["k"], rows.limit(0)).count() == 0
