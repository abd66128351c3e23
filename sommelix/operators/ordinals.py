"""Numbers of rows in the order of their files, and what is out of order, without any task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sommelix.operators.lineage import saved


def source_ordinals(read: DataFrame, name: str = "ordinal", first: int = 0) -> DataFrame:
    """Rows read from files with their number in the order of the files' paths, then of their place in the file.

    Two passes: rows are counted for each stretch of a file that a task reads, the counts of the stretches before are added up
    (one row a stretch), and a row's number is its stretch's start plus its place there. ``read`` must come straight from files."""
    at = read.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_id"))
    at = saved(at)
    stretches = at.groupBy("_path", "_start").agg(F.count("*").alias("_n"), F.min("_id").alias("_from"))
    before = F.sum("_n").over(Window.orderBy("_path", "_start").rowsBetween(Window.unboundedPreceding, -1))
    offsets = stretches.select("_path", "_start", (F.coalesce(before, F.lit(0)) - F.col("_from") + first).alias("_offset"))
    return at.join(offsets, ["_path", "_start"]).withColumn(name, F.col("_id") + F.col("_offset")).drop("_path", "_start", "_id", "_offset")


def steps_back(frame: DataFrame, key: str, order: Column, block: int = 100_000) -> DataFrame:
    """Rows whose key is smaller than that of the row before, in a given order of whole numbers without gaps or repeats.

    Rows are compared within blocks of the order; the first row of a block is compared with the last of the one before, so only
    two rows a block go further. Rows with a null key, or after one, are not out of order."""
    rows = frame.withColumns({"_at": order.cast("long"), "_block": F.floor(order / block)})
    inside = rows.withColumn("_before", F.lag(key).over(Window.partitionBy("_block").orderBy("_at")))
    last = rows.groupBy((F.col("_block") + 1).alias("_block")).agg(F.struct(F.max("_at").alias("at"), F.max_by(key, "_at").alias("key")).alias("_last"))
    met = inside.join(last, "_block", "left")
    before = F.when(F.col("_last.at") == F.col("_at") - 1, F.col("_last.key"))
    return met.where(F.coalesce("_before", before) > F.col(key)).select(*[f"`{c}`" for c in frame.columns])
