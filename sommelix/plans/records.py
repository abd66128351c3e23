"""Queries on tables with versions, ledgers, row numbers, archives and sweeps."""

from __future__ import annotations

from pyspark.sql import functions as F

from sommelix.operators import borders, ledger, ordinals, partition
from sommelix.operators.lineage import shared_path
from sommelix.operators.versions import Versions, upserted
from sommelix.plans.areas import bulging
from sommelix.plans.registry import query
from sommelix.sources import binary, files


# Nations with their number of customers; a reviewer has written notes on some before the numbers are made again.
@query("""WITH c AS (SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_custkey % 3 > 0 GROUP BY 1)
SELECT 'N' || k AS slug, CAST(n AS VARCHAR) AS customers, CASE WHEN k % 4 = 0 AND k % 5 > 0 THEN 'seen ' || k ELSE '' END AS notes,
  CASE WHEN k % 4 = 0 AND k % 5 > 0 THEN 'approved' ELSE '' END AS review_status FROM c""")
def review_upsert(table):
    customers = table("customer")
    slug, human = F.concat(F.lit("N"), F.col("c_nationkey")), ["notes", "review_status"]
    made = lambda rows: rows.groupBy(slug.alias("slug")).agg(F.count("*").cast("string").alias("customers"))
    reviews = Versions(customers.sparkSession, shared_path(customers.sparkSession, "reviews"))
    first = upserted(reviews, made(customers.where("c_nationkey % 5 > 0")), "slug", human)
    number = F.substring("slug", 2, 9).cast("int")
    noted = F.when(number % 4 == 0, F.concat(F.lit("seen "), number)).otherwise("")
    reviews.publish(first.withColumns({"notes": noted, "review_status": F.when(number % 4 == 0, "approved").otherwise("")}))
    return upserted(reviews, made(customers.where("c_custkey % 3 > 0")), "slug", human)


# Balances by nation, twice; between the two runs one in four nations changes, and one in six has a customer that must not be.
@query("""SELECT c_nationkey AS region, CASE WHEN c_nationkey % 6 = 1 THEN 'failed' WHEN c_nationkey % 4 = 0 THEN 'computed' ELSE 'skipped' END AS status,
  CASE WHEN c_nationkey % 6 = 1 THEN 'customer ' || min(c_custkey) END AS error,
  CASE WHEN c_nationkey % 6 <> 1 THEN count(*) + CASE WHEN c_nationkey % 4 = 0 THEN count(*) ELSE 0 END END AS n FROM customer GROUP BY c_nationkey""")
def batch_resume(table):
    customers = table("customer").select(F.col("c_nationkey").alias("region"), "c_custkey", F.lit(1).alias("weight"))
    path = shared_path(customers.sparkSession, "batch")
    results, done = (Versions(customers.sparkSession, f"{path}/{n}") for n in ("results", "ledger"))

    def totals(rows):
        return rows.groupBy("region").agg(F.sum("weight").alias("n"))

    def faults(rows):
        first = rows.where("region % 6 = 1").groupBy("region").agg(F.min("c_custkey").alias("first"))
        return first.select("region", F.concat(F.lit("customer "), "first").alias("error"))

    changed = customers.withColumn("weight", F.when(F.col("region") % 4 == 0, 2).otherwise(1))
    for rows in (customers, changed):
        status = ledger.run_regions(rows, "region", results, done, totals, faults, {"weight": 1})
    return status.drop("digest").join(results.current(), "region", "left")


# Customers written in order as several files, numbered as they lie there.
@query("SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS ordinal FROM customer")
def source_ordinals(table):
    customers = table("customer").select("c_custkey")
    path = shared_path(customers.sparkSession, "csv")
    files.write_csv(customers.repartitionByRange(5, "c_custkey").sortWithinPartitions("c_custkey"), path)
    return ordinals.source_ordinals(files.read_csv(customers.sparkSession, path, "c_custkey long"))


@query("""SELECT c_custkey, v FROM (SELECT c_custkey, c_custkey * 7 % 11 AS v, lag(c_custkey * 7 % 11) OVER (ORDER BY c_custkey) AS before FROM customer)
WHERE before > v""")
def steps_back(table):
    customers = table("customer").select("c_custkey", (F.col("c_custkey") * 7 % 11).alias("v"))
    return ordinals.steps_back(customers, "v", F.col("c_custkey"), 500)


# An archive for each nation; customers of one segment are asked for, and the source picks them while it inflates.
@query("""SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, 'N' || c_nationkey AS nation FROM customer WHERE c_mktsegment = 'BUILDING'""")
def archived_segment(table):
    spark = table("customer").sparkSession
    made = table("customer").select("c_custkey", "c_name", "c_mktsegment", F.concat(F.lit("N"), "c_nationkey").alias("nation"))
    written = binary.write_archives(made, shared_path(spark, "archives"), "nation")
    paths = sorted(r.path for r in written.select("path").collect())  # one name an archive
    binary.register(spark)
    rows = spark.read.format("csv_archive").load(",".join(paths))
    return rows.where("c_mktsegment = 'BUILDING'").select("c_custkey", "c_name", "nation")


@query("""SELECT c_nationkey AS region, tolerance, count(*) AS n_areas, count(*) AS n_rings, CAST(sum(points) AS BIGINT) AS n_points, CAST(count(*) AS DOUBLE) AS area
FROM customer, (VALUES (CAST(0.01 AS DOUBLE), 9), (CAST(0.1 AS DOUBLE), 5)) p(tolerance, points) GROUP BY ALL""")
def simplification_sweep(table):
    squares = bulging(table).join(table("customer").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("region")), "k")
    return borders.sweep(squares, "k", "region", [0.01, 0.1])


@query("""WITH o AS (SELECT o_orderkey, CAST(o_orderkey % 1500 AS DOUBLE) AS overlap, CAST(o_orderkey % 7 * 1e8 AS DOUBLE) AS whole FROM orders)
SELECT o_orderkey, CASE WHEN overlap <= greatest(1e-6, whole * 1e-9) THEN 'none' WHEN overlap > 1000 AND (CASE WHEN whole = 0 THEN 0 ELSE overlap / whole END) > 1e-5 THEN 'fatal'
  WHEN overlap <= 100 OR (CASE WHEN whole = 0 THEN 0 ELSE overlap / whole END) <= 1e-7 THEN 'negligible' ELSE 'review' END AS residual,
  CASE WHEN overlap > 500 AND (CASE WHEN whole > 0 THEN overlap / whole ELSE 1e300 END) > 1e-6 THEN 'fatal'
  WHEN overlap <= 10 OR (CASE WHEN whole > 0 THEN overlap / whole ELSE 1e300 END) <= 1e-8 THEN 'negligible' ELSE 'review' END AS change FROM o""")
def overlap_classes(table):
    overlap, union = (F.col("o_orderkey") % 1500).cast("double"), (F.col("o_orderkey") % 7 * 1e8).cast("double")
    residual = partition.residual_overlap_class(overlap, union)
    change = partition.area_change_class(F.lit(0.0), overlap, union, 500.0, 1e-6)
    return table("orders").select("o_orderkey", residual.alias("residual"), change.alias("change"))
