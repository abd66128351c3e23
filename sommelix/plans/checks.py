"""Queries of checks with made faults, and of restaurants by arrondissement."""

from __future__ import annotations

from pyspark.sql import functions as F

from sommelix.operators import arrondissements, evidence
from sommelix.plans.registry import query


# A reference table and statistics made from customers: some keys are missing, repeated or unknown, some names and values wrong.
@query("""WITH r AS (SELECT CAST(c_custkey AS VARCHAR) AS code, c_name AS name FROM customer), s AS (
  SELECT code, CASE WHEN CAST(code AS INT) % 6 = 2 THEN lower(name) ELSE name END AS name, CASE WHEN CAST(code AS INT) % 5 > 0 THEN 1 END AS people FROM r WHERE CAST(code AS INT) % 50 <> 7
  UNION ALL SELECT code, name, 1 FROM r WHERE CAST(code AS INT) % 100 = 3 UNION ALL SELECT 'X' || code, name, 1 FROM r WHERE CAST(code AS INT) % 100 = 4)
SELECT 'statistics: repeated key' AS "check", count(*) AS n, min(code) AS first FROM r WHERE CAST(code AS INT) % 100 = 3
UNION ALL SELECT 'statistics: missing key', count(*), min(code) FROM r WHERE code NOT IN (SELECT code FROM s)
UNION ALL SELECT 'reference: missing key', count(*), min(code) FROM s WHERE code NOT IN (SELECT code FROM r)
UNION ALL SELECT 'reference: differs in name', count(*), min(r.code) FROM r JOIN s USING (code) WHERE r.name <> s.name
UNION ALL SELECT 'statistics: null in people', count(*), min(code) FROM s WHERE people IS NULL
UNION ALL SELECT 'statistics: unknown name', count(*), min(code) FROM s WHERE name NOT IN (SELECT name FROM r)""")
def reference_evidence(table):
    k = F.col("c_custkey")
    base = table("customer").select(k.cast("string").alias("code"), F.col("c_name").alias("name"), k.alias("k"))
    reference = base.select("code", "name")
    name = F.when(F.col("k") % 6 == 2, F.lower("name")).otherwise(F.col("name"))
    people = F.when(F.col("k") % 5 > 0, 1)
    statistics = base.where("k % 50 <> 7").select("code", name.alias("name"), people.alias("people"))
    statistics = statistics.unionByName(base.where("k % 100 = 3").select("code", "name", F.lit(1).alias("people")))
    statistics = statistics.unionByName(base.where("k % 100 = 4").select(F.concat(F.lit("X"), "code").alias("code"), "name", F.lit(1).alias("people")))
    return evidence.together(
        evidence.keys(reference, "code", "reference"),
        evidence.keys(statistics, "code", "statistics"),
        evidence.same_keys({"reference": (reference, "code"), "statistics": (statistics, "code")}),
        evidence.disagreements(reference, statistics, ("code", "code"), {"name": "name"}, "reference"),
        evidence.filled(statistics, ["code", "people"], "code", "statistics"),
        evidence.within(statistics, "name", reference, "name", "code", "statistics"),
    )


# Orders dealt into parts by status; by key some are in two parts, lost, in a wrong one, changed, or of no source.
@query("""WITH o AS (SELECT o_orderkey AS k, o_orderstatus AS s FROM orders)
SELECT 'row in several parts' AS "check", count(*) AS n, CAST(min(CAST(k AS VARCHAR)) AS VARCHAR) AS first FROM o WHERE k % 100 = 1
UNION ALL SELECT 'row lost', count(*), min(CAST(k AS VARCHAR)) FROM o WHERE k % 100 = 2 AND s <> 'P'
UNION ALL SELECT 'row in a wrong part', count(*), min(CAST(k AS VARCHAR)) FROM o WHERE k % 100 = 3
UNION ALL SELECT 'row changed', count(*), min(CAST(k AS VARCHAR)) FROM o WHERE k % 100 = 4 AND s <> 'P'
UNION ALL SELECT 'row of no source', count(*), min(CAST(-k AS VARCHAR)) FROM o WHERE k % 100 = 5""")
def partition_evidence(table):
    orders = table("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    k = F.col("o_orderkey") % 100
    parts = {}
    for name in ("F", "O"):
        own = orders.where((F.col("o_orderstatus") == name) & ~k.isin(1, 2, 3))
        own = own.withColumn("o_totalprice", F.when(k == 4, 0.5).otherwise(F.col("o_totalprice")))
        wrong = orders.where((k == 1) | ((k == 3) & (F.lit(name) == F.when(F.col("o_orderstatus") == "F", "O").otherwise("F"))))
        parts[name] = own.unionByName(wrong)
    parts["O"] = parts["O"].unionByName(orders.where(k == 5).withColumn("o_orderkey", -F.col("o_orderkey")))
    return evidence.partition_of(orders, parts, {n: F.col("o_orderstatus") == n for n in parts}, "o_orderkey")


# Arrondissements by the sizes of parts, each in a department of its first two digits; restaurants are customers.
@query("""WITH a AS (SELECT DISTINCT p_size AS z FROM part),
c AS (SELECT 1 + c_custkey % 45 AS z, c_custkey // 45 % 5 AS s FROM customer)
SELECT lpad(CAST(z AS VARCHAR), 2, '0') || '1' AS code, 'A' || z AS arrondissement, 'D' || lpad(CAST(z AS VARCHAR), 2, '0') AS department,
  count(*) FILTER (s = 0) AS selected, count(*) FILTER (s = 1) AS bib_gourmand, count(*) FILTER (s = 2) AS "1_star", count(*) FILTER (s = 3) AS "2_star",
  count(*) FILTER (s = 4) AS "3_star", count(*) FILTER (s = 2) + 2 * count(*) FILTER (s = 3) + 3 * count(*) FILTER (s = 4) AS total_stars,
  count(*) FILTER (s > 1) AS starred_restaurants FROM a LEFT JOIN c USING (z) GROUP BY z""")
def arrondissement_product(table):
    k, two = F.col("c_custkey"), F.lpad(F.col("p_size").cast("string"), 2, "0")
    stars = F.element_at(F.array(*[F.lit(v) for v in (0.25, 0.5, 1.0, 2.0, 3.0)]), (F.floor(k / 45) % 5 + 1).cast("int"))
    restaurants = table("customer").select(
        k.alias("source_row"), F.concat(F.lit("A"), 1 + k % 45).alias("arrondissement"), stars.alias("stars"), F.lit(48.5).alias("latitude"), F.lit(2.5).alias("longitude")
    )
    sizes = table("part").select("p_size").distinct()
    outlines = sizes.select(F.concat(two, F.lit("1")).alias("code"), F.concat(F.lit("A"), "p_size").alias("arrondissement"))
    departments = sizes.select(two.alias("department_num"), F.concat(F.lit("D"), two).alias("department"), F.lit("C").alias("capital"), F.lit("R").alias("region"))
    made = arrondissements.product(restaurants, outlines, departments)
    return made.select("code", "arrondissement", "department", "selected", "bib_gourmand", "1_star", "2_star", "3_star", "total_stars", "starred_restaurants")


# Outlines in degrees with gaps between them, a department each; customers lie in their middle, beside them, or far away.
@query("""SELECT c_custkey AS source_row, CASE WHEN c_custkey % 7 <> 1 THEN lpad(CAST(10 + c_custkey % 30 AS VARCHAR), 2, '0') || '1' END AS code,
  CASE c_custkey % 7 WHEN 0 THEN 'nearest' WHEN 1 THEN NULL ELSE 'within' END AS how FROM customer""")
def located_restaurants(table):
    k = F.col("c_custkey")
    lon, lat = lambda i: 0.5 * (i % 6), lambda i: 45 + 0.5 * F.floor(i / 6)
    beside, away = F.when(k % 7 == 0, 0.45).otherwise(0.2), F.when(k % 7 == 1, 9.0).otherwise(0.2)
    restaurants = table("customer").select(
        k.alias("source_row"), (lon(k % 30) + beside).alias("longitude"), (lat(k % 30) + away).alias("latitude"), (10 + k % 30).cast("string").alias("department_num")
    )
    places = table("customer").select((k % 30).alias("i")).distinct()
    at = lambda a, b: F.struct((lon(F.col("i")) + a).cast("double").alias("x"), (lat(F.col("i")) + b).cast("double").alias("y"))
    ring = F.array(at(0, 0), at(0.4, 0), at(0.4, 0.4), at(0, 0.4), at(0, 0))
    outlines = places.select(F.concat(10 + F.col("i"), F.lit("1")).alias("code"), F.array(ring).alias("rings"))
    return arrondissements.located(restaurants, outlines)


# Numbers of parts as they stand in a table's cells.
@query("""WITH c AS (SELECT p_partkey, p_size AS v, CASE p_partkey % 4 WHEN 0 THEN p_size || 'th arr.' WHEN 1 THEN ' ' || p_size || ' ' WHEN 2 THEN 'Arrondissement' ELSE 'no. ' || p_size END AS t FROM part)
SELECT v AS arrondissement_number, o AS ordinal, 'P' || p_partkey AS name, o || ' (P' || p_partkey || ')' AS label FROM (SELECT *, CASE WHEN t LIKE '%th arr.' THEN v || 'th'
  WHEN v % 10 = 1 AND v <> 11 THEN v || 'st' WHEN v % 10 = 2 AND v <> 12 THEN v || 'nd' WHEN v % 10 = 3 AND v <> 13 THEN v || 'rd' ELSE v || 'th' END AS o FROM c WHERE p_partkey % 4 <> 2)""")
def ordinal_cells(table):
    k, size = F.col("p_partkey") % 4, F.col("p_size").cast("string")
    text = F.when(k == 0, F.concat(size, F.lit("th arr."))).when(k == 1, F.concat(F.lit(" "), size, F.lit("  "))).when(k == 2, "Arrondissement")
    cells = table("part").select(text.otherwise(F.concat(F.lit("no. "), size)).alias("cell"), F.concat(F.lit(" P"), "p_partkey", F.lit(" ")).alias("place"))
    return arrondissements.ordinal_table(cells, "cell", "place")
