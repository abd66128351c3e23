"""Registered queries of the reference's own operators and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sommelix.functions import geo, text
from sommelix.operators import acceptance, cubes, departments, joins, linkage, quality, rollups, snapshots, spatial
from sommelix.operators.lineage import shared_path
from sommelix.plans import areas, checks, records  # noqa: F401  they register their own
from sommelix.plans.registry import ORACLES, QUERIES  # noqa: F401
from sommelix.plans.registry import query as _query
from sommelix.sources import files

FLAGSHIP = "star_rollup"


# A guide snapshot derived from customers; the SQL twin is _GUIDE.
_LOCATIONS = ("Paris, France", "Monaco, Principality of Monaco", "London, United Kingdom", "Singapore", "Miami, FL, USA")
_AWARDS = ("Selected Restaurants", "Bib Gourmand", "1 Star", "2 Stars", "3 Stars")
_GUIDE = """
guide AS (
  SELECT c_custkey AS k, c_name AS name, c_nationkey,
    CASE c_custkey % 5 WHEN 0 THEN 0.25 WHEN 1 THEN 0.5 WHEN 2 THEN 1.0 WHEN 3 THEN 2.0 ELSE 3.0 END AS stars,
    CASE (c_custkey // 5) % 5 WHEN 0 THEN 'Paris' WHEN 1 THEN 'Monaco' WHEN 2 THEN 'London' WHEN 3 THEN 'Singapore' ELSE 'Miami' END AS city,
    CASE (c_custkey // 5) % 5 WHEN 0 THEN 'France' WHEN 1 THEN 'Principality of Monaco' WHEN 2 THEN 'United Kingdom'
      WHEN 3 THEN 'Singapore' ELSE 'USA' END AS country
  FROM customer
)
"""


def _raw_guide(table) -> DataFrame:
    k = F.col("c_custkey")
    pick = lambda values, i: F.get(F.array(*[F.lit(v) for v in values]), i.cast("int"))
    return table("customer").select(
        k.alias("source_row"), F.col("c_name").alias("Name"), F.lit("1 rue A, Paris, 75001, France").alias("Address"),
        pick(_LOCATIONS, F.floor(k / 5) % 5).alias("Location"), F.lit("$$").alias("Price"), F.lit("Modern").alias("Cuisine"),
        F.lit(None).cast("string").alias("WebsiteUrl"), pick(_AWARDS, k % 5).alias("Award"), (k % 2).cast("int").alias("GreenStar"),
        F.lit(2.35).alias("Longitude"), F.lit(48.86).alias("Latitude"),
    )


@_query(f"""WITH {_GUIDE} SELECT k AS source_row, name, city, country, stars, CASE WHEN city = 'Monaco' THEN 'monaco'
  WHEN country = 'France' THEN 'france' WHEN country = 'United Kingdom' THEN 'uk' END AS "partition" FROM guide""")
def snapshot_partitions(table):
    cleaned = snapshots.snapshot_checks(snapshots.clean(_raw_guide(table), 2026), 2026).frame
    return cleaned.select("source_row", "name", "city", "country", "stars", "partition")


# Some awards are unknown, some coordinates half a pair or out of range.
@_query(f"""WITH {_GUIDE}, f AS (SELECT *, k % 40 = 0 AS half, k % 40 > 0 AND k % 60 = 1 AS far, k % 70 = 3 AS odd,
  CASE WHEN city = 'Monaco' THEN 'monaco' WHEN country = 'France' THEN 'france' WHEN country = 'United Kingdom' THEN 'uk' END AS p FROM guide),
n AS (SELECT 'blank city or country' AS name, 0 AS observed FROM f UNION ALL SELECT 'unknown award', count(*) FILTER (odd) FROM f
  UNION ALL SELECT 'coordinate that is no number', 0 UNION ALL SELECT 'half a coordinate pair', count(*) FILTER (half) FROM f
  UNION ALL SELECT 'coordinate out of range', count(*) FILTER (far) FROM f UNION ALL SELECT 'missing coordinates in france', count(*) FILTER (half AND p = 'france') FROM f
  UNION ALL SELECT 'missing coordinates in monaco', count(*) FILTER (half AND p = 'monaco') FROM f UNION ALL SELECT 'missing coordinates in uk', count(*) FILTER (half AND p = 'uk') FROM f)
SELECT DISTINCT name, observed = 0 AS passed, CAST(observed AS BIGINT) AS observed, CAST(0 AS BIGINT) AS expected FROM n""")
def snapshot_check_report(table):
    k = F.col("source_row")
    raw = _raw_guide(table).withColumns(
        {
            "Award": F.when(k % 70 == 3, "Odd").otherwise(F.col("Award")),
            "Longitude": F.when(k % 40 != 0, F.col("Longitude")),
            "Latitude": F.when((k % 40 != 0) & (k % 60 == 1), 95.0).otherwise(F.col("Latitude")),
        }
    )
    return snapshots.snapshot_checks(snapshots.clean(raw, 2026), 2026).report()


@_query(f"""WITH {_GUIDE}, c AS (
  SELECT r_name, count(*) FILTER (stars = 0.25) AS selected, count(*) FILTER (stars = 0.5) AS bib_gourmand,
    count(*) FILTER (stars = 1) AS "1_star", count(*) FILTER (stars = 2) AS "2_star", count(*) FILTER (stars = 3) AS "3_star",
    count(*) FILTER (k % 2 = 1) AS green_stars
  FROM guide JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name)
SELECT *, "1_star" + 2 * "2_star" + 3 * "3_star" AS total_stars, "1_star" + "2_star" + "3_star" AS starred_restaurants FROM c""")
def star_rollup(table):
    guide = snapshots.clean(_raw_guide(table), 2026).select("source_row", "stars", "greenstar")
    placed = guide.join(table("customer").select(F.col("c_custkey").alias("source_row"), "c_nationkey"), "source_row")
    nations = joins.checked_join(placed, table("nation"), [("c_nationkey", "n_nationkey")], matched="n_name")
    regions = joins.checked_join(nations, table("region"), [("n_regionkey", "r_regionkey")], matched="r_name")
    return rollups.star_counts(regions, ["r_name"])


@_query("""SELECT n_name, round(sum(c_acctbal * c_custkey) / sum(c_custkey), 4) AS c_acctbal
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def weighted_means(table):
    placed = joins.checked_join(table("customer"), table("nation"), [("c_nationkey", "n_nationkey")])
    return rollups.weighted_means(placed, ["n_name"], "c_custkey", ["c_acctbal"]).withColumn("c_acctbal", F.round("c_acctbal", 4))


@_query("""SELECT n_nationkey, n_name, coalesce(n, 0) AS n FROM nation LEFT JOIN
(SELECT c_nationkey, count(*) AS n FROM customer WHERE c_acctbal > 9900 GROUP BY c_nationkey) ON n_nationkey = c_nationkey""")
def zero_filled_counts(table):
    counts = table("customer").where("c_acctbal > 9900").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    return joins.zero_filled(table("nation").select("n_nationkey", "n_name"), counts, [("n_nationkey", "c_nationkey")], ["n"])


@_query("""SELECT user_id, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS events FROM events GROUP BY user_id""")
def ordered_lists(table):
    lists = rollups.ordered_lists(table("events"), ["user_id"], "event_id", ["event_id"], "found")
    return lists.select("user_id", F.array_join(F.transform("found", lambda e: e["event_id"].cast("string")), ",").alias("events"))


@_query("""SELECT o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1""")
def largest_order(table):
    orders = table("orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return joins.first_by(orders, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")])


@_query("""SELECT o_custkey, o_orderkey FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 3""")
def three_largest_orders(table):
    orders = table("orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return joins.first_by(orders, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3).drop("o_totalprice")


@_query("""SELECT o_custkey, count(*) FILTER (o_orderstatus = 'P') AS "P", count(*) FILTER (o_orderstatus = 'F') AS "F",
count(*) FILTER (o_orderstatus = 'O') AS "O" FROM orders GROUP BY o_custkey""")
def pivot_statuses(table):
    return cubes.pivot_counts(table("orders"), "o_custkey", "o_orderstatus", ["P", "F", "O"])


@_query("""SELECT o_custkey, count(*) FILTER (o_orderstatus = 'P') AS "P", count(*) FILTER (o_orderstatus = 'F') AS "F"
FROM orders WHERE o_orderstatus IN ('P', 'F') GROUP BY o_custkey HAVING count(DISTINCT o_orderstatus) = 2""")
def pivot_cells(table):
    cells = cubes.cube_slice(table("orders"), {"o_orderstatus": ["P", "F"]}).groupBy("o_custkey", "o_orderstatus").count()
    whole = cells.groupBy("o_custkey").count().where("count = 2").select("o_custkey")
    return cubes.pivoted(cells.join(whole, "o_custkey", "left_semi"), "o_custkey", "o_orderstatus", "count", ["P", "F"])


def _two_years(table) -> tuple[DataFrame, DataFrame]:
    """Customers as two yearly tables: every seventh leaves, every eleventh is renamed, every thirteenth moves;
    every tenth has the address on the web of the one before."""
    k = F.col("c_custkey")
    base = table("customer").select(
        k.alias("source_row"), F.concat(F.lit("Chez "), "c_name").alias("name"),
        F.concat(k.cast("string"), F.lit(" rue A, Ville, 75001, France")).alias("address"),
        F.lit("Ville, 75001").alias("location"),  # house numbers of five digits are no postcodes
        F.concat(F.lit("https://www.example.org/"), (k - F.when(k % 10 == 0, 1).otherwise(0)).cast("string"), F.lit("/")).alias("url"),
        F.get(F.array(*[F.lit(x) for x in (0.25, 0.5, 1.0, 2.0, 3.0)]), (k % 5).cast("int")).alias("stars"),
        F.lit("1 Star").alias("award"), (k % 2).cast("double").alias("greenstar"),
        (45 + (k % 1000) / 500).alias("latitude"), (2 + F.floor(k / 1000) / 50).alias("longitude"),
    )
    current = base.where("source_row % 7 <> 0").withColumns(
        {
            "name": F.when(F.col("source_row") % 11 == 0, F.concat("name", F.lit(" bis"))).otherwise(F.col("name")),
            "address": F.when(F.col("source_row") % 13 == 0, F.concat(F.lit("9"), "address")).otherwise(F.col("address")),
            "stars": F.when(F.col("source_row") % 17 == 0, F.least(F.col("stars") + 1, F.lit(3.0))).otherwise(F.col("stars")),
        }
    )
    return base, current


@_query("""WITH p AS (SELECT c_custkey - CASE c_custkey % 10 WHEN 0 THEN 1 ELSE 0 END AS u, min(c_custkey) AS k FROM customer GROUP BY 1 HAVING count(*) = 1),
c AS (SELECT c_custkey - CASE c_custkey % 10 WHEN 0 THEN 1 ELSE 0 END AS u, min(c_custkey) AS k FROM customer WHERE c_custkey % 7 <> 0 GROUP BY 1 HAVING count(*) = 1)
SELECT p.k AS previous_row, c.k AS current_row FROM p JOIN c USING (u)""")
def unique_key_match(table):
    a, b = _two_years(table)
    return joins.unique_match(a, b, ["url"])


def _waterfall_sql() -> str:
    """The tiers one after the other, each among the rows that no tier before has matched; equal keys of the fixture are equal
    texts, and rows with one name lie in one place, so the tier of near names finds nothing."""
    tiers = [
        ("exact_url_postal", "normalized_url+postal_code", "u"), ("exact_url", "normalized_url", "u"), ("exact_name_postal", "normalized_name+postal_code", "n"),
        ("exact_address_postal", "normalized_address+postal_code", "ad"), ("exact_address", "normalized_address", "ad"),
        ("exact_name_coordinates", "normalized_name+latitude+longitude", "n, k"),
    ]
    sql = """WITH p AS (SELECT c_custkey AS k, c_custkey - CASE c_custkey % 10 WHEN 0 THEN 1 ELSE 0 END AS u, c_name AS n, c_custkey || ' rue A' AS ad FROM customer),
c AS (SELECT k, u, n || CASE WHEN k % 11 = 0 THEN ' bis' ELSE '' END AS n, CASE WHEN k % 13 = 0 THEN '9' ELSE '' END || ad AS ad FROM p WHERE k % 7 <> 0),
m0 AS (SELECT 0 AS previous_row, 0 AS current_row, '' AS method, '' AS evidence WHERE FALSE)"""
    for i, (method, evidence, keys) in enumerate(tiers):
        one = lambda t, side: f"(SELECT {keys}, min(k) AS {side} FROM {t} WHERE k NOT IN (SELECT {side} FROM m{i}) GROUP BY {keys} HAVING count(*) = 1)"  # noqa: B023, E731
        sql += f""", m{i + 1} AS (SELECT * FROM m{i} UNION ALL SELECT previous_row, current_row, '{method}', '{evidence}'
  FROM {one("p", "previous_row")} JOIN {one("c", "current_row")} USING ({keys}))"""
    return sql + " SELECT previous_row, current_row, method, CAST(1 AS DOUBLE) AS confidence, evidence FROM m6"


@_query(_waterfall_sql())
def match_waterfall(table):
    a, b = _two_years(table)
    return linkage.link(linkage.prepare(a), linkage.prepare(b)).matches


@_query()
def yearly_changes(table):
    a, b = _two_years(table)
    return linkage.compare(a, b, 2025, 2026)


@_query("""WITH s AS (SELECT c_custkey AS k, CASE c_custkey % 5 WHEN 0 THEN 0.25 WHEN 1 THEN 0.5 WHEN 2 THEN 1.0 WHEN 3 THEN 2.0 ELSE 3.0 END AS o FROM customer
WHERE c_custkey % 7 <> 0), t AS (SELECT *, CASE WHEN k % 17 = 0 THEN least(o + 1, 3.0) ELSE o END AS n FROM s),
x AS (SELECT *, CASE WHEN o >= 1 THEN 's' ELSE CAST(o AS VARCHAR) END <> CASE WHEN n >= 1 THEN 's' WHEN n IN (0.25, 0.5) THEN CAST(n AS VARCHAR) ELSE 'x' END AS d FROM t),
l AS (SELECT k, concat_ws('|', CASE WHEN o < 1 AND n >= 1 THEN 'newly_starred' END,
  CASE WHEN (o < 1 AND n >= 1) OR (o >= 1 AND n > o) THEN 'promoted' END, CASE WHEN o >= 1 AND n < o THEN 'demoted' END,
  CASE WHEN d THEN 'classification_changed' END, CASE WHEN k % 11 = 0 THEN 'renamed' END, CASE WHEN k % 13 = 0 THEN 'relocated' END) AS c FROM x)
SELECT k AS source_row, CASE WHEN c = '' THEN 'unchanged' ELSE c END AS labels FROM l""")
def change_labels(table):
    a, b = (linkage.prepare(f) for f in _two_years(table))
    names = ["stars", "greenstar", "normalized_name", "normalized_address", "postal_code"]
    side = lambda f, p: f.select("source_row", *[F.col(n).alias(f"{p}_{n}") for n in names])
    both = side(a, "previous").join(side(b, "current"), "source_row")
    return both.select("source_row", F.array_join(linkage.change_labels(), "|").alias("labels"))


@_query("""SELECT coalesce(a.k, b.k) AS key, a_name, b_name FROM (SELECT n_nationkey AS k, n_name AS a_name FROM nation) a
FULL JOIN (SELECT n_nationkey + 2 AS k, 'NATION_' || (n_nationkey + 2 + n_nationkey % 2) AS b_name FROM nation) b ON a.k = b.k
WHERE a.k IS NULL OR b.k IS NULL OR a_name IS DISTINCT FROM b_name""")
def reconciled_names(table):
    a = table("nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("a"))
    k = F.col("n_nationkey")
    b = table("nation").select((k + 2).alias("key"), F.concat(F.lit("NATION_"), (k + 2 + k % 2).cast("string")).alias("b"))
    return joins.reconcile(a, b, "key", ("a", "b"))


@_query("""SELECT lang, source, md5(text) AS text_md5, count(*) AS "count" FROM documents GROUP BY ALL HAVING count(*) > 1""")
def exact_duplicates(table):
    return quality.exact_duplicates(table("documents").select("lang", "source", F.md5(F.col("text").cast("binary")).alias("text_md5")))


@_query("""SELECT unnest(['doc_id', 'quality', 'toxic']) AS "column", unnest([count(*) FILTER (doc_id IS NULL),
count(*) FILTER (nullif(quality, 0) IS NULL), count(*) FILTER (nullif(toxic, 1) IS NULL)]) AS nulls FROM labels""")
def null_profile(table):
    return quality.null_profile(table("labels").selectExpr("doc_id", "nullif(quality, 0) AS quality", "nullif(toxic, 1) AS toxic"))


@_query("SELECT event_type AS value, count(*) AS n FROM events GROUP BY event_type")
def value_counts(table):
    return quality.value_counts(table("events"), "event_type")


@_query("""(SELECT n_regionkey FROM nation WHERE n_nationkey < 15 EXCEPT ALL SELECT n_regionkey FROM nation WHERE n_nationkey > 7)
UNION ALL (SELECT n_regionkey FROM nation WHERE n_nationkey > 7 EXCEPT ALL SELECT n_regionkey FROM nation WHERE n_nationkey < 15)""")
def symmetric_difference(table):
    keys = table("nation").select("n_nationkey", "n_regionkey")
    return quality.symmetric_difference(keys.where("n_nationkey < 15").drop("n_nationkey"), keys.where("n_nationkey > 7").drop("n_nationkey"))


@_query("SELECT c_custkey, trim(regexp_replace(lower(c_name), '[^a-z0-9]+', ' ', 'g')) AS plain FROM customer")
def normalized_names(table):
    return table("customer").select("c_custkey", text.normalized_text("c_name").alias("plain"))


@_query(r"""SELECT page_id, lower(regexp_extract(url, '^([A-Za-z]+)://([^/?#]*)([^?#]*)', 1)) || '://' ||
regexp_replace(lower(regexp_extract(url, '^([A-Za-z]+)://([^/?#]*)([^?#]*)', 2)), '^www\.', '') ||
rtrim(regexp_extract(url, '^([A-Za-z]+)://([^/?#]*)([^?#]*)', 3), '/') AS plain FROM pages""")
def normalized_urls(table):
    return table("pages").select("page_id", text.normalized_url("url").alias("plain"))


@_query("""WITH p AS (SELECT c_custkey, lpad(CAST(c_custkey * 37 % 100000 AS VARCHAR), 5, '0') AS code FROM customer)
SELECT c_custkey, code, CASE WHEN left(code, 3) IN ('200', '201') THEN '2A' WHEN left(code, 3) = '202' THEN '2B' ELSE left(code, 2) END AS department FROM p""")
def department_codes(table):
    digits = F.lpad((F.col("c_custkey") * 37 % 100000).cast("string"), 5, "0")
    code = text.postal_code(F.concat(F.lit("12 rue, Ville, "), digits, F.lit(", France")))
    return table("customer").select("c_custkey", code.alias("code")).withColumn("department", text.department_code(F.col("code")))


@_query("""SELECT c_custkey, CAST(CASE WHEN c_custkey % 25 = 24 THEN 16 WHEN c_custkey % 25 > 20 THEN NULL WHEN c_custkey % 25 = 0 THEN 20
ELSE c_custkey % 25 END AS INTEGER) AS arrondissement FROM customer""")
def paris_arrondissements(table):
    n = F.col("c_custkey") % 25
    place = F.when(n == 24, "Paris, 75116").when(n > 20, "Lyon, 69001").otherwise(F.concat(F.lit("Paris, 750"), F.lpad(n.cast("string"), 2, "0")))
    return table("customer").select("c_custkey", text.paris_arrondissement(place).alias("arrondissement"))


@_query("SELECT p_partkey, split_part(p_name, ' ou ', 1) AS display_name FROM part")
def display_names(table):
    app = F.concat(F.lit("Alsace grand cru "), "p_name", F.lit(" ou Alias"))
    return table("part").select("p_partkey", text.display_name(app).alias("display_name"))


def _points(table) -> DataFrame:
    at = lambda i: F.col("embedding")[i].cast("double")
    return table("embeddings").select("vec_id", at(0).alias("a"), at(1).alias("b"), at(2).alias("c"), at(3).alias("d"))


_POINTS = "p AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS a, CAST(embedding[2] AS DOUBLE) AS b, CAST(embedding[3] AS DOUBLE) AS c, CAST(embedding[4] AS DOUBLE) AS d FROM embeddings)"


@_query(f"""WITH {_POINTS}, v AS (SELECT vec_id, pow(sin((radians(46 + d) - radians(46 + b)) / 2), 2)
  + cos(radians(46 + b)) * cos(radians(46 + d)) * pow(sin(radians(c - a) / 2), 2) AS v FROM p)
SELECT vec_id, round(2 * 6371.0 * atan2(sqrt(v), sqrt(1 - v)), 6) AS km FROM v""")
def haversine_pairs(table):
    km = geo.haversine_km(46 + F.col("b"), F.col("a"), 46 + F.col("d"), F.col("c"))
    return _points(table).select("vec_id", F.round(km, 6).alias("km"))


@_query(f"""WITH {_POINTS}, s AS (SELECT vec_id, radians(46 + b) AS f, {geo._E!r} * sin(radians(46 + b)) AS s, {geo.CONE!r} * (radians(3 + a) - {geo._LAMBDA0!r}) AS g FROM p),
r AS (SELECT vec_id, g, {geo.SCALE!r} * pow(tan(pi() / 4 - f / 2) / pow((1 - s) / (1 + s), {geo._E / 2!r}), {geo.CONE!r}) AS r FROM s)
SELECT vec_id, round(700000 + r * sin(g), 3) AS x, round(6600000 + {geo.RADIUS0!r} - r * cos(g), 3) AS y FROM r""")
def lambert93_points(table):
    made = _points(table).select("vec_id", geo.lambert93(3 + F.col("a"), 46 + F.col("b")).alias("p"))
    return made.select("vec_id", F.round("p.x", 3).alias("x"), F.round("p.y", 3).alias("y"))


@_query(f"""WITH {_POINTS}, q AS (SELECT vec_id, 20 * a AS x, 20 * b AS y, 1.0 + vec_id % 7 AS w, 1.0 + vec_id % 5 AS h FROM p)
SELECT vec_id, round(CAST(w * h AS DOUBLE), 9) AS area, x > 0 AND x < w AND y > 0 AND y < h AS inside,
  round(sqrt(pow(greatest(0, -x, x - w), 2) + pow(greatest(0, -y, y - h), 2)), 6) AS distance FROM q""")
def rings(table):
    w, h = 1.0 + F.col("vec_id") % 7, 1.0 + F.col("vec_id") % 5
    corners = [(F.lit(0.0), F.lit(0.0)), (w, F.lit(0.0)), (w, h), (F.lit(0.0), h), (F.lit(0.0), F.lit(0.0))]
    ring = F.array(*[F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")) for x, y in corners])
    made = _points(table).select("vec_id", ring.alias("ring"), (20 * F.col("a")).alias("x"), (20 * F.col("b")).alias("y"))
    return made.select(
        "vec_id",
        F.round(geo.ring_area("ring"), 9).alias("area"),
        geo.within("ring", "x", "y").alias("inside"),
        F.round(geo.distance_to_ring("ring", "x", "y"), 6).alias("distance"),
    )


# 25 squares of side 3, each with a square hole of side 1, one unit apart; points reach 0.3 across a border.
@_query(f"""WITH {_POINTS}, q AS (SELECT vec_id, 40 * a AS x, 40 * b AS y FROM p),
n AS (SELECT n_nationkey AS code, 4 * (n_nationkey % 5) - 10 AS x0, 4 * (n_nationkey // 5) - 10 AS y0 FROM nation),
r AS (SELECT vec_id, code, x - x0 AS u, y - y0 AS v FROM q, n),
d AS (SELECT vec_id, code, u > 0 AND u < 3 AND v > 0 AND v < 3 AND NOT (u BETWEEN 1 AND 2 AND v BETWEEN 1 AND 2) AS w,
  CASE WHEN u BETWEEN 1 AND 2 AND v BETWEEN 1 AND 2 THEN least(u - 1, 2 - u, v - 1, 2 - v)
    ELSE sqrt(pow(greatest(0, -u, u - 3), 2) + pow(greatest(0, -v, v - 3), 2)) END AS m FROM r),
f AS (SELECT vec_id, min(code) FILTER (w) AS i, min(code) FILTER (NOT w AND m <= 0.3) AS n FROM d GROUP BY vec_id)
SELECT vec_id AS id, coalesce(i, n) AS code, CASE WHEN i IS NOT NULL THEN 'within' WHEN n IS NOT NULL THEN 'nearest' END AS how FROM f""")
def area_assignment(table):
    x, y = 4 * (F.col("n_nationkey") % 5) - 10, 4 * F.floor(F.col("n_nationkey") / 5) - 10

    def square(low: float, high: float):
        corners = [(low, low), (high, low), (high, high), (low, high), (low, low)]
        return F.array(*[F.struct((x + a).cast("double").alias("x"), (y + b).cast("double").alias("y")) for a, b in corners])

    areas = table("nation").select(F.col("n_nationkey").alias("code"), F.array(square(0.0, 3.0), square(1.0, 2.0)).alias("rings"))
    points = _points(table).select(F.col("vec_id").alias("id"), (40 * F.col("a")).alias("x"), (40 * F.col("b")).alias("y"))
    return spatial.assign_areas(points, areas, 0.3, 4.0)


# Customers written as CSV with quotes, separators and line breaks inside a field, read again and compared before it is returned.
@_query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'say "' || c_name || '",' || chr(10) || 'twice' END AS note, c_acctbal
FROM customer""")
def csv_round_trip(table):
    note = F.when(F.col("c_custkey") % 3 != 0, F.concat(F.lit('say "'), "c_name", F.lit('",\ntwice')))
    frame = table("customer").select("c_custkey", note.alias("note"), "c_acctbal")
    path = shared_path(frame.sparkSession, "csv")
    read = lambda: files.read_csv(frame.sparkSession, path, "c_custkey long, note string, c_acctbal double", line_breaks=True)
    return files.verified(frame, lambda f: files.write_csv(f, path), read)


@_query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, printf('%.17f', c_custkey / 8.0) AS eighths FROM customer")
def fixed_precision_csv(table):
    frame = table("customer").select("c_custkey", (F.col("c_custkey") / 8.0).cast("double").alias("eighths"))
    path = shared_path(frame.sparkSession, "csv")
    files.write_csv(frame, path, decimals=17)
    return files.read_text_csv(frame.sparkSession, path)


# Each customer's key places a square; its ring is read back from the GeoJSON.
@_query("""SELECT c_custkey AS code, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_name END AS name, 5 AS points,
  (c_custkey % 100) / 4 AS west, (c_custkey % 100) / 4 + 0.5 AS east FROM customer""")
def geojson_round_trip(table):
    x = ((F.col("c_custkey") % 100) / 4).cast("double")
    corner = lambda dx, dy: F.array(x + F.lit(dx), F.lit(dy))
    ring = F.array(*[corner(dx, dy) for dx, dy in ((0.0, 0.0), (0.5, 0.0), (0.5, 0.5), (0.0, 0.5), (0.0, 0.0))])
    name = F.when(F.col("c_custkey") % 4 != 0, F.col("c_name"))
    frame = table("customer").select(F.col("c_custkey").alias("code"), name.alias("name"), F.array(ring).alias("rings"))
    path = shared_path(frame.sparkSession, "geojson")
    files.write_geojson(frame, path, "Polygon", "rings")
    read = files.read_geojson(frame.sparkSession, path, "code: bigint, name: string")
    ring = files.polygons(F.col("geometry"))[0][0]
    east, west = (f(F.transform(ring, lambda p: p[0])) for f in (F.array_max, F.array_min))
    return read.select("code", "name", F.size(ring).alias("points"), west.alias("west"), east.alias("east"))


def _regions(table) -> DataFrame:
    """Nations as departments, their number as code."""
    return table("nation").select(
        F.col("n_nationkey").cast("string").alias("department_code"), F.col("n_name").alias("department_name"),
        (F.col("n_nationkey") + 10.0).cast("double").alias("area_sq_km"),
    )


def _observed(table, measure: str, values: dict, more: dict) -> DataFrame:
    """A long table of text observations by nation, two years each, from counts of customers."""
    cells = F.create_map(*[x for code, v in values.items() for x in (F.lit(code), v)])
    by = table("customer").groupBy("c_nationkey").agg(F.count("*").alias("n"), F.count_if(F.col("c_acctbal") < 0).alias("low"))
    counted = table("nation").join(by, F.col("n_nationkey") == F.col("c_nationkey"), "left").na.fill(0, ["n", "low"])
    long = counted.select(F.col("n_nationkey").cast("string").alias("GEO"), F.explode(cells).alias(measure, "v"))
    years = long.withColumn("TIME_PERIOD", F.explode(F.array(F.lit("2021"), F.lit("2022"))))
    value = F.when(F.col("TIME_PERIOD") == "2022", F.col("v")).otherwise(-1).cast("string")
    made = years.withColumns({"OBS_VALUE": value} | {k: F.lit(v) for k, v in more.items()}).drop("v")
    return made.unionByName(made.where("GEO = '1'").withColumn("GEO", F.lit("ABROAD")))


@_query("""WITH c AS (SELECT n_nationkey AS k, n_name, count(c_custkey) AS n, count(*) FILTER (c_acctbal < 0) AS low FROM nation
LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL)
SELECT CAST(k AS VARCHAR) AS department_code, n_name AS department_name, CAST(k + 10.0 AS DOUBLE) AS area_sq_km, CAST(n AS DOUBLE) AS municipal_population,
  CAST(low AS DOUBLE) AS population_counted_separately, CAST(n + low AS DOUBLE) AS total_population,
  CAST(n + 1 - low AS DOUBLE) AS employed_population_15_64, CAST(low AS DOUBLE) AS unemployed_population_15_64,
  CAST(n + 1 AS DOUBLE) AS active_population_15_64, CAST(low AS DOUBLE) / (n + 1) * 100 AS census_unemployment_rate_15_64_percent,
  CAST(n + 1500 AS DOUBLE) AS median_living_standard_eur, CAST(low AS DOUBLE) AS poverty_rate_percent,
  CAST(n + 1200 AS DOUBLE) AS average_net_monthly_wage_fte_eur, 2022 AS reference_year, CAST(n AS DOUBLE) / (k + 10.0) AS population_density_per_sq_km FROM c""")
def department_statistics(table):
    regions, n, low = _regions(table), F.col("n"), F.col("low")
    base = {"GEO_OBJECT": "DEP", "FREQ": "A"}
    population = _observed(table, "POPREF_MEASURE", {"PMUN": n, "PCAP": low, "PTOT": n + low}, base)
    jobs = _observed(table, "EMPSTA_ENQ", {"1": n + 1 - low, "2": low, "1T2": n + 1}, base | {"PCS": "_T", "AGE": "Y15T64"})
    income = _observed(table, "FILOSOFI_MEASURE", {"MED_SL": n + 1500, "PR_MD60": low}, base)
    wages = _observed(table, "DERA_MEASURE", {"SALAIRE_NET_EQTP_MENSUEL_MOYENNE": n + 1200}, base | {"SEX": "_T", "AGE": "_T", "CONF_STATUS": "F"})
    made = [
        departments.measured(population, departments.POPULATION, 2022, regions, "population"),
        departments.employment(jobs, 2022, regions),
        departments.measured(income, departments.LIVING_STANDARD, 2022, regions, "living standard"),
        departments.measured(income, departments.POVERTY, 2022, regions, "poverty"),
        departments.measured(wages, departments.WAGES, 2022, regions, "wages"),
    ]
    return departments.assembled(2022, regions, made)


# Every row keeps its key and address, so all are matched; every 17th changes its award, every 11th its name.
_CHANGES = """WITH s AS (SELECT c_custkey AS k, c_custkey % 5 AS a, (c_custkey + CASE WHEN c_custkey % 17 = 0 THEN 1 ELSE 0 END) % 5 AS b FROM customer)"""
_NAMES = "CASE {} WHEN 0 THEN 'Selected Restaurants' WHEN 1 THEN 'Bib Gourmand' WHEN 2 THEN '1 Star' WHEN 3 THEN '2 Stars' ELSE '3 Stars' END"


def _award_years(table) -> tuple[DataFrame, DataFrame, DataFrame]:
    k = F.col("c_custkey")
    award = lambda i: F.get(F.array(*[F.lit(a) for a in _AWARDS]), (i % 5).cast("int"))
    base = table("customer").select(k.alias("source_row"), F.col("c_name").alias("name"), award(k).alias("award"), (k % 5).alias("stars"))
    row, moved = F.col("source_row"), F.col("source_row") + F.when(F.col("source_row") % 17 == 0, 1).otherwise(0)
    name = F.when(row % 11 == 0, F.concat("name", F.lit(" bis"))).otherwise(F.col("name"))
    current = base.withColumns({"award": award(moved), "stars": moved % 5, "name": name})
    return base, current, base.select(row.alias("previous_row"), row.alias("current_row"))


@_query(f"""{_CHANGES} SELECT {_NAMES.format("a")} || ' -> ' || {_NAMES.format("b")} AS transition, count(*) AS n FROM s WHERE a <> b GROUP BY 1""")
def award_transitions(table):
    return acceptance.transitions(acceptance.matched_changes(*_award_years(table)))


@_query("""SELECT c_custkey AS source_row, CASE WHEN c_custkey % 17 = 0 THEN 'award' WHEN c_custkey % 11 = 0 THEN 'descriptive' ELSE 'none' END AS change
FROM customer""")
def matched_changes(table):
    return acceptance.matched_changes(*_award_years(table)).select(F.col("previous_row").alias("source_row"), "change")
