"""Every query of the reference's operators against its SQL twin, and the reference's own small cases."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from sommelix.functions import text
from sommelix.operators import cubes, joins, linkage, rollups, snapshots
from sommelix.operators.quality import QualityError
from sommelix.plans import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, duck, name):
    out = catalog.QUERIES[name](spark, DATA)
    columns = sorted(out.columns)
    rows = sorted((tuple(r[c] for c in columns) for r in out.collect()), key=repr)
    if name in catalog.ORACLES:
        got = duck.execute(catalog.ORACLES[name])
        names = [d[0] for d in got.description]
        assert sorted(names) == columns
        wanted = [tuple(r[names.index(c)] for c in columns) for r in got.fetchall()]
        norm = lambda rows: sorted((tuple(float(x) if type(x).__name__ in ("float", "Decimal") else x for x in r) for r in rows), key=repr)
        assert norm(rows) == norm(wanted)
    else:
        assert rows


RAW = "Name string, Address string, Location string, Price string, Cuisine string, WebsiteUrl string, Award string, GreenStar int, Longitude double, Latitude double"


def test_snapshot_cleaning(spark):
    rows = [
        ("Le Moulin", "3 quai Nord", "Annecy, France", "€€", "Alpine", "https://moulin.example", "1 Star", 0, 6.13, 45.9),
        ("Rocher", "8 place Haute", "Monaco, Principality of Monaco", "€€€", "Fish", None, "Selected Restaurants", 0, 7.42, 43.73),
        ("Casino", "1 place Basse", "Monte-Carlo, Principality of Monaco", "€€€", "Fish", None, "2 Stars", 0, 7.43, 43.74),
        ("Port", "2 quai Sud", "Monaco, France", "€€", "Fish", None, "1 Star", 0, 7.41, 43.73),
        ("Heron", "12 Mill Lane", "Norwich, United Kingdom", "££", "British", "https://heron.example", "Bib Gourmand", 1, 1.3, 52.63),
        ("Lake House", "5 Shore Road", "Duluth, MN, USA", "$$", "Nordic", "https://lake.example", "2 Stars", 0, -92.1, 46.79),
        ("Orchid", "9 Garden Walk", "Singapore", "$$$", "Malay", "https://orchid.example", "3 Stars", 0, 103.8, 1.3),
    ]
    raw = spark.createDataFrame(rows, RAW)
    cleaned = snapshots.clean(raw, 2026)
    got = {r["name"]: (r["city"], r["country"], r["stars"]) for r in cleaned.collect()}
    assert got["Lake House"] == ("Duluth", "USA", 2.0) and got["Orchid"] == ("Singapore", "Singapore", 3.0)
    parts = {p: sorted(r["name"] for r in f.collect()) for p, f in snapshots.partitions(cleaned, 2026).items()}
    assert parts == {"france": ["Le Moulin"], "monaco": ["Casino", "Rocher"], "uk": ["Heron"]}
    before = snapshots.partitioned(cleaned.drop("greenstar"), 2024).where("name = 'Port'").first()
    assert before["partition"] == "monaco"
    snapshots.snapshot_checks(cleaned, 2026, 7).require()
    for bad in ({"Award": "Five Hats"}, {"Location": "Unmapped place"}, {"Longitude": 200.0}):
        broken = spark.createDataFrame([tuple(bad.get(c.split()[0], v) for c, v in zip(RAW.split(", "), rows[0]))], RAW)
        with pytest.raises(QualityError):
            snapshots.snapshot_checks(snapshots.clean(broken, 2026), 2026).require()
    with pytest.raises(QualityError):
        snapshots.clean(raw.drop("Award"), 2026)


def test_enriched_addresses(spark):
    part = spark.createDataFrame(
        [(1, "Bistrot", "4 rue\u00a0Verte, Lyon, 69004,\u00a0France"), (2, "Maquis", "7 cours Bas, Sartene, 20100, France"), (3, "Cap", "2 rue Haute, Calvi, 20260, France")],
        "source_row int, name string, address string",
    )
    departments = spark.createDataFrame([("69", "Rhone", "Lyon", "ARA"), ("2A", "Corse-du-Sud", "Ajaccio", "Corse"), ("2B", "Haute-Corse", "Bastia", "Corse")], "department_num string, department string, capital string, region string")
    got = {r["source_row"]: (r["department_num"], r["location"]) for r in rollups.enrich_restaurants(part, departments).collect()}
    assert got == {1: ("69", "Lyon, 69004"), 2: ("2A", "Sartene, 20100"), 3: ("2B", "Calvi, 20260")}
    with pytest.raises(QualityError):
        rollups.enrich_restaurants(part.where("source_row = 1"), departments.where("department_num = '2A'"))


def test_ambiguous_names_are_only_candidates(spark):
    schema = "source_row int, name string, address string, url string, stars double, latitude double, longitude double"
    a = spark.createDataFrame([(4, "Table de Lise", "6 rue Neuve, Lyon, 69002, France", None, 1.0, 45.76, 4.83)], schema)
    b = spark.createDataFrame([(11, "Table de Lise Lyon", "9 rue Vieille, Lyon, 69002, France", None, 1.0, 45.76, 4.83)], schema)
    found = linkage.link(linkage.prepare(a), linkage.prepare(b))
    assert found.matches.count() == 0 and found.candidates.count() == 1
    records = linkage.compare(a, b, 2025, 2026)
    linkage.check_accounting(records, 1, 1)
    with pytest.raises(QualityError):
        linkage.compare(a, b, 2023, 2025)


def test_candidates_of_a_crowded_postcode(spark, monkeypatch):
    """Names are compared once however many rows have them, and the candidates are those of all pairs."""
    rnd = random.Random(5)
    schema = "source_row int, name string, address string, stars double, latitude double, longitude double"
    made = lambda n: spark.createDataFrame([(k, "".join(rnd.choice("abc ") for _ in range(rnd.randint(4, 9))), f"{rnd.randint(0, 99)} rue, Lyon, 6900{k % 2}, France", 1.0, 45.0 + rnd.random(), 4.0 + rnd.random()) for k in range(n)], schema)
    a, b = (linkage.prepare(made(n).union(made(n))).localCheckpoint() for n in (60, 40))
    a, b = (f.withColumn("source_row", F.monotonically_increasing_id()).localCheckpoint() for f in (a, b))
    shown = lambda: sorted(map(tuple, linkage.fuzzy_candidates(a, b).collect()))
    monkeypatch.setattr(linkage, "DIRECT", 10**9)
    wanted = shown()
    assert len(wanted) > 60
    for size in (65536, 16):
        monkeypatch.setattr(linkage, "DIRECT", 4)
        monkeypatch.setattr(linkage, "NAMES_PREVIOUS", size)
        monkeypatch.setattr(linkage, "NAMES_CURRENT", size)
        assert shown() == wanted
    rows = [(k, f"Chez {k % 7}", "1 rue, Lyon, 69001, France", 1.0, 45.0 + k, 4.0) for k in range(3000)]
    a = linkage._sided(linkage.prepare(spark.createDataFrame(rows[:1500], schema)), "p", ["source_row", "normalized_name", "normalized_address", "postal_code"])
    b = linkage._sided(linkage.prepare(spark.createDataFrame([(k + 9000, f"Chez un {k}", *r[2:]) for k, r in enumerate(rows[:20])], schema)), "c", ["source_row", "normalized_name", "normalized_address", "postal_code"])
    assert linkage._same_block(a, b, 3).count() < 20 * 1500


def test_house_numbers_of_five_digits_are_no_postcodes(spark, duck, tmp_path):
    duck.execute(f"COPY (SELECT * REPLACE (c_custkey + 9990 AS c_custkey) FROM customer) TO '{tmp_path}/customer.parquet' (FORMAT parquet)")
    duck.execute(f"CREATE TEMP VIEW customer AS SELECT * FROM read_parquet('{tmp_path}/customer.parquet')")
    wanted = duck.execute(catalog.ORACLES["match_waterfall"]).fetchall()
    duck.execute("DROP VIEW temp.customer")
    got = catalog.QUERIES["match_waterfall"](spark, str(tmp_path)).select("previous_row", "current_row", "method", "confidence", "evidence")
    assert sorted(map(tuple, got.collect())) == sorted(wanted)


def test_cubes_fail_closed(spark):
    cube = spark.createDataFrame([("01", "a", 70), ("01", "b", 20), ("01", "t", 100)], "geo string, m string, v int")
    wide = cubes.pivoted(cube, "geo", "m", "v", ["a", "b", "t"])
    with pytest.raises(QualityError):
        cubes.require_components(wide, ["a", "b"], "t", 0.01)
    with pytest.raises(QualityError):
        cubes.pivoted(cube.union(cube), "geo", "m", "v", ["a", "b", "t"])
    with pytest.raises(QualityError):
        cubes.pivoted(cube, "geo", "m", "v", ["a", "x"])


def test_joins_check_their_cardinality(spark):
    left = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    right = spark.createDataFrame([(1, "p"), (1, "q")], "k int, w string")
    with pytest.raises(QualityError):
        joins.checked_join(left, right, [("k", "k")])
    with pytest.raises(QualityError):
        joins.checked_join(left, right.limit(1), [("k", "k")], matched="w")


def test_plain_urls():
    assert text.plain_url("HTTPS://WWW.Example.org/Menu//?q=1#top") == "https://example.org/Menu"
    assert text.plain_url(" www.example.org/x/ ") == "www.example.org/x"
    assert text.plain_url("//www.example.org/x") == "//example.org/x"
    assert text.plain_url(None) == text.plain_url("  ") == ""
