"""Files written and read again, department statistics, and the acceptance of a snapshot."""

import json
import math

import pytest
from pyspark.sql import functions as F

from sommelix.operators import acceptance, departments
from sommelix.operators.linkage import Linkage
from sommelix.operators.quality import QualityError
from sommelix.sources import files


def test_missing_texts_and_bad_numbers(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('code,extra,n\n01,x,1.5\n2A,"a ""b"", c",NA\nnan,,\n')
    rows = files.read_csv(spark, str(path), "code string, n double, extra string").collect()
    assert [tuple(r) for r in rows] == [("01", 1.5, "x"), ("2A", None, 'a "b", c'), (None, None, None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        files.read_csv(spark, str(path), "extra double").collect()
    with pytest.raises(QualityError, match="lacks columns"):
        files.read_csv(spark, str(path), "other string")


def test_overrides_of_two_years(spark, tmp_path):
    assert files.read_overrides(spark, str(tmp_path / "none.csv"), (2025, 2026)).count() == 0
    path = tmp_path / "o.csv"
    path.write_text("previous_year,current_year,previous_name,current_name,reason\n2025,2026,A,B,moved\n2024,2025,C,D,sold\n")
    assert [tuple(r) for r in files.read_overrides(spark, str(path), (2025, 2026)).collect()] == [("A", "B", "moved")]
    for year in ("2024", "2026"):
        (tmp_path / f"uk_{year}.csv").write_text("a\n")
    assert files.latest_year(spark, str(tmp_path), "uk") == 2026


def test_geojson_is_compact_and_refuses_nan(spark, tmp_path):
    frame = spark.createDataFrame([("a", None, [[1.0, 2.0]]), ("b", 2.5, [[3.0, 4.0]])], "k string, v double, at array<array<double>>")
    files.write_geojson(frame, str(tmp_path / "g"), "LineString", "at")
    (line,) = [line for p in (tmp_path / "g").glob("part-*") for line in p.read_text().splitlines()]
    features = json.loads(line)["features"]
    assert features[0] == {"type": "Feature", "properties": {"k": "a", "v": None}, "geometry": {"type": "LineString", "coordinates": [[1.0, 2.0]]}}
    assert " " not in line
    files.write_geojson(frame, str(tmp_path / "many"), "LineString", "at", line_features=1)
    assert files.read_geojson(spark, str(tmp_path / "many"), "k: string").count() == 2
    with pytest.raises(QualityError, match="JSON number"):
        files.write_geojson(frame.withColumn("v", F.lit(math.nan)), str(tmp_path / "bad"), "LineString", "at")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        files.write_geojson(frame, str(tmp_path / "g"), "LineString", "at")


def test_geojson_over_many_lines(spark, tmp_path):
    ring = [[[0, 0], [1, 0], [1, 1], [0, 0]]]
    features = [{"type": "Feature", "properties": {"code": "2A"}, "geometry": {"type": t, "coordinates": c}} for t, c in (("Polygon", ring), ("MultiPolygon", [ring, ring]))]
    (tmp_path / "x.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=2))
    read = files.read_geojson(spark, str(tmp_path / "x.json"), "code: string", one_document=True)
    assert [r[0] for r in read.select(F.size(files.polygons(F.col("geometry")))).collect()] == [1, 2]


def test_department_codes_have_their_own_order(spark):
    frame = spark.createDataFrame([(c,) for c in ("21", "2B", "01", "2A", "20", "9")], "c string")
    assert [r[0] for r in frame.orderBy(departments.code_order(F.col("c"))).collect()] == ["01", "9", "20", "2A", "2B", "21"]


def test_a_department_without_wages_is_refused(spark):
    known = spark.createDataFrame([("01",), ("02",)], "department_code string")
    columns = "GEO string, GEO_OBJECT string, FREQ string, SEX string, AGE string, DERA_MEASURE string, CONF_STATUS string, TIME_PERIOD string, OBS_VALUE string"
    row = lambda geo: (geo, "DEP", "A", "_T", "_T", "SALAIRE_NET_EQTP_MENSUEL_MOYENNE", "F", "2022", "2100.5")
    one = spark.createDataFrame([row("01"), row("971")], columns)
    with pytest.raises(QualityError, match="departments without wages"):
        departments.measured(one, departments.WAGES, 2022, known, "wages")
    both = departments.measured(spark.createDataFrame([row("01"), row("02")], columns), departments.WAGES, 2022, known, "wages")
    assert sorted(r["average_net_monthly_wage_fte_eur"] for r in both.collect()) == [2100.5, 2100.5]


def test_product_by_name_reports_areas_apart(spark):
    known = spark.createDataFrame([("21", "Côte-d'Or")], "department_code string, department_name string")
    fixed = {k: F.lit(v) for k, v in departments.GDP.items()}
    raw = spark.createDataFrame(
        [("FRX", "COTE D’OR", "2022", "10.5", "A", "Normal"), ("FRY", "La Réunion", "2022", "7", "A", "Normal")],
        "REF_AREA string, `Reference area` string, TIME_PERIOD string, OBS_VALUE string, OBS_STATUS string, `Observation status` string",
    ).withColumns(fixed)
    found, apart = departments.gross_product(raw, 2022, known)
    assert [(r["department_code"], r["gdp_current_prices_million_eur"]) for r in found.collect()] == [("21", 10.5)]
    assert [r["oecd_tl3_code"] for r in apart.collect()] == ["FRY"]


@pytest.mark.parametrize("moved, verdict", [(60, "accepted"), (20, "too few material changes"), (0, "too few material changes")])
def test_acceptance(spark, moved, verdict):
    rows = [(i, f"n{i}", "1 Star", 1.0) for i in range(200)]
    schema = "source_row long, name string, award string, stars double"
    a = spark.createDataFrame(rows, schema)
    b = spark.createDataFrame([(i, n, "2 Stars" if i < moved else w, 2.0 if i < moved else s) for i, n, w, s in rows], schema)
    pairs = a.select(F.col("source_row").alias("previous_row"), F.col("source_row").alias("current_row"))
    conflicts = spark.createDataFrame([], "key string, rows long")
    linked = Linkage(pairs, a.limit(0), b.limit(0), conflicts, pairs.limit(0))
    changes = acceptance.matched_changes(a, b, pairs)
    row = acceptance.judged(acceptance.compared(a, b, linked, changes), []).first()
    assert (row["verdict"], row["award_label_changes"], row["match_rate"]) == (verdict, moved, 1.0)
    assert row["accepted"] == (verdict == "accepted")
    assert not acceptance.judged(acceptance.compared(a, b, linked, changes), ["url"]).first()["reliable"]
