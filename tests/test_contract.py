"""What a product's features must hold, on features read from a file as they stand there."""

import json

from sommelix.operators import contract
from sommelix.sources import files

GOOD = {
    "region": "R", "app": "A", "display_name": "N", "colour": None, "categorie": "Vin jaune", "prompt_signals": '["oxidative_speciality"]', "source_area_m2": 3,
}
SQUARE = [[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]
HOLE = [[0.25, 0.25], [0.5, 0.25], [0.5, 0.5], [0.25, 0.25]]


def feature(geometry=("Polygon", [SQUARE, HOLE]), **other):
    made = None if geometry is None else {"type": geometry[0], "coordinates": geometry[1]}
    return {"type": "Feature", "properties": GOOD | other, "geometry": made}


def report(spark, tmp_path, features):
    path = tmp_path / "product.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    read = files.read_features(spark, str(path), one_document=True).selectExpr("monotonically_increasing_id() AS feature", "*")
    assert read.count() == len(features)
    return {r["check"]: (r.n, r["first"]) for r in contract.product_faults(read, "feature", 0.5).collect()}


def test_good_features_have_no_fault(spark, tmp_path):
    parts = ("MultiPolygon", [[SQUARE], [[[x + 5, y] for x, y in SQUARE]]])
    good = [feature(), feature(parts, app="B", source_area_m2=0.5), feature(app="C", categorie="Vin tranquille", prompt_signals="[]")]
    assert report(spark, tmp_path, good) == {}
    assert report(spark, tmp_path, []) == {}


def test_values_of_other_kinds(spark, tmp_path):
    swapped = feature(app="S")
    swapped["properties"] = dict(reversed(swapped["properties"].items()))
    got = report(spark, tmp_path, [
        feature(app=7), feature(app=None, colour="x"), feature(source_area_m2=True, colour=1), feature(source_area_m2=None, colour=2),
        feature(prompt_signals=["oxidative_speciality"], colour=3), feature(prompt_signals='[ "oxidative_speciality"]', colour=4),
        feature(categorie=" , ", colour=5), swapped, {"type": "Feature", "properties": None, "geometry": feature()["geometry"]},
    ])
    assert got == {
        "blank app": (3, "0"), "blank region": (1, "8"), "blank display_name": (1, "8"), "no area in square metres": (3, "2"),
        "signals not those of the category": (4, "4"), "properties or their order": (2, "7"), "missing property": (1, "8"),
    }


def test_geometries(spark, tmp_path):
    shapes = [
        None, ("Polygon", []), ("MultiPolygon", [[]]), ("LineString", SQUARE), ("Polygon", [SQUARE[:-1]]), ("Polygon", [[[0, 0], [1], [1, 1], [0, 0]]]),
        ("Polygon", [[[0, 0], [2, 2], [2, 0], [0, 2], [0, 0]]]), ("MultiPolygon", [[SQUARE], [[[x + 0.5, y + 0.5] for x, y in SQUARE]]]),
    ]
    got = report(spark, tmp_path, [feature(s, app=f"A{i}") for i, s in enumerate(shapes)])
    assert got == {
        "no geometry": (3, "0"), "neither Polygon nor MultiPolygon": (1, "3"), "geometry: not closed": (1, "4"),
        "geometry: null or non-finite": (1, "5"), "geometry: no area": (1, "6"), "geometry: crossing": (2, "6"),
    }


def test_repeated_identities(spark, tmp_path):
    one, two = feature(), feature()
    del two["properties"]["colour"]  # as if it were null
    got = report(spark, tmp_path, [one, two, feature(), feature(region="1"), feature(region=1)])
    assert got == {"identity: repeated rows": (2, "0"), "missing property": (1, "1"), "properties or their order": (1, "1"), "blank region": (1, "4")}
