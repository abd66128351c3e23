"""Points in areas with holes and several parts, and the guarded fallback."""

import pytest
from pyspark.sql import functions as F

from sommelix.operators import spatial
from sommelix.operators.quality import QualityError


def _square(x, y, side):
    return [(x, y), (x + side, y), (x + side, y + side), (x, y + side), (x, y)]


def _areas(spark):
    rows = [
        ("A", "g", [_square(0.0, 0.0, 4.0), _square(1.0, 1.0, 2.0)]),
        ("B", "g", [_square(4.5, 0.0, 2.0), _square(20.0, 20.0, 1.0)]),
        ("C", "h", [_square(6.0, 1.0, 3.0)]),
    ]
    return spark.createDataFrame(rows, "code string, area_group string, rings array<array<struct<x: double, y: double>>>")


def test_areas(spark):
    rows = [
        (1, 0.5, 0.5, "g"), (2, 2.0, 2.0, "g"), (3, 1.1, 2.0, "g"), (4, 4.25, 1.0, "g"), (5, 20.5, 20.5, "g"), (6, 6.2, 1.5, "g"),
        (7, None, 1.0, "g"), (8, 9.2, 2.0, "g"), (9, 9.2, 2.0, "h"), (10, 0.0, 2.0, "g"), (11, float("nan"), 0.0, "g"), (12, -0.2, 2.0, "g"),
    ]
    points = spark.createDataFrame(rows, "id long, x double, y double, point_group string")
    for cell in (0.7, 3.0, 100.0):
        got = spatial.assign_areas(points, _areas(spark), 0.3, cell, "point_group", "area_group")
        assert {r.id: (r.code, r.how) for r in got.collect()} == {
            1: ("A", "within"), 2: (None, None), 3: ("A", "nearest"), 4: (None, "ambiguous"), 5: ("B", "within"),
            6: (None, "overlap"), 7: (None, None), 8: (None, None), 9: ("C", "nearest"), 10: ("A", "nearest"),
            11: (None, None), 12: ("A", "nearest"),
        }
    with pytest.raises(QualityError, match="unmatched: 4 points"):
        spatial.require_assigned(got)
    assert spatial.require_assigned(got.where(F.col("code").isNotNull())).count() == 6
    assert spatial.assign_areas(points.limit(0), _areas(spark), 0.3, 3.0).count() == 0
    assert spatial.assign_areas(points, _areas(spark).limit(0), 0.3, 3.0).where("how IS NULL").count() == 12
