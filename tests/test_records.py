"""Archives, shapefiles, tables with versions, ledgers and row numbers, against files and rows made here."""

import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from sommelix.operators import ledger, ordinals
from sommelix.operators.quality import QualityError
from sommelix.operators.versions import Versions, upserted
from sommelix.sources import binary, files


def archive(path, rows, header="GEO;GEO_OBJECT;OBS_VALUE", names=("x_data.csv", "x_metadata.csv")):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name in names:
            z.writestr(name, header + "\n" + "".join(r + "\n" for r in rows) if "metadata" not in name else "COD_VAR;LIB_VAR\nGEO;Place\n")
    return str(path)


def test_archives_take_equality_filters(spark, tmp_path, capfd):
    one = archive(tmp_path / "one.zip", ["01;DEP;5", "75056;COM;9", '02;DEP;"6;5"', "03;DEP;"])
    two = archive(tmp_path / "two.zip", ["04;DEP;é", "1;REG;8"])
    rows, about = binary.departmental_archive(spark, f"{one}, {two}")
    assert sorted(map(tuple, rows.collect())) == [("01", "DEP", "5"), ("02", "DEP", "6;5"), ("03", "DEP", None), ("04", "DEP", "é")]
    assert about.count() == 2 and about.columns == ["COD_VAR", "LIB_VAR"]
    assert rows.rdd.getNumPartitions() == 2
    capfd.readouterr()
    rows.explain()
    assert " Filter " not in capfd.readouterr().out  # none is left to Spark
    narrow = spark.read.format("csv_archive").schema("OBS_VALUE string").load(one)
    assert sorted(r.OBS_VALUE or "" for r in narrow.collect()) == ["", "5", "6;5", "9"]
    reader = binary.CsvArchiveReader([one], ["GEO", "OBS_VALUE"], "data", ";")
    assert len(list(reader.read(binary.Archive(one)))) == 4
    reader.equal.wanted.append(("GEO", "02"))
    assert list(reader.read(binary.Archive(one))) == [("02", "6;5")]


def test_broken_archives_fail(spark, tmp_path):
    binary.register(spark)
    read = lambda path: spark.read.format("csv_archive").schema("GEO string").load(str(path)).collect()
    (tmp_path / "text.zip").write_text("no archive")
    with pytest.raises(Exception, match="not a ZIP archive"):
        read(tmp_path / "text.zip")
    with pytest.raises(Exception, match="one data table expected"):
        read(archive(tmp_path / "two.zip", ["1;DEP;2"], names=("a_data.csv", "b_data.csv", "x_metadata.csv")))
    with pytest.raises(Exception, match="one metadata table expected"):
        read(archive(tmp_path / "none.zip", ["1;DEP;2"], names=("a_data.csv",)))
    with pytest.raises(Exception, match="has no columns"):
        read(archive(tmp_path / "other.zip", ["1"], header="OTHER"))
    with pytest.raises(Exception, match="2 fields, not 3"):
        read(archive(tmp_path / "short.zip", ["1;DEP"]))
    bad = bytearray(open(archive(tmp_path / "crc.zip", [f"{i};DEP;{i}" for i in range(500)]), "rb").read())
    at = bad.find(b"PK\x01\x02") + 16  # the checksum in the list of members
    bad[at] ^= 0xFF
    (tmp_path / "crc.zip").write_bytes(bad)
    with pytest.raises(Exception, match="Bad CRC-32"):
        read(tmp_path / "crc.zip")
    with pytest.raises(QualityError, match="no departmental rows"):
        binary.departmental_archive(spark, archive(tmp_path / "empty.zip", ["1;COM;2"]))


def shapefile(base, rows, kind=5):
    """Rows (name, number, ratio, day, flag, parts) as the three files; a row of None is marked as deleted."""
    shp, shx, at = b"", b"", 50
    for k, row in enumerate(rows):
        parts = row[5] if row else None
        if parts is None:
            content = struct.pack("<i", 0)
        elif kind == 1:
            content = struct.pack("<i2d", kind, *parts[0][0])
        else:
            points = [p for part in parts for p in part]
            starts = [sum(map(len, parts[:i])) for i in range(len(parts))]
            content = struct.pack("<i4d2i", kind, 0, 0, 1, 1, len(parts), len(points)) + struct.pack(f"<{len(parts)}i", *starts)
            content += b"".join(struct.pack("<2d", *p) for p in points)
        shp += struct.pack(">2i", k + 1, len(content) // 2) + content
        shx += struct.pack(">2i", at, len(content) // 2)
        at += 4 + len(content) // 2
    head = lambda n: struct.pack(">7i", 9994, 0, 0, 0, 0, 0, n // 2) + struct.pack("<2i8d", 1000, kind, *[0.0] * 8)
    base.with_suffix(".shp").write_bytes(head(100 + len(shp)) + shp)
    base.with_suffix(".shx").write_bytes(head(100 + len(shx)) + shx)
    fields = [(b"NAME", b"C", 12, 0), (b"NUMBER", b"N", 9, 0), (b"RATIO", b"N", 12, 4), (b"DAY", b"D", 8, 0), (b"FLAG", b"L", 1, 0)]
    width, start = 1 + sum(f[2] for f in fields), 33 + 32 * len(fields)
    dbf = struct.pack("<4BIHH20x", 3, 126, 1, 1, len(rows), start, width)
    dbf += b"".join(struct.pack("<11sc4xBB14x", *f) for f in fields) + b"\r"
    for row in rows:
        if row is None:
            dbf += b"*" + b" " * (width - 1)
            continue
        name, number, ratio, day, flag, _ = row
        texts = [name or "", "" if number is None else str(number).rjust(9), "" if ratio is None else f"{ratio:12.4f}", day or "", flag]
        dbf += b" " + b"".join(t.encode().ljust(f[2]) for t, f in zip(texts, fields))
    base.with_suffix(".dbf").write_bytes(dbf + b"\x1a")
    return str(base.with_suffix(".shp"))


def test_shapefile_round_trip_in_parts(spark, tmp_path):
    binary.register(spark)
    square = lambda k: [[(k, 0.0), (k, 1.0), (k + 1.0, 1.0), (k, 0.0)], [(k + 0.5, 0.25), (k, 0.5), (k + 0.25, 0.5), (k + 0.5, 0.25)]][: 1 + k % 2]
    rows = [(f"Côte {k}", k * 7, k / 8, "20250713", "TF?"[k % 3], square(k)) for k in range(50)]
    rows += [("blank", None, None, None, " ", None), None, ("last", -3, -0.5, "19991231", "y", square(3))]
    path = shapefile(tmp_path / "areas", rows)
    read = spark.read.format("shape").option("records", 7).load(path)
    assert dict(read.dtypes) == {"record": "bigint", "shape_type": "int", "NAME": "string", "NUMBER": "bigint", "RATIO": "double", "DAY": "date", "FLAG": "boolean", "rings": binary.RINGS.replace(": ", ":").replace(", ", ",")}
    assert read.rdd.getNumPartitions() == 8
    got = {r.record: r for r in read.collect()}
    assert sorted(got) == [k for k in range(53) if k != 51]
    for k, row in enumerate(rows):
        if row:
            name, number, ratio, day, flag, parts = row
            r = got[k]
            assert (r.NAME, r.NUMBER, r.RATIO) == (name, number, ratio) and (r.DAY and r.DAY.strftime("%Y%m%d")) == day
            assert r.FLAG == {"T": True, "y": True, "F": False}.get(flag) and r.shape_type == (5 if parts else 0)
            assert (r.rings and [[tuple(p) for p in ring] for ring in r.rings]) == parts
    some = spark.read.format("shape").schema("NUMBER bigint, record bigint").load(path).where("NUMBER = 14")
    assert [tuple(r) for r in some.collect()] == [(14, 2)]
    reader = binary.ShapeReader([path], ["NAME", "rings"], 1000, "utf-8")
    reader.equal.wanted.append(("NAME", "last"))
    assert [r[0] for p in reader.partitions() for r in reader.read(p)] == ["last"]
    points = shapefile(tmp_path / "points", [("a", 1, 1.0, None, "T", [[(2.5, 3.5)]])], 1)
    assert spark.read.format("shape").load(points).first().rings == [[(2.5, 3.5)]]


def test_shapefile_with_another_number_of_rows(spark, tmp_path):
    path = shapefile(tmp_path / "a", [("a", 1, 1.0, None, "T", None)])
    shapefile(tmp_path / "b", [("a", 1, 1.0, None, "T", None)] * 2)
    (tmp_path / "a.dbf").write_bytes((tmp_path / "b.dbf").read_bytes())
    binary.register(spark)
    with pytest.raises(Exception, match="another number of attribute rows"):
        spark.read.format("shape").load(path).collect()


def test_versions(spark, tmp_path):
    table = Versions(spark, f"file://{tmp_path}/t")
    assert table.current() is None and table.number() == 0
    table.publish(spark.range(3))
    assert table.number() == 1 and table.current().count() == 3
    with pytest.raises(QualityError, match="written since"):
        table.publish(spark.range(9), 0)
    with pytest.raises(Exception, match="error while writing"):
        table.publish(spark.range(5).select(F.raise_error(F.lit("error while writing"))))
    assert table.current().count() == 3  # a lost writer leaves the old version
    (tmp_path / "t/entries/000000000002").write_text("")  # as does one that was lost while it made its entry
    assert table.current().count() == 3
    table.publish(spark.range(4))
    assert table.number() == 3 and table.current().count() == 4


def test_upsert_keeps_what_people_wrote(spark, tmp_path):
    table = Versions(spark, str(tmp_path / "reviews"))
    human = ["status", "notes"]
    rows = lambda *r: spark.createDataFrame(r, "slug string, area string")
    assert sorted(map(tuple, upserted(table, rows(("a", "1"), ("b", "2")), "slug", human).collect())) == [("a", "1", "", ""), ("b", "2", "", "")]
    table.publish(table.current().withColumn("status", F.when(F.col("slug") == "a", "approved").otherwise("")))
    assert sorted(map(tuple, upserted(table, rows(("a", "9"), ("c", None)), "slug", human).collect())) == [("a", "9", "approved", ""), ("c", None, "", "")]
    number = table.number()
    upserted(table, rows(("c", None), ("a", "9")), "slug", human)
    assert table.number() == number  # a rerun changes nothing
    for bad, first in ((rows(("a", "1"), ("a", "1")), "a"), (rows((None, "1")), "None")):
        with pytest.raises(QualityError, match=f"null or repeated, the first {first}"):
            upserted(table, bad, "slug", human)
    assert table.number() == number


def test_batch_is_taken_up_again(spark, tmp_path):
    results, done = (Versions(spark, str(tmp_path / n)) for n in ("results", "ledger"))
    asked = []

    def totals(rows):
        asked.append(sorted(r.region or "" for r in rows.select("region").distinct().collect()))
        return rows.groupBy("region").agg(F.sum("v").alias("n"))

    faults = lambda rows: rows.where("v < 0").select("region", F.concat(F.lit("negative "), "v").alias("error"))
    rows = [("x", 1), ("x", 2), ("y", 5), ("z", -1), ("z", -2), (None, 4)]

    def run(rows, parameters=None):
        frame = spark.createDataFrame(rows, "region string, v long").repartition(3)
        status = ledger.run_regions(frame, "region", results, done, totals, faults, parameters)
        return {r.region: (r.status, r.error) for r in status.collect()}, {r.region: r.n for r in results.current().collect()}

    status, found = run(rows)
    assert status == {"x": ("computed", None), "y": ("computed", None), "z": ("failed", "negative -1"), None: ("computed", None)}
    assert found == {"x": 3, "y": 5, None: 4}
    assert run(rows[::-1])[0] == {k: ("skipped", None) if k != "z" else v for k, v in status.items()}  # in any order; failed ones again
    status, found = run([("x", 1), ("x", 2), ("y", 6), ("z", 1)])
    assert status == {"x": ("skipped", None), "y": ("computed", None), "z": ("computed", None)} and found == {"x": 3, "y": 6, "z": 1}
    assert asked == [["", "x", "y"], [], ["y", "z"]]
    assert {s for s, _ in run([("x", 1), ("x", 2)], {"tolerance": 1})[0].values()} == {"computed"}
    number = results.number()
    assert run([("x", 1), ("x", 2)], {"tolerance": 1})[0] == {"x": ("skipped", None)} and results.number() == number


def test_ordinals_follow_the_files(spark, tmp_path):
    wanted = []
    for name, n in (("a", 700), ("b", 1), ("c", 0), ("d", 2500)):
        lines = [f"{name}{i}" for i in range(n)]
        (tmp_path / f"{name}.csv").write_text("k\n" + "".join(f"{x}\n" for x in lines))
        wanted += lines
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        read = files.read_csv(spark, str(tmp_path), "k string")
        assert read.rdd.getNumPartitions() > 3
        got = ordinals.source_ordinals(read, first=10).orderBy("ordinal").collect()
    finally:
        for name in ("maxPartitionBytes", "openCostInBytes"):
            spark.conf.unset(f"spark.sql.files.{name}")
    assert [(r.k, r.ordinal) for r in got] == [(k, 10 + i) for i, k in enumerate(wanted)]


def test_steps_back_over_blocks(spark):
    values = [3, 1, 1, 5, None, 2, 9, 8, 8, 7, 10, 0]
    rows = spark.createDataFrame(list(enumerate(values)), "at long, v long").repartition(4)
    wanted = [i for i in range(1, len(values)) if None not in values[i - 1 : i + 1] and values[i - 1] > values[i]]
    for block in (1, 2, 5, 100):
        assert sorted(r["at"] for r in ordinals.steps_back(rows, "v", F.col("at"), block).collect()) == wanted
