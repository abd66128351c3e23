"""Sources for archives of CSV files and for shapefiles, as Python data sources that Spark plans and reads in parts.

``register(spark)`` makes the formats ``csv_archive`` and ``shape`` known and lets filters reach them. Paths may be in any store
that Arrow's file systems know; several are given with commas.
"""

from __future__ import annotations

import csv
import io
import struct
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from datetime import date

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, InputPartition, IsNotNull
from pyspark.sql.types import StructType

from sommelix.operators.quality import QualityError

RINGS = "array<array<struct<x: double, y: double>>>"
#: Kinds of records in a shapefile by their number; those with a height or a measure have the same points first.
POINTS, LINES, AREAS, MULTIPOINTS = (1, 11, 21), (3, 13, 23), (5, 15, 25), (8, 18, 28)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in (CsvArchive, Shape):
        spark.dataSource.register(source)


def opened(path: str):
    """A file to read from any place; a path without scheme is a local one."""
    store, name = pafs.FileSystem.from_uri(_uri(path))
    return store.open_input_file(name)


def _uri(path: str) -> str:
    """Spark writes local places as file:/a; Arrow knows them as file:///a."""
    return path if "://" in path else f"file://{path.removeprefix('file:')}"


class Equal:
    """Filters that a reader takes over, equal to a value or not null; all others stay with Spark."""

    def __init__(self, names: Sequence[str]):
        self.names, self.wanted, self.present = names, [], []

    def take(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            own = isinstance(f, EqualTo | EqualNullSafe | IsNotNull) and len(f.attribute) == 1 and f.attribute[0] in self.names
            if own and isinstance(f, IsNotNull):
                self.present.append(f.attribute[0])
            elif own and f.value is not None:
                self.wanted.append((f.attribute[0], f.value))
            else:
                yield f

    def passes(self, value) -> bool:
        """Whether a row, a function from a column's name to its value, is wanted."""
        return all(value(c) == v for c, v in self.wanted) and all(value(c) is not None for c in self.present)


class Archive(InputPartition):
    def __init__(self, path: str):
        self.path = path


class CsvArchive(DataSource):
    """Rows of the one data table (or, with ``part=metadata``, of the one metadata table) in each ZIP archive, all as text.

    An archive has just one member ending in ``_data.csv`` and one in ``_metadata.csv``. A member is inflated in a stream by one
    task, with its checksum told at its end, and rows that a pushed equality filter does not want go no further; memory does
    not grow with the member. Empty fields are null. A schema names the columns wanted: others are not made."""

    @classmethod
    def name(cls) -> str:
        return "csv_archive"

    def paths(self) -> list[str]:
        return [p.strip() for p in self.options["path"].split(",")]

    def schema(self) -> str:
        with opened(self.paths()[0]) as f, zipfile.ZipFile(f) as archive:
            header = next(csv.reader(_text(archive, _member(archive, self.options.get("part", "data"), self.paths()[0])), delimiter=self.options.get("sep", ";")))
        return ", ".join(f"`{name}` string" for name in header)

    def reader(self, schema: StructType) -> DataSourceReader:
        return CsvArchiveReader(self.paths(), schema.names, self.options.get("part", "data"), self.options.get("sep", ";"))


def _member(archive: zipfile.ZipFile, part: str, path: str) -> str:
    """The name of the member asked for, where the archive has one of each."""
    found = {}
    for kind in ("data", "metadata"):
        names = [n for n in archive.namelist() if n.lower().endswith(f"_{kind}.csv")]
        if len(names) != 1:
            raise QualityError(f"one {kind} table expected in {path}, found {names}")
        found[kind] = names[0]
    return found[part]


def _text(archive: zipfile.ZipFile, member: str) -> io.TextIOWrapper:
    return io.TextIOWrapper(archive.open(member), "utf-8-sig", newline="")


class CsvArchiveReader(DataSourceReader):
    def __init__(self, paths: list[str], names: list[str], part: str, sep: str):
        self.paths, self.names, self.part, self.sep = paths, names, part, sep
        self.equal = Equal(names)

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        yield from self.equal.take(filters)

    def partitions(self) -> list[InputPartition]:
        return [Archive(p) for p in self.paths]

    def read(self, partition: Archive) -> Iterator[tuple]:
        with opened(partition.path) as f:
            try:
                archive = zipfile.ZipFile(f)
            except zipfile.BadZipFile as fault:
                raise QualityError(f"not a ZIP archive: {partition.path}") from fault
            rows = csv.reader(_text(archive, _member(archive, self.part, partition.path)), delimiter=self.sep)
            header = next(rows, [])
            if missing := [n for n in self.names if n not in header]:
                raise QualityError(f"{partition.path} has no columns {missing}")
            at = [header.index(n) for n in self.names]
            place = {n: header.index(n) for n in self.names}
            for row in rows:
                if len(row) != len(header):
                    raise QualityError(f"{partition.path} line {rows.line_num}: {len(row)} fields, not {len(header)}")
                if self.equal.passes(lambda c: row[place[c]] or None):  # noqa: B023  called at once
                    yield tuple(row[k] or None for k in at)


def write_archives(frame: DataFrame, folder: str, by: str, sep: str = ";") -> DataFrame:
    """One archive for each value of ``by``, named after it, with its rows as text and a table of the columns' names as metadata;
    gives (path, n) of each. Rows are dealt out by the value, sorted, and pass through one at a time.

    A value must be fit for a file's name. Files are written under a passing name first, so what is read is whole."""
    names = frame.columns

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = None
        for batch in batches:
            for row in batch.to_pylist():
                if one is None or one.value != row[by]:
                    if one is not None:
                        yield one.closed()
                    one = _ArchiveWriter(folder, row[by], names, sep)
                one.rows.writerow(["" if row[c] is None else row[c] for c in names])
                one.n += 1
        if one is not None:
            yield one.closed()

    text = frame.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in names])
    return text.repartition(by).sortWithinPartitions(by, *[c for c in names if c != by]).mapInArrow(write, "path string, n bigint")


class _ArchiveWriter:
    def __init__(self, folder: str, value: str, names: list[str], sep: str):
        self.value, self.n = value, 0
        self.store, base = pafs.FileSystem.from_uri(_uri(folder))
        self.store.create_dir(base)
        self.path, self.passing = f"{base}/{value}.zip", f"{base}/.{value}-{uuid.uuid4().hex}"
        self.name = f"{folder}/{value}.zip"
        self.file = self.store.open_output_stream(self.passing)
        self.zip = zipfile.ZipFile(self.file, "w", zipfile.ZIP_DEFLATED)
        self.zip.writestr(f"{value}_metadata.csv", "".join(f"{line}\n" for line in ("column", *names)))
        self.member = io.TextIOWrapper(self.zip.open(f"{value}_data.csv", "w"), "utf-8", newline="")
        self.rows = csv.writer(self.member, delimiter=sep, lineterminator="\n")
        self.rows.writerow(names)

    def closed(self) -> pa.RecordBatch:
        self.member.close()
        self.zip.close()
        self.file.close()
        self.store.move(self.passing, self.path)
        return pa.RecordBatch.from_pydict({"path": [self.name], "n": pa.array([self.n], pa.int64())})


def departmental_archive(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The rows of departments and the metadata of one or several archives; fails where no row is one of a department."""
    register(spark)
    data = spark.read.format("csv_archive").load(path)
    if "GEO_OBJECT" not in data.columns:
        raise QualityError(f"{path} has no column GEO_OBJECT")
    rows = data.where("GEO_OBJECT = 'DEP'")
    if rows.isEmpty():
        raise QualityError(f"no departmental rows in {path}")
    return rows, spark.read.format("csv_archive").option("part", "metadata").load(path)


class Records(InputPartition):
    def __init__(self, path: str, first: int, last: int):
        self.path, self.first, self.last = path, first, last


class Shape(DataSource):
    """Records of shapefiles: ``record`` (from 0), ``shape_type``, the attributes, and ``rings`` (parts for lines and points).

    ``path`` ends in ``.shp``; the index ``.shx`` and the attributes ``.dbf`` lie beside it. A file is divided at the index's
    offsets into stretches of ``records`` records (1000), each read by a task of its own. A schema names the columns wanted:
    shapes are decoded only where ``rings`` is one of them, and for records that pushed equality filters let through.
    Deleted attribute rows are left out; blank attributes, and shapes of kind 0, are null; heights and measures are left out."""

    @classmethod
    def name(cls) -> str:
        return "shape"

    def paths(self) -> list[str]:
        return [p.strip() for p in self.options["path"].split(",")]

    def schema(self) -> str:
        fields = Attributes(self.paths()[0], self.options.get("encoding", "utf-8")).types()
        return ", ".join(["record bigint", "shape_type int", *[f"`{n}` {t}" for n, t in fields.items()], f"rings {RINGS}"])

    def reader(self, schema: StructType) -> DataSourceReader:
        return ShapeReader(self.paths(), schema.names, int(self.options.get("records", 1000)), self.options.get("encoding", "utf-8"))


class Attributes:
    """Layout of the attribute table beside a shapefile."""

    def __init__(self, path: str, encoding: str):
        self.path, self.encoding, self.fields = path[:-4] + ".dbf", encoding, {}
        with opened(self.path) as f:
            self.n, self.start, self.width = struct.unpack("<IHH", f.read(12)[4:])
            described = f.read(self.start - 12)[20:]
        at = 1  # after the mark of deletion
        for k in range(0, len(described), 32):
            if described[k] == 0x0D:
                break
            name = described[k : k + 11].split(b"\0")[0].decode(encoding)
            kind, size, decimals = chr(described[k + 11]), described[k + 16], described[k + 17]
            self.fields[name] = (kind, at, size, decimals)
            at += size

    def types(self) -> dict[str, str]:
        def kind(code: str, size: int, decimals: int) -> str:
            if code in "NF":
                return "bigint" if code == "N" and not decimals and size < 19 else "double"
            return {"D": "date", "L": "boolean"}.get(code, "string")

        return {n: kind(code, size, decimals) for n, (code, _, size, decimals) in self.fields.items()}

    def value(self, row: bytes, name: str):
        kind, at, size, decimals = self.fields[name]
        text = row[at : at + size].decode(self.encoding).strip(" \0")
        if not text or set(text) == {"*"}:
            return None
        if kind in "NF":
            return int(text) if kind == "N" and not decimals and size < 19 else float(text)
        if kind == "D":
            return date(int(text[:4]), int(text[4:6]), int(text[6:8]))
        if kind == "L":
            return None if text == "?" else text in "TtYy"
        return text


def _shape(content: bytes) -> tuple[int, list | None]:
    """Kind and parts of a record."""
    kind = struct.unpack_from("<i", content)[0]
    if kind in POINTS:
        return kind, [[struct.unpack_from("<2d", content, 4)]]
    if kind in MULTIPOINTS:
        n = struct.unpack_from("<i", content, 36)[0]
        return kind, [[p] for p in struct.iter_unpack("<2d", content[40 : 40 + 16 * n])]
    if kind not in LINES + AREAS:
        return kind, None
    n_parts, n = struct.unpack_from("<2i", content, 36)
    starts = [*struct.unpack_from(f"<{n_parts}i", content, 44), n]
    points = list(struct.iter_unpack("<2d", content[44 + 4 * n_parts : 44 + 4 * n_parts + 16 * n]))
    return kind, [points[s:e] for s, e in zip(starts, starts[1:])]


class ShapeReader(DataSourceReader):
    def __init__(self, paths: list[str], names: list[str], records: int, encoding: str):
        self.paths, self.names, self.records, self.encoding = paths, names, records, encoding
        self.equal = Equal([n for n in names if n not in ("rings", "shape_type", "record")])

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        yield from self.equal.take(filters)

    def partitions(self) -> list[InputPartition]:
        out = []
        for path in self.paths:
            with opened(path[:-4] + ".shx") as f:
                n = (f.size() - 100) // 8
            if n != Attributes(path, self.encoding).n:
                raise QualityError(f"{path}: {n} shapes, but another number of attribute rows")
            out += [Records(path, s, min(n, s + self.records)) for s in range(0, n, self.records)]
        return out

    def read(self, part: Records) -> Iterator[tuple]:
        table = Attributes(part.path, self.encoding)
        if missing := [n for n in self.names if n not in table.fields and n not in ("record", "shape_type", "rings")]:
            raise QualityError(f"{part.path} has no columns {missing}")
        n = part.last - part.first
        with opened(part.path[:-4] + ".shx") as f:
            f.seek(100 + 8 * part.first)
            index = list(struct.iter_unpack(">2i", f.read(8 * n)))
        with opened(table.path) as f:
            f.seek(table.start + table.width * part.first)
            rows = f.read(table.width * n)
        shapes = {"rings", "shape_type"} & set(self.names)
        with opened(part.path) as f:
            for k, (offset, size) in enumerate(index):
                row = rows[k * table.width : (k + 1) * table.width]
                if row[:1] == b"*" or not self.equal.passes(lambda c: table.value(row, c)):  # noqa: B023  called at once
                    continue
                kind = parts = None
                if shapes:
                    f.seek(2 * offset + 8)
                    content = f.read(2 * size if "rings" in shapes else 4)
                    kind, parts = _shape(content) if "rings" in shapes else (struct.unpack("<i", content)[0], None)
                own = {"record": part.first + k, "shape_type": kind, "rings": parts}
                yield tuple(own[c] if c in own else table.value(row, c) for c in self.names)
