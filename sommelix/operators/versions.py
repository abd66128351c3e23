"""Tables that are replaced as a whole: a new version is written beside the old one, and made the current one last.

A version is a folder of Parquet files; an entry, numbered in order, holds its name. Entries are made only after their version
is written, and only if no entry has that number, so a reader sees the old or the new version, a lost executor or driver leaves
the old one, and of two writers that started from one version the second fails. An entry whose writer was lost is empty and skipped.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sommelix.operators.quality import QualityError, same_rows


class Versions:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self._jvm = spark, path, spark.sparkContext._jvm
        self._folder = self._jvm.org.apache.hadoop.fs.Path(f"{path}/entries")
        self._store = self._folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _entry(self, number: int):
        return self._jvm.org.apache.hadoop.fs.Path(self._folder, f"{number:012d}")

    def _version(self, number: int) -> str:
        stream = self._store.open(self._entry(number))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def number(self) -> int:
        """The number of the last entry; 0 where nothing was written."""
        listed = self._store.listStatus(self._folder) if self._store.exists(self._folder) else []
        return max((int(name) for s in listed if (name := s.getPath().getName()).isdigit()), default=0)

    def current(self) -> DataFrame | None:
        for number in range(self.number(), 0, -1):
            if version := self._version(number):
                return self.spark.read.parquet(f"{self.path}/versions/{version}")
        return None

    def publish(self, frame: DataFrame, after: int | None = None) -> DataFrame:
        """Make the frame the current version; fails if the table was written since version ``after``."""
        after, version = self.number() if after is None else after, uuid.uuid4().hex
        frame.write.parquet(f"{self.path}/versions/{version}")
        if self.number() != after:
            raise QualityError(f"{self.path} was written since version {after}")
        entry = self._store.create(self._entry(after + 1), False)
        entry.write(version.encode())
        entry.close()
        return self.spark.read.parquet(f"{self.path}/versions/{version}")


def upserted(table: Versions, rows: DataFrame, key: str, human: list[str]) -> DataFrame:
    """The table refreshed by ``rows``: their columns are taken as they are, the ``human`` ones are kept by key.

    Keys that are new have empty human columns; keys that are no longer in ``rows`` leave. Keys are unique and not null. Where
    nothing changes, nothing is written, so a rerun leaves the same version."""
    repeated = rows.groupBy(key).agg(F.count("*").alias("n")).where(f"n > 1 OR `{key}` IS NULL").agg(F.count("*").alias("n"), F.min(key).alias("first")).first()
    if repeated.n:
        raise QualityError(f"{repeated.n} keys null or repeated, the first {repeated['first']}")
    after, old = table.number(), table.current()
    machine = rows.select([c for c in rows.columns if c not in human])
    if old is None:
        return table.publish(machine.select("*", *[F.lit("").alias(c) for c in human]), after)
    kept = old.select(key, *[c for c in human if c in old.columns])
    merged = machine.join(kept, key, "left").select(
        *machine.columns, *[(F.coalesce(c, F.lit("")) if c in kept.columns else F.lit("")).alias(c) for c in human]
    )
    if merged.dtypes == old.dtypes and same_rows(merged, old):
        return old
    return table.publish(merged, after)
