"""What several training-data operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sommelix.operators.lineage import cut, saved, shared_folder  # noqa: F401  for the operators of this subpackage

#: Space and the controls tab to carriage return separate words.
SEPARATORS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Number of words; null counts as no text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def words(text: Column) -> Column:
    """Words in order; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def learnable(doc_id: Column) -> Column:
    """Rows whose labels may be learned from: crc32 of the id as text, modulo 4, is not 2. Null ids are not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2, F.lit(False))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def small(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many rows, so what Python makes of one stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def per_text(docs: DataFrame, make: Callable, fields: dict[str, tuple[str, pa.DataType]], keep: tuple[str, ...] | None = None) -> DataFrame:
    """``row``, a struct of the columns to keep (all, unless named), and new columns computed from the texts in batches.

    ``make()`` gives a function from a list of texts to a list of columns; fields has their Spark and Arrow types. Other
    columns pass through as Arrow arrays under names of their own, so nulls, large integers and clashing names stay as
    they are.
    """
    keep = tuple(docs.columns) if keep is None else keep
    inner = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)], F.col("text").alias("t"))
    # a text that is kept anyway goes to Python and back once
    source = f"c{keep.index('text')}" if "text" in keep else "t"
    inner = inner.drop("t") if "text" in keep else inner
    kept = [f"c{i}" for i in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in small(batches):
            made = work(batch.column(source).to_pylist())
            new = [pa.array(values, kind) for values, (_, kind) in zip(made, fields.values())]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *new], names=[*kept, *fields])

    types = dict(inner.dtypes)
    schema = ", ".join([*[f"{c} {types[c]}" for c in kept], *[f"{n} {t}" for n, (t, _) in fields.items()]])
    row = F.struct(*[F.col(k).alias(c) for k, c in zip(kept, keep)])
    return inner.mapInArrow(run, schema).select(row.alias("row"), *fields)


def _bit(columns: list[str], n: int) -> tuple[Column, Column]:
    """Which of n bits stands for a row's columns: the word of 64 that holds it, and its place there."""
    bit = F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int")
    return F.shiftright(bit, 6), bit.bitwiseAND(63)


def maybe_in(rows: DataFrame, columns: list[str], wanted: DataFrame, how: str = "left_semi", n: int = 1 << 22) -> DataFrame:
    """rows whose columns may be in ``wanted`` (or, left_anti, surely are not). A broadcast of n bits, in n / 64 numbers at
    most, tells: those at the hashes of what is wanted are set. It only saves moving rows: what is in must still be decided
    by a join. If more than n are wanted, most bits would be set, so nothing is sent and all rows may be in."""
    if wanted.count() > n:
        return rows if how == "left_semi" else rows.where(F.lit(False))
    word, place = _bit(columns, n)
    places = wanted.select(word.alias("_word"), place.alias("_place"))
    bits = places.groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _place)")).alias("_bits"))
    told = rows.join(F.broadcast(bits), word == F.col("_word"), "left")
    maybe = F.coalesce(F.getbit("_bits", place) == 1, F.lit(False))
    return told.where(maybe if how == "left_semi" else ~maybe).drop("_word", "_bits")


def doc_key() -> Column:
    """A document's key, in the order that decides which is earlier: null ids last, then id, then the text's hash."""
    return F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", F.xxhash64("text").alias("hash"))
