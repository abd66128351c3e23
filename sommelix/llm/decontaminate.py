"""Benchmark decontamination by Wu-Manber multi-pattern search.

Benchmark items become windows of 13 words (shorter items are one window). A text is brought to the same form, its words
between single spaces, and searched for " w1 w2 ... w13 ". A table over blocks of bytes says how far the search may jump
when a block ends at the current place; where it says 0 the block's bucket gives the windows to compare directly. Windows
are searched in bands of similar length, so a very short item does not shorten the jumps of the others.

A large benchmark is split into parts of about ``part_chars`` characters, searched one after the other, so what the driver,
a broadcast and a worker's tables hold is bounded whatever the benchmark's size.

Defined cases: null texts and items have no words; an item without words is no window; repeated items and ids count
once; null item ids hit words but are not listed; an empty benchmark hits nothing; repeated documents are rows of their
own; other columns are ignored.
"""

from __future__ import annotations

import pickle
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sommelix.llm.common import maybe_in, per_text, saved

WINDOW = 13
PART_CHARS = 16_000_000
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes to one form: A-Z lower-cased; digits, a-z and bytes from 0x80 on stay; all else separates words.
FORM = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def word_list(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(FORM).split()


class Band:
    """Wu-Manber tables of patterns whose lengths differ by less than a factor of two."""

    def __init__(self, patterns: list[bytes]):
        self.least = m = min(map(len, patterns))
        self.block = b = max(1, min(8, m // 2))
        self.jump = m - b + 1
        shift: dict[bytes, int] = {}
        self.buckets: dict[bytes, list[bytes]] = defaultdict(list)
        for p in patterns:
            for end in range(b, m + 1):
                key = p[end - b : end]
                shift[key] = min(shift.get(key, self.jump), m - end)
            self.buckets[p[m - b : m]].append(p)
        self.shift = shift

    def search(self, text: bytes) -> Iterator[tuple[int, bytes]]:
        m, b, jump, shift, at, n = self.least, self.block, self.jump, self.shift.get, self.least, len(text)
        while at <= n:
            key = text[at - b : at]
            if step := shift(key, jump):
                at += step
                continue
            for p in self.buckets[key]:
                if text.startswith(p, at - m):
                    yield at - m, p
            at += 1


class Searcher:
    def __init__(self, items: list[tuple[object, str]], window: int = WINDOW):
        self.items: dict[bytes, set] = defaultdict(set)
        for item, text in items:
            w = word_list(text)
            for i in range(max(1, len(w) - window + 1) if w else 0):
                self.items[b" " + b" ".join(w[i : i + window]) + b" "].add(item)
        bands: dict[int, list[bytes]] = defaultdict(list)
        for p in self.items:
            bands[len(p).bit_length()].append(p)
        self.bands = [Band(p) for _, p in sorted(bands.items())]

    def __call__(self, text: bytes) -> tuple[list[tuple[int, int]], set]:
        """Hit spans (first word, words) and the items found."""
        found = [x for band in self.bands for x in band.search(text)]
        if not found:
            return [], set()
        gaps = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
        firsts = np.searchsorted(gaps, [at for at, _ in found])
        return [(int(f), p.count(b" ") - 1) for f, (_, p) in zip(firsts, found)], set().union(*(self.items[p] for _, p in found))


def _merged(spans: list) -> list[list[int]]:
    out: list[list[int]] = []
    for first, count in sorted(spans):
        if out and first <= out[-1][0] + out[-1][1]:
            out[-1][1] = max(out[-1][1], first + count - out[-1][0])
        else:
            out.append([first, count])
    return out


_FIELDS = {
    "n_words": ("bigint", pa.int64()),
    "hits": ("array<array<int>>", pa.list_(pa.list_(pa.int32()))),
    "items": ("array<string>", pa.list_(pa.string())),
}


def _find(docs: DataFrame, shared: Broadcast, window: int, keep: tuple[str, ...] | None) -> DataFrame:
    """row (the kept columns) and _FIELDS, from the items of one part; a task compiles them once."""

    def make():
        searcher = Searcher(pickle.loads(zlib.decompress(shared.value)), window)

        def search(texts):
            n_words, spans, items = [], [], []
            for text in texts:
                w = word_list(text)
                hit, found = searcher(b" " + b" ".join(w) + b" ")
                n_words.append(len(w))
                spans.append(_merged(hit))
                items.append(sorted(i for i in found if i is not None))
            return [n_words, spans, items]

        return search

    return per_text(docs, make, _FIELDS, keep)


# spans (first, words) in order, those that touch made one
_MERGE = """
aggregate(array_sort(hits), CAST(array() AS array<array<int>>), (s, x) -> if(
  size(s) > 0 AND x[0] <= element_at(s, -1)[0] + element_at(s, -1)[1],
  concat(slice(s, 1, size(s) - 1), array(array(element_at(s, -1)[0],
    greatest(element_at(s, -1)[1], x[0] + x[1] - element_at(s, -1)[0])))),
  concat(s, array(x))))
"""


def _dealt(benchmark: DataFrame, part_chars: int) -> tuple[DataFrame, int]:
    """item_id, text and part of the different items, and the number of parts. Items of one text may lie in several parts, so a text
    under very many ids is divided as well."""
    items = benchmark.where("text IS NOT NULL").select(F.col("item_id").cast("string").alias("item_id"), "text").distinct()
    chars = items.agg(F.sum(F.length("text") + F.coalesce(F.length("item_id"), F.lit(0)))).first()[0] or 0
    n_parts = chars // part_chars + 1
    return items.withColumn("part", F.pmod(F.xxhash64("text", "item_id"), F.lit(n_parts))), n_parts


def find_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, part_chars: int = PART_CHARS, keep=None) -> DataFrame:
    """row (the kept columns), n_words, hits (first word and number of words of merged hit spans), ids of items found.

    A benchmark of more than ``part_chars`` characters is searched in parts, one pass over the documents for each: the driver
    and the broadcast hold one part at a time (of about that size; a single longer text is a part). What a pass finds is
    written to a table by the hash of the text, so only texts with hits are joined back."""
    context = docs.sparkSession.sparkContext
    items, n_parts = _dealt(benchmark, part_chars)

    def sent(k: int) -> Broadcast:
        rows = items.where(F.col("part") == k).select("item_id", "text").collect()
        return context.broadcast(zlib.compress(pickle.dumps([tuple(r) for r in rows])))

    if n_parts == 1:
        return _find(docs, sent(0), window, keep)
    kept = docs.columns if keep is None else list(keep)
    key = {"h": F.xxhash64("text"), "g": F.xxhash64(F.lit(1), "text")}
    texts = docs.select("text").withColumns(key)
    parts = []
    for k in range(n_parts):
        shared = sent(k)
        found = _find(texts, shared, window, ("h", "g")).where(F.size("hits") > 0).select("row.*", "hits", "items")
        parts.append(saved(found.dropDuplicates(["h", "g"])))
        shared.destroy()
    every = reduce(DataFrame.union, parts).groupBy("h", "g").agg(
        F.flatten(F.collect_list("hits")).alias("hits"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")
    )
    every = saved(every.select("h", "g", F.expr(_MERGE).alias("hits"), "items"))
    count = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), count.alias("n_words"), *[c.alias(n) for n, c in key.items()])
    none = [F.array().cast(_FIELDS[c][0]).alias(c) for c in ("hits", "items")]
    clean = maybe_in(packed, ["h", "g"], every, "left_anti").select("row", "n_words", *none)
    hit = maybe_in(packed, ["h", "g"], every).join(every, ["h", "g"], "left")
    return clean.union(hit.select("row", "n_words", *[F.coalesce(c, n).alias(c) for c, n in zip(("hits", "items"), none)]))


def decontamination(docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] | None = None) -> DataFrame:
    """row (the kept columns) and the verdict: contaminated if at least a twentieth of a document's words is hit."""
    found = find_benchmark(docs, benchmark, keep=keep)
    n_hit = F.expr("aggregate(hits, 0L, (n, h) -> n + h[1])")
    return found.select("row", "n_words", n_hit.alias("n_hit"), "items").select(
        "row",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("items"), ",").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def op3_decontaminate(spark, sf_dir) -> DataFrame:
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return decontamination(docs, benchmark, ("doc_id",)).select(
        "row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


OP3_SQL = r"""
WITH word AS (
  SELECT r, doc_id, w FROM (
    SELECT row_number() OVER () AS r, doc_id,
      regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents)
),
item AS (
  SELECT item_id, w, least(13, len(w)) AS k FROM (
    SELECT item_id,
      regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark) WHERE len(w) > 0
),
pat AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS p
  FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM item)
),
win AS (
  SELECT r, i, k, array_to_string(w[i : i + k - 1], ' ') AS p
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM word, (SELECT DISTINCT k FROM pat) WHERE len(w) >= k)
),
hit AS (SELECT r, i, win.k, item_id FROM win JOIN pat ON win.k = pat.k AND win.p = pat.p),
places AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS j FROM hit) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM word LEFT JOIN places USING (r) LEFT JOIN items USING (r)
"""
