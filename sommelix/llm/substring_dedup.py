"""Substring dedup by compressed FM-indexes.

A window of 35 words goes if the same words also start anywhere else. Windows that are equal have the same minimizer: the
smallest hash among their runs of 12 words. Neighbouring windows with one minimizer form a segment, and segments are
sent to shards by minimizer, so equal windows always meet.

1. A bitmap of fixed size tells which minimizers occur more than once; segments of others end here, without being moved.
2. Segments are described by a hash of all their words. Segments that occur twice as a whole go as a whole; copies are thus
   counted, not gathered.
3. Minimizers with several different segments (or one that may overlap itself) need a search. Each different segment is
   sent once, as text. A shard takes groups of minimizers of up to ``SHARD_WORDS`` words, builds an FM-index over them (the
   Burrows-Wheeler transform in a wavelet matrix of packed bits, with the words that neighbouring suffixes share) and streams
   the segments through it in stretches: backward search over the wavelet matrix gives the matching statistics, how many words from
   each place on occur at two places or more. Intervals of 35 words or more are reported.
4. Minimizers with more than ``HOT`` different segments, as at the edges of a passage that very many documents
   share, or with more than ``HOT_WORDS`` words in them, as in text that repeats a short line, are not gathered: their
   windows are counted by a hash of 128 bits. So a shard has at most ``SHARD_WORDS`` and ``HOT_WORDS`` words together.
5. Reported windows go back to their documents.

Defined cases: null texts have no words and keep the empty string; texts shorter than a window stay; repeated rows repeat all
their windows, so all go; null ids are ids of their own; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sommelix.llm.bitmap import PACKED, bitmap, known, n_bits, n_buckets, pack, present
from sommelix.llm.common import cut, maybe_in, saved
from sommelix.llm.hashing import ODD, OTHER, RunHasher, WordHasher, mix

WINDOW = 35
RUN = 12
SHARD_WORDS = 400_000
HOT = 4000
HOT_WORDS = 400_000
#: Stretches of segments that are searched side by side.
STREAMED = 20_000


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


class Segments:
    """A document's segments: first window, number of windows, minimizer, hash of all words."""

    def __init__(self, hasher: RunHasher, words: np.ndarray, window: int = WINDOW, run: int = RUN):
        n = len(words) - window + 1
        if n <= 0:
            self.starts = self.counts = np.zeros(0, np.int64)
            self.keys = self.codes = np.zeros(0, np.uint64)
            self.folded = np.zeros(0, bool)
            return
        hasher.load(words)
        at = np.arange(len(words) - run + 1)
        low = every = hasher(at, at + run)
        width, span = window - run + 1, 1
        while 2 * span <= width:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if rest := width - span:
            low = np.minimum(low[:-rest], low[rest:])
        self.starts = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
        self.counts = np.diff(np.append(self.starts, n))
        self.keys = low[self.starts]
        self.codes = hasher(self.starts, self.starts + self.counts + window - 1)
        #: the minimizer stands at two places in the segment, so the segment may overlap itself
        self.folded = np.zeros(len(self.starts), bool)
        ordered = np.sort(every)
        if (ordered[1:] == ordered[:-1]).any():
            ends = self.starts + self.counts + width - 1
            self.folded[:] = [np.count_nonzero(every[a:b] == k) > 1 for a, b, k in zip(self.starts, ends, self.keys)]


class WaveletMatrix:
    """Symbols by bits from the highest down, each level in packed words with running counts."""

    def __init__(self, symbols: np.ndarray):
        self.levels = max(1, int(symbols.max()).bit_length())
        self.bits, self.counts, self.zeros = [], [], []
        for level in range(self.levels - 1, -1, -1):
            on = (symbols >> level) & 1
            packed = np.packbits(on.astype(np.uint8), bitorder="little")
            packed = np.append(packed, np.zeros(8 + -len(packed) % 8, np.uint8)).view(np.uint64)
            self.bits.append(packed)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)]).astype(np.int32))
            self.zeros.append(int(len(on) - on.sum()))
            symbols = np.concatenate([symbols[on == 0], symbols[on == 1]])

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Where the wavelet matrix puts (symbol, place): the symbol's start plus its number before the place."""
        for k in range(self.levels):
            word = places >> 6
            below = (np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.counts[k][word] + np.bitwise_count(self.bits[k][word] & below)
            places = np.where((symbols >> (self.levels - 1 - k)) & 1 == 1, self.zeros[k] + ones, places - ones)
        return places


class FmIndex:
    """Full-text index of word numbers (0 separates) for runs of up to ``longest`` words: suffixes sorted by doubling, as far as such
    runs need, their preceding words in a wavelet matrix, and how far neighbouring suffixes agree."""

    def __init__(self, sequence: np.ndarray, longest: int):
        n = len(sequence)
        ranks, step = [np.unique(sequence, return_inverse=True)[1].astype(np.int64)], 1
        while True:
            later = np.full(n, -1, np.int64)
            later[: max(0, n - step)] = ranks[-1][step:]
            code = ranks[-1] * (n + 1) + later + 1
            order = np.argsort(code, kind="stable")
            code = code[order]
            rank = np.zeros(n, np.int64)
            rank[order] = np.concatenate([[0], np.cumsum(code[1:] != code[:-1])])
            ranks.append(rank)
            step *= 2
            if rank[order[-1]] == n - 1 or step >= longest:
                break
        before = sequence[order - 1]  # the first suffix is preceded by the last symbol, a separator
        self.size = n
        self.matrix = WaveletMatrix(before)
        every = np.arange(int(sequence.max()) + 1)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(sequence, minlength=len(every)))])[:-1]
        self.base = self.matrix.rank(every, np.zeros(len(every), np.int64))
        self.common = self._common(order, ranks)
        self.smaller_before = self._nearest_smaller(self.common)
        self.smaller_after = n - self._nearest_smaller(self.common[::-1])[::-1]

    @staticmethod
    def _common(order: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
        """Words in which each suffix agrees with the one sorted before it, at most those that were sorted by; -1 at both ends."""
        n = len(order)
        common = np.zeros(n - 1, np.int64)
        for level in range(len(ranks) - 1, -1, -1):
            rank = np.append(ranks[level], -1)
            a, b = np.minimum(order[:-1] + common, n), np.minimum(order[1:] + common, n)
            common += (rank[a] == rank[b]).astype(np.int64) << level
        return np.concatenate([[-1], np.minimum(common, 1 << (len(ranks) - 1)), [-1]])

    @staticmethod
    def _nearest_smaller(values: np.ndarray) -> np.ndarray:
        """The place of the nearest smaller value before each one; the first value is the smallest and stays at 0. Places jump along
        the chains of those before them."""
        near = np.maximum(np.arange(len(values)) - 1, 0)
        open_ = np.flatnonzero(values[near] >= values)
        while len(open_ := open_[near[open_] > 0]):
            near[open_] = near[near[open_]]
            open_ = open_[values[near[open_]] >= values[open_]]
        return near

    def back(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        return self.first[symbols] + self.matrix.rank(symbols, places) - self.base[symbols]

    def statistics(self, sequence: np.ndarray, first: np.ndarray, stop: np.ndarray, last: np.ndarray) -> list[np.ndarray]:
        """Matching statistics of stretches of a sequence: for each place of [first, stop) the words from there on, none beyond
        ``last``, that occur at two places or more. All stretches are read side by side from their last word backwards. A
        word that leaves one place only shortens the match to the parent interval, till two places go on or nothing is left."""
        lengths = np.zeros((len(first), int((stop - first).max())), np.int32)
        lane, at = np.arange(len(first)), last - 1
        low, high, length = np.zeros(len(first), np.int64), np.full(len(first), self.size, np.int64), np.zeros(len(first), np.int64)
        while len(lane):
            symbols = sequence[at]
            ends = self.back(np.tile(symbols, 2), np.concatenate([low, high]))
            lower, higher = ends[: len(lane)], ends[len(lane) :]
            on = higher - lower >= 2
            # the parent of those that do not go on: as much of the match as a neighbouring suffix has as well
            side = np.where(self.common[low] >= self.common[high], low, high)
            shorter = np.maximum(self.common[side], 0)
            none = ~on & (length == 0)
            low = np.where(on, lower, np.where(shorter > 0, self.smaller_before[side], 0))
            high = np.where(on, higher, np.where(shorter > 0, self.smaller_after[side], self.size))
            length = np.where(on, length + 1, np.where(none, 0, shorter))
            done = on | none
            note = done & (at < stop[lane])
            lengths[lane[note], (at - first[lane])[note]] = length[note]
            at = at - done
            rest = at >= first[lane]
            lane, at, low, high, length = lane[rest], at[rest], low[rest], high[rest], length[rest]
        return [x[:n] for x, n in zip(lengths, (stop - first).tolist())]


def search_shard(texts: list[bytes], window: int = WINDOW) -> list[list[list[int]]]:
    """For each segment the intervals (first word, number of words) of at least a window that occur at two places or more in all
    of them, none within another. Segments are streamed in stretches of two windows; a match is followed for at least a
    window beyond each of their places, so an interval that is longer comes in pieces that overlap by all but a word of a window."""
    numbers: dict[bytes, int] = {}
    parts, sizes = [], []
    for text in texts:
        words = text.split(b" ")
        sizes.append(len(words))
        parts += [numbers.setdefault(w, len(numbers) + 1) for w in words]
        parts.append(0)
    sequence = np.array(parts, np.int64)
    sizes = np.array(sizes)
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    counts = np.maximum(sizes - window + 1, 0)
    stretch = 2 * window
    n = -(-counts // stretch)
    of = np.repeat(np.arange(len(texts)), n)
    offset = stretch * (np.arange(len(of)) - np.repeat(np.concatenate([[0], np.cumsum(n)])[:-1], n))
    index = FmIndex(sequence, stretch + window)
    out: list[list[list[int]]] = [[] for _ in texts]
    for a in range(0, len(of), STREAMED):
        some, off = of[a : a + STREAMED], offset[a : a + STREAMED]
        ends = np.minimum(off + stretch, counts[some])
        found = index.statistics(sequence, begins[some] + off, begins[some] + ends, begins[some] + ends + window - 1)
        for i, o, lengths in zip(some.tolist(), off.tolist(), found):
            longest = lengths >= window
            longest[1:] &= lengths[1:] >= lengths[:-1]  # others end with the interval that starts a word before
            out[i] += [[o + int(k), int(lengths[k])] for k in np.flatnonzero(longest)]
    return out


def _runs(intervals: list[list[int]], window: int) -> list[list[int]]:
    """Intervals in order as runs [first, count] of their windows; those that follow one another or overlap are one run."""
    runs: list[list[int]] = []
    for first, words in intervals:
        stop = first + words - window + 1
        if runs and first <= runs[-1][0] + runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], stop - runs[-1][0])
        else:
            runs.append([first, stop - first])
    return runs


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _places(kd: int, th: int, starts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of a place."""
    doc = np.array([kd, th], np.int64).view(np.uint64)
    return mix(mix(doc[:1] * ODD + doc[1:]) + starts.astype(np.uint64) * OTHER)


def repeated_windows(
    docs: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS, hot: int = HOT, hot_words: int = HOT_WORDS
) -> DataFrame:
    """kd, th, runs: for each document with any, runs (first, count) of windows whose words also start elsewhere. docs has
    kd, th (together a document's key) and text. The result is a table, so the bitmaps can go."""
    spark = docs.sparkSession
    context = spark.sparkContext
    # a minimizer for about 12 words
    n_keys = (docs.agg(F.sum(F.length("text"))).first()[0] or 0) // 40
    buckets, bits = n_buckets(n_keys), n_bits(n_keys)

    def of_documents(batches: Iterator[pd.DataFrame]):
        words, hasher = WordHasher(), RunHasher()
        for batch in batches:
            for kd, th, text in zip(batch["kd"], batch["th"], batch["text"]):
                segments = Segments(hasher, words(text), window)
                if len(segments.keys):
                    yield kd, th, text, segments, hasher

    def minimizers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = of_documents(batches)
        yield from pack((np.concatenate([s.keys, s.keys[s.folded]]) for _, _, _, s, _ in found), buckets)

    twice = context.broadcast(bitmap(docs.mapInPandas(minimizers, PACKED), buckets, 2, bits))
    held = [twice]

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, n = [], 0
        for kd, th, _, s, _ in of_documents(batches):
            on = known(twice.value, s.keys)
            if m := int(on.sum()):
                parts.append(
                    (np.full(m, kd), np.full(m, th), s.starts[on], s.counts[on], s.folded[on], _signed(s.keys[on]),
                     _signed(s.codes[on]), _signed(_places(kd, th, s.starts[on])))
                )
                n += m
            if n > 50_000:
                yield pd.DataFrame(dict(zip(columns, map(np.concatenate, zip(*parts)))))
                parts, n = [], 0
        if parts:
            yield pd.DataFrame(dict(zip(columns, map(np.concatenate, zip(*parts)))))

    columns = ["kd", "th", "start", "count", "folded", "key", "code", "place"]
    schema = "kd bigint, th bigint, start int, count int, folded boolean, key bigint, code bigint, place bigint"
    segments = saved(docs.mapInPandas(describe, schema))
    contents = cut(
        segments.groupBy("key", "code").agg(
            F.count("*").alias("times"), F.min(F.struct("kd", "th", "start", "count", "place")).alias("at"), F.max("folded").alias("folded")
        )
    )
    keys = cut(
        contents.groupBy("key")
        .agg(
            F.count("*").alias("n"), F.sum(F.col("at.count").cast("long") + (window - 1)).alias("words"), F.max("folded").alias("folded")
        )
        .where("n > 1 OR folded")
        .select("key", ((F.col("n") > hot) | (F.col("words") > hot_words)).alias("hot"))
    )

    # whole segments that occur twice
    copied = contents.where("times > 1").select("key", "code")
    marks = segments.join(copied, ["key", "code"]).select("kd", "th", "start", "count")

    # segments to search, each different one once
    searched = contents.join(keys.where("NOT hot").select("key"), "key")
    wanted = context.broadcast(present(searched.select("at.place"), buckets, bits))
    held.append(wanted)

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = []
        for kd, th, whole, s, _ in of_documents(batches):
            on = known(twice.value, s.keys)
            on[on] = known(wanted.value, _places(kd, th, s.starts[on]))
            words = split_words(whole) if on.any() else []
            for i in np.flatnonzero(on).tolist():
                text = b" ".join(words[s.starts[i] : s.starts[i] + s.counts[i] + window - 1])
                rows.append((_signed(s.keys)[i], _signed(s.codes)[i], text))
            if len(rows) > 5000:
                yield pd.DataFrame(rows, columns=["key", "code", "text"])
                rows = []
        yield pd.DataFrame(rows, columns=["key", "code", "text"])

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Groups of keys come sorted; whole groups are searched as soon as they are enough for a shard."""
        held: list[tuple[int, int, bytes]] = []
        n = 0

        def shard(rows):
            found = search_shard([t for _, _, t in rows], window)
            done = [(k, c, _runs(f, window)) for (k, c, _), f in zip(rows, found) if f]
            return pd.DataFrame(done, columns=["key", "code", "runs"])

        for batch in batches:
            for key, code, text in zip(batch["key"], batch["code"], batch["text"]):
                if held and held[-1][:2] == (key, code):  # equal segments count once
                    continue
                if n >= shard_words and held[-1][0] != key:
                    yield shard(held)
                    held, n = [], 0
                held.append((key, code, text))
                n += text.count(b" ") + 1
        if held:
            yield shard(held)

    texts = docs.mapInPandas(fetch, "key bigint, code bigint, text binary")
    found = texts.repartition("key").sortWithinPartitions("key", "code").mapInPandas(
        search, "key bigint, code bigint, runs array<array<int>>"
    )
    single = contents.where("times = 1").select("key", "code", "at")
    marks = marks.union(
        found.join(single, ["key", "code"]).select("at", F.explode("runs").alias("run"))
        .selectExpr("at.kd", "at.th", "CAST(at.start + run[0] AS INT)", "run[1]")
    )

    # windows of minimizers with very many different segments, or very long ones
    many = keys.where("hot").select("key")
    if not many.isEmpty():
        hot_keys = context.broadcast(present(many, buckets, bits))
        held.append(hot_keys)

        def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for kd, th, _, s, hasher in of_documents(batches):
                if (on := known(hot_keys.value, s.keys)).any():
                    at = np.concatenate([np.arange(a, a + c) for a, c in zip(s.starts[on], s.counts[on])])
                    one, two = (_signed(hasher(at, at + window, second)) for second in (False, True))
                    yield pd.DataFrame({"kd": kd, "th": th, "start": at, "one": one, "two": two})

        each = saved(docs.mapInPandas(windows, "kd bigint, th bigint, start int, one bigint, two bigint"))
        again = each.groupBy("one", "two").count().where("count > 1").select("one", "two")
        places = each.join(again, ["one", "two"]).select("kd", "th", "start").distinct()
        # neighbouring windows become one run, so a document's runs stay few
        rank = F.row_number().over(Window.partitionBy("kd", "th").orderBy("start"))
        islands = places.withColumn("island", F.col("start") - rank).groupBy("kd", "th", "island")
        marks = marks.union(islands.agg(F.min("start"), F.count("*").cast("int")).drop("island"))

    runs = saved(marks.groupBy("kd", "th").agg(F.collect_set(F.struct("start", "count")).alias("runs")))
    for shared in held:
        shared.destroy()
    return runs


def dedup_substrings(
    docs: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS, hot: int = HOT, hot_words: int = HOT_WORDS
) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words joined by single spaces, of every document."""
    keyed = docs.select(
        "doc_id",
        "text",
        F.xxhash64("doc_id", "text").alias("kd"),
        F.xxhash64(F.lit("other"), "text", "doc_id").alias("th"),
    )
    runs = repeated_windows(keyed.select("kd", "th", "text"), window, shard_words, hot, hot_words)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, kept = [], [], []
            for text, own in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist()):
                words = split_words(text)
                sizes.append(len(words))
                if own:
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, [r["start"] for r in own], 1)
                    np.add.at(edge, [r["start"] + r["count"] + window - 1 for r in own], -1)
                    words = [w for w, n in zip(words, np.cumsum(edge).tolist()) if not n]
                removed.append(sizes[-1] - len(words))
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            new = [pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *new], names=["doc_id", "n_words", "n_removed", "kept"])

    # only texts that may have windows to remove are moved
    keys = ["kd", "th"]
    placed = maybe_in(keyed, keys, runs).join(runs, keys, "left").select("doc_id", "text", "runs")
    kind = runs.schema["runs"].dataType.simpleString()
    rest = maybe_in(keyed, keys, runs, "left_anti").select("doc_id", "text", F.lit(None).cast(kind).alias("runs"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return placed.union(rest).mapInArrow(remove, f"doc_id {kind}, n_words bigint, n_removed bigint, kept string")


def op4_substring_dedup(spark, sf_dir) -> DataFrame:
    out = dedup_substrings(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
win AS (
  SELECT r, i, md5(array_to_string(w[i : i + 34], ' ')) AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)
),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY g) AS n FROM win) WHERE n > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS j FROM again),
kept AS (
  SELECT w.r, count(gone.r) AS n_removed, string_agg(x, ' ' ORDER BY w.j) FILTER (gone.r IS NULL) AS kept
  FROM (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS j FROM d) w LEFT JOIN gone ON w.r = gone.r AND w.j = gone.j
  GROUP BY w.r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""
