"""Exact top-k inner products by no-random-access aggregation of sorted lists.

Candidates are dealt out to shards of bounded size. A shard keeps one list a component, its rows sorted by that component.
Queries come to it in blocks, one after the other:

1. The lists are read sequentially, from both ends at once, a stretch a round. A component that was read is known; one that
   was not lies between the two values read last in its list.
2. So each row has a lower and an upper bound of its score: per query the known components exactly, the others at the better
   and at the worse end. Bounds of a block of queries are matrix products.
3. The k-th best lower bound is what a row must reach. A query is decided as soon as only few rows can still reach it; the
   others, seen or not, cannot qualify. If the lists end first, the bounds are the scores.
4. For the few, final scores are resolved from the whole vectors, in integers.

The best k of every shard are merged by query. Shards and blocks are bounded, so memory does not grow with the input, and no
query set or candidate set is held by the driver. Each shard is a group of rows of its own; a lost task reads its shard again.

Defined cases: null vectors, and those that hold nulls or non-finite components, take no part, nor do rows without vec_id;
of rows that share a vec_id the smallest vector counts, so an id is found once; shorter vectors count as padded with zeros, an
empty one is all zeros; equal scores go to the smaller vec_id; components are held within plus and minus 2^24 after scaling, so
that scores of up to 2^14 components fit a long; other columns are ignored; without queries or candidates there are no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sommelix.llm.common import cut, table

#: A shard has at most so many components in all; so do the bounds of a block of queries.
CELLS = 1 << 22
#: Smaller shards than this are not made only to have more tasks.
SHARD_ROWS = 4096
#: Shares of the lists that are read from each end by the end of each round; then they have been read whole.
DEPTHS = (1 / 16, 1 / 8, 3 / 16, 1 / 4, 9 / 32, 5 / 16, 3 / 8, 1 / 2)
#: A query is decided when at most this share of a shard's rows can still qualify, or k of them.
FEW = 1 / 64
LIMIT = float(1 << 24)
FOUND = "query_id bigint, vec_id bigint, score bigint"


def scaled(embedding: Column, scale: float = 256.0) -> Column:
    """Integer components, floor(scale * x); null where the vector takes no part."""
    values = F.transform(embedding, lambda x: F.floor(F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), scale * x.cast("double")))).cast("int"))
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(embedding.isNotNull() & ~bad, values)


def vectors(rows: DataFrame, scale: float = 256.0) -> DataFrame:
    """(vec_id, v) of the rows that take part, one for each id."""
    made = rows.select(F.col("vec_id").cast("long").alias("vec_id"), scaled(F.col("embedding"), scale).alias("v"))
    return made.where("vec_id IS NOT NULL AND v IS NOT NULL").groupBy("vec_id").agg(F.min("v").alias("v"))


class Lists:
    """A shard's sorted lists, and its rows for the final scores."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        self.order = np.argsort(self.rows, axis=0, kind="stable").T.astype(np.int32)

    def reading(self) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """After each round: the highest and the lowest that every component can be, and whether all has been read."""
        n, d = self.rows.shape
        known = np.zeros((n, d), bool)
        at = 0
        for depth in DEPTHS:
            upto = min(-(-n // 2), max(at + 1, int(n * depth))) if depth < 1 / 2 else -(-n // 2)
            for j in range(d):
                known[self.order[j, at:upto], j] = True
                known[self.order[j, n - upto : n - at], j] = True
            every = np.arange(d)
            low, high = self.rows[self.order[:, upto - 1], every], self.rows[self.order[:, n - upto], every]
            yield np.where(known, self.rows, high), np.where(known, self.rows, low), 2 * upto >= n
            if 2 * upto >= n:
                return
            at = upto

    def top(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row's id, score) of the best k rows of every query, its own id left out."""
        n, found = len(self.ids), []
        own = np.searchsorted(self.ids, query_ids)
        mine = (own < n) & (self.ids[np.minimum(own, n - 1)] == query_ids)
        # sums of float products are exact below 2^53; beyond it, bounds give way by more than their rounding
        most = float(np.abs(queries).max(initial=0)) * float(np.abs(self.rows).max(initial=0)) * max(1, self.rows.shape[1])
        slack = 0.0 if most < 2**52 else most * 2.0**-40
        open_ = np.arange(len(query_ids))
        for high, low, last in self.reading():
            if not len(open_):
                break
            up, down = np.maximum(queries[open_], 0), np.minimum(queries[open_], 0)
            lower, upper = up @ low.T + down @ high.T - slack, up @ high.T + down @ low.T + slack
            at = np.flatnonzero(mine[open_])
            lower[at, own[open_[at]]] = upper[at, own[open_[at]]] = -np.inf
            bar = np.partition(lower, n - k, axis=1)[:, n - k] if n > k else np.full(len(open_), -np.inf)
            near = (upper >= bar[:, None]) & (upper > -np.inf)
            decided = np.full(len(open_), True) if last else near.sum(axis=1) <= max(k, n * FEW)
            which, rows = np.nonzero(near[decided])
            found.append(self.resolved(open_[decided][which], rows, query_ids, queries, k))
            open_ = open_[~decided]
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (query_ids[:0], query_ids[:0], query_ids[:0])

    def resolved(self, which: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
        """Final scores of the rows that may qualify, a stretch at a time, and the best k of each query."""
        scores = np.zeros(len(rows), np.int64)
        step = max(1, CELLS // 4 // max(1, queries.shape[1]))
        for s in range(0, len(rows), step):
            a, b = queries[which[s : s + step]].astype(np.int64), self.rows[rows[s : s + step]].astype(np.int64)
            scores[s : s + step] = np.einsum("ij,ij->i", a, b)
        order = np.lexsort((rows, -scores, which))  # rows are in the order of their ids
        which, rows, scores = which[order], rows[order], scores[order]
        rank = np.arange(len(which)) - np.searchsorted(which, which)
        best = rank < k
        return query_ids[which[best]], self.ids[rows[best]], scores[best]


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Rows as doubles, padded with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width))
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def search(batches: Iterator[pa.RecordBatch], width: int, k: int) -> Iterator[pa.RecordBatch]:
    """Rows (shard, is_query, vec_id, v) sorted by the first two: a shard's candidates, then its queries."""
    shard, lists, ids, rows = None, None, [], []
    for batch in batches:
        shards = batch.column("shard").to_numpy()
        asks = batch.column("is_query").to_numpy(zero_copy_only=False)
        ends = np.flatnonzero((shards[1:] != shards[:-1]) | (asks[1:] != asks[:-1])) + 1
        for s, e in zip(np.append(0, ends), np.append(ends, len(shards))):
            if s == e:
                continue
            if shards[s] != shard:
                shard, lists, ids, rows = shards[s], None, [], []
            part_ids = batch.column("vec_id").slice(s, e - s).to_numpy()
            part = _matrix(batch.column("v").slice(s, e - s), width)
            if not asks[s]:
                ids.append(part_ids)
                rows.append(part)
                continue
            if lists is None:
                if not ids:
                    continue
                lists = Lists(np.concatenate(ids), np.concatenate(rows))
                ids, rows = [], []
            block = max(1, CELLS // len(lists.ids))
            for b in range(0, e - s, block):
                found = lists.top(part_ids[b : b + block], part[b : b + block], k)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names=["query_id", "vec_id", "score"])


def top_k(rows: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row (vec_id, embedding) that is a query, the k others of the largest inner
    product of scaled, floored components."""
    spark = rows.sparkSession
    all_rows = cut(vectors(rows, scale))
    size = all_rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    width = max(1, size["width"] or 0)
    fill = min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size["n"] // SHARD_ROWS))
    shards = max(1, fill, -(-size["n"] * width // CELLS))
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    candidates = all_rows.select(shard.alias("shard"), F.lit(False).alias("is_query"), "vec_id", "v")
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    asked = all_rows.where(is_query).select(every.alias("shard"), F.lit(True).alias("is_query"), "vec_id", "v")
    dealt = candidates.union(asked).repartition(shards, "shard").sortWithinPartitions("shard", "is_query")
    found = dealt.mapInArrow(lambda batches: search(batches, width, k), FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op12_top_k(spark, sf_dir) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP12_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(c.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
