"""Token counts by an exact histogram of encoded lengths.

Documents are encoded where they lie and only their lengths go on: one row for each distinct length. Suffix sums over
that histogram answer, for every context limit, how many documents and tokens lie at or above it, what truncating at it
keeps, and the quantiles. Suffix sums go by blocks of lengths (within blocks, then over blocks), so no window holds
more than ``BLOCK`` lengths or one row for each block.

Runs of LONG or more blanks, on which the encoder's pattern matcher would overflow its stack, are found beforehand: the
pattern always makes one piece of all of a run, or of all but its last blank where something follows, and that piece is
merged without the matcher. The count is the same.

Defined cases: null and empty texts have length 0; a text is encoded whole, of whatever length; special tokens' strings are ordinary text;
repeated rows count as often as they occur; an empty table gives an empty histogram; other columns are ignored.
"""

from __future__ import annotations

import base64
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sommelix.llm.common import cut, per_text

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the public pattern that splits text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCK = 1024
LONG = 1000
#: The characters that are blanks to the pattern.
BLANKS = "\t\n\v\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def counter(table: dict[bytes, int], pattern: str = PATTERN):
    """A function that gives a text's number of tokens. Long runs of blanks are taken apart for PATTERN only."""
    import tiktoken

    encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    runs = re.compile(f"[{BLANKS}]{{{LONG},}}")

    def count(text: str | None) -> int:
        n = at = 0
        for run in runs.finditer(text or "") if pattern == PATTERN else ():
            end = run.end() if run.end() == len(text) else run.end() - 1
            n += len(encoding.encode_ordinary(text[at : run.start()])) + len(encoding._encode_single_piece(text[run.start() : end]))
            at = end
        return n + (len(encoding.encode_ordinary(text[at:])) if text else 0)

    return count


def token_lengths(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """doc_id and n_tokens of every document. The vocabulary file is read on the driver and broadcast (under 1 MB)."""
    with open(vocabulary, "rb") as f:
        ranks = f.read()
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def make():
        count = counter({base64.b64decode(a): int(b) for a, b in map(bytes.split, shared.value.splitlines())}, pattern)
        return lambda texts: [list(map(count, texts))]

    return per_text(docs, make, {"n_tokens": ("bigint", pa.int64())}, ("doc_id",)).select("row.doc_id", "n_tokens")


def length_histogram(lengths: DataFrame) -> DataFrame:
    return lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def at_every_limit(histogram: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row for each occurring length, taken as a context limit. The histogram is used twice and so made once."""
    histogram = cut(histogram)
    rows = histogram.withColumns({"block": F.floor(F.col("n_tokens") / block), "tokens": F.col("n_tokens") * F.col("n_docs")})
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    above = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("d").over(above), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("t").over(above), F.lit(0)).alias("tokens_above"),
        F.sum("d").over(every).alias("total_docs"),
        F.sum("t").over(every).alias("total_tokens"),
    )
    inside = Window.partitionBy("block").orderBy(F.col("n_tokens").desc())
    sums = rows.join(blocks, "block").select(
        "n_tokens",
        "n_docs",
        (F.sum("n_docs").over(inside) + F.col("docs_above")).alias("docs_at_least"),
        (F.sum("tokens").over(inside) + F.col("tokens_above")).alias("tokens_at_least"),
        "total_docs",
        "total_tokens",
    )
    longer = F.col("docs_at_least") - F.col("n_docs")
    return sums.withColumns(
        {
            "docs_longer": longer,
            # documents up to the limit keep all, longer ones the limit
            "truncated_tokens": F.col("total_tokens")
            - (F.col("tokens_at_least") - F.col("n_tokens") * F.col("n_docs"))
            + F.col("n_tokens") * longer,
            "quantile": (F.col("total_docs") - longer) / F.col("total_docs"),
        }
    )


def truncated_at(limits: DataFrame, contexts: list[int]) -> DataFrame:
    """Tokens kept when every document is cut at each of the given context lengths, occurring as lengths or not."""
    wanted = limits.sparkSession.createDataFrame([(int(c),) for c in contexts], "context bigint")
    # at_every_limit's own columns at the longest occurring length up to the limit
    below = limits.crossJoin(F.broadcast(wanted)).where("n_tokens <= context").groupBy("context").agg(
        F.max_by(F.struct("truncated_tokens", "n_tokens", "docs_longer"), "n_tokens").alias("x")
    )
    total = limits.agg(F.max("total_docs").alias("all_docs"))
    return wanted.join(below, "context", "left").crossJoin(F.broadcast(total)).select(
        "context",
        F.coalesce(
            F.col("x.truncated_tokens") + (F.col("context") - F.col("x.n_tokens")) * F.col("x.docs_longer"),
            F.col("context") * F.col("all_docs"),
            F.lit(0),
        ).alias("truncated_tokens"),
    )


def quantiles(limits: DataFrame, probabilities: list[float]) -> DataFrame:
    """The smallest length that at least the given share of documents does not exceed."""
    wanted = limits.sparkSession.createDataFrame([(float(p),) for p in probabilities], "p double")
    return limits.crossJoin(F.broadcast(wanted)).where("quantile >= p").groupBy("p").agg(F.min("n_tokens").alias("n_tokens"))


def op2_token_count(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return at_every_limit(length_histogram(token_lengths(docs)))
