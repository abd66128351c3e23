"""Quality rules with verdicts by host.

Each document is measured by fixed rules. Failures are then counted by host, each host's failure rate is shrunk
towards the common rate by a beta prior fitted to the hosts themselves (method of moments), and documents of hosts
whose shrunk rate passes a threshold are rejected too. Everything is DataFrame expressions: the text is read once
and only the narrow table of measures is shuffled.

Defined cases: a null text is an empty text (no words, so it fails); a null host is one host of its own; repeated
rows count as often as they occur; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sommelix.llm.common import cut, words

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
#: A host goes when its shrunk failure rate is above this.
MAX_HOST_RATE = 0.6

# Three-word windows are hashed and sorted with their places; a window that equals a neighbour occurs twice. The places
# are then merged into covered words. array(x) ... [0] names a value once instead of computing it at each use.
_REPEATED = """
if(size(words) < 4, 0L, transform(array(words), w -> aggregate(
  transform(
    array(sort_array(transform(sequence(0, size(w) - 3), i -> struct(xxhash64(w[i], w[i + 1], w[i + 2]) AS h, i AS p)))),
    s -> sort_array(transform(
      filter(s, (x, j) -> (j > 0 AND s[j - 1].h = x.h) OR (j < size(s) - 1 AND s[j + 1].h = x.h)), x -> x.p)))[0],
  struct(0L AS n, 0 AS e),
  (a, p) -> struct(a.n + (p + 3 - greatest(p, a.e)) AS n, p + 3 AS e),
  a -> a.n))[0])
"""
_LINES = r"filter(split(coalesce(text, ''), '\n'), x -> x RLIKE '[^\\x20\\x09-\\x0D]')"


def measure(docs: DataFrame, host: str = "source") -> DataFrame:
    """One narrow row for each document: its measures and whether it fails by itself."""
    text = F.coalesce(F.col("text"), F.lit(""))
    wide = docs.select("doc_id", F.col(host).alias("host"), "text", words(F.col("text")).alias("words"))
    counted = wide.select(
        "doc_id",
        "host",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.expr(f"transform(array({_LINES}), l -> size(l) - size(array_distinct(l)))[0]").cast("long").alias("n_dup_lines"),
        F.expr(_REPEATED).cast("long").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def host_rates(measured: DataFrame) -> DataFrame:
    """Failures by host, and the rate shrunk by the beta prior that the hosts' own rates give."""
    hosts = measured.groupBy("host").agg(
        F.count("*").alias("host_docs"), F.count_if("base_failed").alias("host_failures")
    )
    rate = F.col("host_failures") / F.col("host_docs")
    prior = hosts.agg(F.avg(rate).alias("mean"), F.coalesce(F.var_samp(rate), F.lit(0.0)).alias("var")).select(
        "mean",
        # a + b of the prior; hosts that hardly differ give a strong prior, hosts at 0 or 1 a weak one
        F.when(F.col("var") <= 0, F.lit(1000.0))
        .otherwise(F.least(F.lit(1000.0), F.greatest(F.lit(2.0), F.col("mean") * (1 - F.col("mean")) / F.col("var") - 1)))
        .alias("strength"),
    )
    shrunk = (F.col("host_failures") + F.col("mean") * F.col("strength")) / (F.col("host_docs") + F.col("strength"))
    return hosts.crossJoin(F.broadcast(prior)).select("host", "host_docs", "host_failures", shrunk.alias("host_rate"))


def host_rules(docs: DataFrame, host: str = "source", max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Measures, base verdict, host figures and the final ``kept`` for every document."""
    measured = cut(measure(docs, host))
    hosts = host_rates(measured).withColumnRenamed("host", "h")
    joined = measured.join(hosts, F.col("host").eqNullSafe(F.col("h")), "left").drop("h")
    return joined.withColumn("kept", ~F.col("base_failed") & (F.col("host_rate") <= max_host_rate))


def op10_host_rules(spark, sf_dir) -> DataFrame:
    return host_rules(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "host_docs", "host_failures",
    )


OP10_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d),
grams AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)
),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1),
cover AS (
  SELECT r, sum(least(3, coalesce(nxt - i, 3))) AS n
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM twice) GROUP BY r
),
lines AS (
  SELECT r, count(*) - count(DISTINCT l) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r
),
m AS (
  SELECT d.doc_id, d.source, CAST(len(w.w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(d.text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(d.text) - length(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(cover.n, 0) AS BIGINT) AS n_repeat_words
  FROM d JOIN w USING (r) LEFT JOIN cover USING (r) LEFT JOIN lines USING (r)
),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
h AS (SELECT source, count(*) AS host_docs, count(*) FILTER (base_failed) AS host_failures FROM f GROUP BY source),
p AS (SELECT avg(host_failures / host_docs) AS mean, coalesce(var_samp(host_failures / host_docs), 0) AS var FROM h),
s AS (SELECT mean, CASE WHEN var <= 0 THEN 1000.0
  ELSE least(1000.0, greatest(2.0, mean * (1 - mean) / var - 1)) END AS strength FROM p)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND (host_failures + mean * strength) / (host_docs + strength) <= 0.6 AS kept,
  host_docs, host_failures
FROM f JOIN h ON f.source IS NOT DISTINCT FROM h.source CROSS JOIN s
"""
