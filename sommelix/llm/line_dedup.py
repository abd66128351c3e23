"""Line dedup across all documents by a deletion-neighbourhood join.

A line is its words. Two lines are near if one word deleted, inserted or replaced makes them equal; both must have
``NEAR_WORDS`` words or more. Shorter lines match only when equal: one word is an eighth or more of them, so headings, list
items and table rows that differ in it say different things. A line goes if an earlier line, by document id and
place, is equal or near to it; whether that line stays itself does not matter, so no chain has to be followed.

1. Equal lines meet in one aggregation by their hash, which gives each distinct line's earliest place.
2. A near pair always shares its first or its last floor(words / 2) (or one less) words whole. Only lines that share
   such a half with another distinct line go on; most lines end here, for a few keys each.
3. These lines emit their deletion neighbourhood: the hash of the line without word i, for every i. Lines that agree in
   (hash, i) differ by one replacement; a line that equals another's variant differs by one deletion. The earliest
   member of such a key is near to all of the others that matter, so each line is compared with that one and pairs
    within a group never arise. The variants' hashes come from two running xors of word hashes, made in blocks of words, so
   very long lines cost hardly more for each word; they are written to a table once.
4. The word edit distance of line and candidate is verified on the words.

Everything is DataFrame expressions. Keys are pre-aggregated before they are joined back, and the joins are
plain equi-joins that adaptive execution may split, so a very common line or half does not gather in a task. Whole texts
are shuffled once, at the end, and only of documents that may have lines to remove. Before each join back, rows without a
partner are mostly left out by a broadcast of at most 2^22 numbers (hashes of the wanted keys), which only saves work: the
join that follows decides.

Defined cases: null texts have no lines and stay null; blank lines stay and never match; repeated rows of a document
are later copies whose lines all go; null ids are last; an empty table gives an empty result; extra columns of any
names stay untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sommelix.llm.common import cut, doc_key, maybe_in, saved, words

NEAR_WORDS = 8
_BLACK = r"[^\x20\x09-\x0D]"
_BLACK_SQL = _BLACK.replace("\\", "\\\\")


BLOCK = 64
# Running xors of h(word, place) and h(word, place - 1): within blocks of words, then over blocks. From them the hashes of
# the line itself and of the line without each word.
_NONE = "array(named_struct('a', 0L, 'b', 0L))"
_NEXT = "(s, x) -> concat(s, array(named_struct('a', element_at(s, -1).a ^ x.a, 'b', element_at(s, -1).b ^ x.b)))"
_HASHES = f"""
transform(array(transform(sequence(0, (size(w) - 1) DIV {BLOCK}), k -> aggregate(
    transform(slice(w, k * {BLOCK} + 1, {BLOCK}), (x, i) -> named_struct(
      'a', xxhash64(x, k * {BLOCK} + i), 'b', xxhash64(x, k * {BLOCK} + i - 1))),
    {_NONE}, {_NEXT}))),
  inner -> transform(array(aggregate(transform(inner, x -> element_at(x, -1)), {_NONE}, {_NEXT})),
    outer -> concat(
      array(element_at(outer, -1).a),
      flatten(transform(inner, (block, k) -> transform(slice(block, 1, size(block) - 1), (x, i) ->
        outer[k].a ^ x.a ^ element_at(outer, -1).b ^ outer[k].b ^ block[i + 1].b)))))[0])[0]
"""
# words two lines share at the start
_SHARED = "coalesce(nullif(array_position(zip_with(w, v, (a, b) -> a <=> b), false), 0) - 1, size(w))"
_NEAR = f"""
transform(array(CAST({_SHARED} AS INT)), p -> CASE size(w) - size(v)
  WHEN 0 THEN slice(w, p + 2, size(w)) = slice(v, p + 2, size(v))
  WHEN 1 THEN slice(w, p + 2, size(w)) = slice(v, p + 1, size(v))
  WHEN -1 THEN slice(w, p + 1, size(w)) = slice(v, p + 2, size(v))
  ELSE false END)[0]
"""


def removed_lines(docs: DataFrame, near_words: int = NEAR_WORDS) -> DataFrame:
    """doc, removed (the numbers of the lines that go, in order) and repeated, for each document that has any such line or is
    a repeated row."""
    raw = docs.select(doc_key().alias("doc"), F.posexplode(F.split("text", "\n")).alias("n", "line")).where(F.col("line").rlike(_BLACK))
    half, less = "CAST(floor(size(w) / 2) AS INT)", "CAST(floor((size(w) - 1) / 2) AS INT)"
    halves = F.when(
        F.size("w") >= near_words,
        F.array_distinct(
            F.array(
                *[F.expr(f"xxhash64('first', {n}, slice(w, 1, {n}))") for n in (half, less)],
                *[F.expr(f"xxhash64('last', {n}, slice(w, size(w) - {n} + 1, {n}))") for n in (half, less)],
            )
        ),
    )
    lines = saved(
        raw.select("doc", "n", words(F.col("line")).alias("w"))
        .select("doc", "n", F.unhex(F.md5(F.array_join("w", " ").cast("binary"))).alias("line"), halves.alias("halves"))
    )
    at = F.struct("doc", "n")

    # 1: the earliest place of lines that occur more than once
    several = cut(lines.groupBy("line").agg(F.min(at).alias("lead"), F.count("*").alias("times")).where("times > 1").drop("times"))
    again = maybe_in(lines.select("doc", "n", "line"), ["line"], several).join(several, "line").select("line", "lead", at.alias("at"))

    # 2: distinct lines that share a half with another one, at their earliest place, numbered in order
    keyed = lines.where("halves IS NOT NULL").select("line", "doc", "n", F.explode("halves").alias("half"))
    code = F.xxhash64("line")
    shared = cut(keyed.groupBy("half").agg(F.min(code).alias("a"), F.max(code).alias("b")).where("a <> b").select("half"))
    sharing = maybe_in(keyed, ["half"], shared).join(shared, "half").groupBy("line").agg(F.min(at).alias("at"))
    ranked = cut(
        sharing.repartitionByRange("at").sortWithinPartitions("at")
        .select("line", "at", F.monotonically_increasing_id().alias("pos"))
    )

    # 3: their words and variants
    places = ranked.select("at.doc", "at.n", "pos")
    near = cut(maybe_in(raw, ["doc", "n"], places).join(places, ["doc", "n"]).select("pos", words(F.col("line")).alias("w")))
    # v at 0 is the hash of the line itself, at i of the line without its i-th word; how many words are left is part of it
    left = F.col("size") - F.when(F.col("i") == 0, 0).otherwise(1)
    hashed = saved(
        near.select("pos", F.size("w").alias("size"), F.posexplode(F.expr(_HASHES)).alias("i", "h"))
        .select("pos", "i", F.xxhash64("h", left).alias("v"))
    )
    whole, without = hashed.where("i = 0").select("pos", "v"), hashed.where("i > 0")

    earliest = F.min("pos").alias("lead")
    replaced = cut(without.groupBy("v", "i").agg(earliest, F.count("*").alias("n")).where("n > 1").select("v", "i", "lead"))
    without = cut(maybe_in(without, ["v"], replaced.select("v").union(whole.select("v"))))
    candidates = (
        without.join(replaced, ["v", "i"]).select("pos", "lead")
        .union(without.join(whole.groupBy("v").agg(earliest), "v").select("pos", "lead"))
        .union(whole.join(without.groupBy("v").agg(earliest), "v").select("pos", "lead"))
        .where("lead < pos").distinct()
    )

    # 4: verified on the words
    other = near.select(F.col("pos").alias("lead"), F.col("w").alias("v"))
    gone = candidates.join(near, "pos").join(other, "lead").where(F.expr(_NEAR)).select("pos").distinct()
    too_near = ranked.join(gone, "pos").select("at")

    found = again.select("at", (F.col("at") == F.col("lead")).alias("first")).union(too_near.select("at", F.lit(False)))
    of = found.groupBy(F.col("at.doc").alias("doc")).agg(
        F.collect_set(F.when(~F.col("first"), F.col("at.n"))).alias("removed"),
        F.count_if("first").alias("firsts"),
        F.collect_set(F.when(F.col("first"), F.col("at.n"))).alias("places"),
    )
    # a place that is first more than once belongs to repeated rows of a document
    return of.select("doc", F.sort_array("removed").alias("removed"), (F.col("firsts") > F.size("places")).alias("repeated")).where(
        "repeated OR size(removed) > 0"
    )


def dedup_lines(docs: DataFrame, near_words: int = NEAR_WORDS) -> DataFrame:
    """docs as struct ``row``, its ``text`` without the lines that go, beside n_lines (with words) and n_removed."""
    packed = docs.select(doc_key().alias("doc"), F.struct("*").alias("row"))
    removed = saved(removed_lines(docs.where("text IS NOT NULL").select("doc_id", "text"), near_words))
    # only documents that may have lines to remove are moved
    once, several = removed.where("NOT repeated").drop("repeated"), removed.where("repeated").drop("repeated")
    none = F.array().cast("array<int>")
    moved = maybe_in(packed, ["doc"], removed)
    plain = moved.join(several.select("doc"), "doc", "left_anti").join(once, "doc", "left").select("row", F.coalesce("removed", none).alias("gone"))
    untouched = maybe_in(packed, ["doc"], removed, "left_anti").select("row", none.alias("gone"))
    out = untouched.union(plain)
    if not several.isEmpty():
        # of repeated rows one keeps what is left, the first in the first input partition with any; the others lose all
        copies = maybe_in(packed.withColumn("part", F.spark_partition_id()), ["doc"], several).join(several, "doc")
        lead = copies.groupBy("doc").agg(F.min("part").alias("lead"))
        number = F.row_number().over(Window.partitionBy("doc", "part").orderBy(F.lit(1)))
        copies = copies.withColumn("number", number).join(lead, "doc")
        stays = (F.col("part") == F.col("lead")) & (F.col("number") == 1)
        worded = F.expr(rf"filter(transform(split(row.text, '\n'), (x, i) -> if(x RLIKE '{_BLACK_SQL}', i, -1)), i -> i >= 0)")
        out = out.union(copies.select("row", F.when(stays, F.col("removed")).otherwise(worded).alias("gone")))
    # the pieces between the lines that go
    text = F.expr(
        r"""transform(array(split(row.text, '\n')), lines -> array_join(flatten(transform(sequence(0, size(gone)), k -> slice(lines,
        if(k = 0, 1, gone[k - 1] + 2), coalesce(get(gone, k), size(lines)) - if(k = 0, 0, gone[k - 1] + 1)))), '\n'))[0]"""
    )
    return out.select(
        F.col("row").withField("text", F.when(F.size("gone") > 0, text).otherwise(F.col("row.text"))).alias("row"),
        F.coalesce(F.regexp_count("row.text", F.lit(rf"{_BLACK}[^\n]*")), F.lit(0)).cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("n_removed"),
    )


def op8_line_dedup(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select("row.doc_id", "n_lines", "n_removed", "row.text")


OP8_SQL = r"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id NULLS LAST, text) AS r, doc_id, text FROM documents),
raw AS (SELECT r, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS n FROM d),
l AS (
  SELECT r, n, w, array_to_string(w, ' ') AS k
  FROM (SELECT r, n, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w FROM raw) WHERE len(w) > 0
),
f AS (SELECT k, any_value(w) AS w, min(r * 1000000 + n) AS p FROM l GROUP BY k),
v AS (
  SELECT p, len(w) AS size, i, array_to_string(w[1 : i - 1] || w[i + 1 :], ' ') AS v
  FROM (SELECT p, w, unnest(range(1, len(w) + 1)) AS i FROM f WHERE len(w) >= 8)
),
near AS (
  SELECT a.p FROM v a JOIN (SELECT v, i, min(p) AS p FROM v GROUP BY v, i) b ON a.v = b.v AND a.i = b.i WHERE b.p < a.p
  UNION SELECT a.p FROM v a JOIN f b ON a.v = b.k WHERE b.p < a.p AND len(b.w) >= 8
  UNION SELECT a.p FROM f a JOIN v b ON a.k = b.v WHERE b.p < a.p AND len(a.w) >= 8
),
gone AS (
  SELECT l.r, l.n FROM l JOIN f USING (k) WHERE l.r * 1000000 + l.n <> f.p
  UNION SELECT l.r, l.n FROM l JOIN near ON l.r * 1000000 + l.n = near.p
),
t AS (
  SELECT raw.r, string_agg(line, chr(10) ORDER BY raw.n) FILTER (gone.r IS NULL) AS text, count(gone.r) AS n_removed
  FROM raw LEFT JOIN gone ON raw.r = gone.r AND raw.n = gone.n GROUP BY raw.r
),
c AS (SELECT r, count(*) AS n_lines FROM l GROUP BY r)
SELECT doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(t.text, '') END AS text
FROM d LEFT JOIN t USING (r) LEFT JOIN c USING (r)
"""
