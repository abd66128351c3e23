"""From raw documents to a training mix: five stages, each over all that the stage before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sommelix.llm import decontaminate, jaccard_join, language_id, line_dedup, mixing
from sommelix.llm.common import doc_key, maybe_in, saved, shared_folder

#: A prediction below this share of certainty, among LEAST_AMONG languages, rejects a document of LEAST_LETTERS letters or
#: more; shorter ones are not long enough to tell.
LEAST_SCORE = 0.3
LEAST_AMONG = 4
LEAST_LETTERS = 20
LETTERS = r"\p{L}"


def least_score(n_languages: int) -> float:
    """The bound among so many languages: as far between chance, 1 / n, and certainty as LEAST_SCORE is among LEAST_AMONG.
    A single language is always certain and rejects nothing."""
    chance = 1 / LEAST_AMONG
    return 1 / n_languages + (LEAST_SCORE - chance) / (1 - chance) * (1 - 1 / n_languages)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without any letter (``und``) and those long enough to tell that look like none of the learned
    languages. Where there are no labels to learn from, only the former go."""
    model = language_id.train(docs)
    if model is None:
        return docs.where(F.col("text").rlike(LETTERS))
    found = language_id.identify(docs, model)
    sure = F.col("score") >= least_score(len(model.languages))
    short = F.regexp_count("row.text", F.lit(LETTERS)) < LEAST_LETTERS
    return found.where((F.col("lang_pred") != "und") & (sure | short)).select("row.*")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated lines; a document all of whose lines go, goes. n_chars follows the text."""
    out = line_dedup.dedup_lines(docs).where("n_lines = 0 OR n_removed < n_lines").select("row.*")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out


def join_ngrams(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group the document with the smallest id; null ids come last, then the texts' hashes decide. Of equal rows
    with words one stays, as they are one group; documents without words are in no group and all stay. An empty table stays
    empty; other columns stay as they are, whatever their names."""
    keyed = docs.select(doc_key().alias("doc"), F.struct("*").alias("row"))
    groups = saved(jaccard_join.with_component_ids(jaccard_join.jaccard_groups(docs.select(doc_key().alias("doc_id"), "text"))))
    gone = saved(groups.where("doc_id <> component_id").select(F.col("doc_id").alias("doc")).distinct())
    stay = maybe_in(keyed, ["doc"], gone, "left_anti").union(maybe_in(keyed, ["doc"], gone).join(gone, "doc", "left_anti"))
    again = saved(groups.where("n_shingles > 0").groupBy(F.col("doc_id").alias("doc")).count().where("count > 1").select("doc"))
    if not again.isEmpty():
        repeated = maybe_in(stay, ["doc"], again)
        once = repeated.join(again, "doc", "left_semi").dropDuplicates(["doc"])
        stay = maybe_in(stay, ["doc"], again, "left_anti").union(repeated.join(again, "doc", "left_anti")).union(once)
    return stay.select("row.*")


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents of which a twentieth or more is benchmark text. Documents without words stay, repeated rows share their
    fate, and without benchmark items all stay; other columns stay as they are."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.decontamination(docs, benchmark).where("NOT contaminated").select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes; see ``mixing.mix`` for null sources, ties, repeats and empty tables."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("jaccard_join", join_ngrams),
    ("decontaminate", decontaminate_benchmark),
    ("mixing", mix_sources),
]

#: The first stage is a trained model, which SQL cannot express; ``tests/llm`` hold the other stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; tables between stages lie in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
