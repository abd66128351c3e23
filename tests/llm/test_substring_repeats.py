"""Substring dedup of rows and lines that are repeated very often."""

import random

from pyspark.sql import functions as F

from sommelix.llm import substring_dedup
from tests.llm.test_operators import brute_substrings, found


def prose(rnd, n):
    return " ".join(f"w{rnd.randrange(5000)}" for _ in range(n))


def test_runs_of_a_repeated_row_do_not_grow_with_its_copies(spark):
    rnd = random.Random(31)
    text, hot = prose(rnd, 200), " ".join(["la di da"] * 40)
    rows = [(1, text)] * 30 + [(2, hot)] * 10 + [(3, prose(rnd, 90) + " " + " ".join(text.split()[20:120])), (4, hot + " " + prose(rnd, 50))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    keyed = docs.select(F.xxhash64("text").alias("kd"), F.lit(0).cast("bigint").alias("th"), "text")
    for hot in (substring_dedup.HOT, 1):
        runs = [r["runs"] for r in substring_dedup.repeated_windows(keyed, hot=hot).collect()]
        assert len(runs) == 4
        assert all(len(set(map(tuple, r))) == len(r) for r in runs)
        got = substring_dedup.dedup_substrings(docs, hot=hot)
        assert found(got, "doc_id", "n_words", "n_removed", "kept") == brute_substrings(rows)


def test_long_segments_are_not_gathered_in_one_shard(spark, monkeypatch, tmp_path):
    """A line repeated in many lengths has one minimizer; few segments of it hold many words."""
    rnd = random.Random(32)
    line = "all of this line is said again and again without an end"
    rows = [(k, prose(rnd, 40) + " " + " ".join([line] * (20 + 3 * k)) + " " + prose(rnd, 40)) for k in range(12)]
    rows += [(100 + k, rows[k][1][:300] + " " + prose(rnd, 60)) for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    log = str(tmp_path / "words")

    def noted(texts, window, search=substring_dedup.search_shard):
        with open(log, "a") as f:
            f.write(f"{sum(len(t.split()) for t in texts)}\n")
        return search(texts, window)

    monkeypatch.setattr(substring_dedup, "search_shard", noted)
    got = substring_dedup.dedup_substrings(docs, shard_words=300, hot_words=1000)
    assert found(got, "doc_id", "n_words", "n_removed", "kept") == brute_substrings(rows)
    assert max(map(int, open(log))) <= 300 + 1000
