"""The stages after language ID against brute force: copies, repeats, nulls, clashing columns, empty tables."""

import random
import re

import pytest

import corpus_pipeline

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, doc string, doc_hash int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall((text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(11)
    vocabulary = [f"word{i}" for i in range(300)]
    texts = [" ".join(rnd.choices(vocabulary, k=rnd.randint(3, 120))) for _ in range(25)]
    for k in range(10):
        words = texts[k].split()
        words[len(words) // 2] = "changed"
        texts.append(" ".join(words))
    texts += [texts[0], texts[0].upper(), None, "", " \n", "two words"]
    made = [(1000 - i, t) for i, t in enumerate(texts)] + [(5, texts[3]), (5, texts[3]), (6, None), (6, None), (None, texts[4]), (None, "lonely words")]
    return [(d, t, "en", f"s{i % 3}", len(t or ""), "r", "d", 7) for i, (d, t) in enumerate(made)]


def test_one_of_each_group_stays(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    kept = corpus_pipeline.join_ngrams(spark, docs, "")
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    sets = [shingles(r[1]) for r in rows]
    near = lambda a, b: a and b and 100 * len(a & b) >= 75 * len(a | b)
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if near(sets[i], sets[j]) and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    wanted = [(r[0], r[1]) for r, s in zip(rows, sets) if not s]
    for g in {g for g, s in zip(group, sets) if s}:
        ids = [rows[i][0] for i in range(len(rows)) if group[i] == g]
        least = min((x for x in ids if x is not None), default=None)
        found = [x for x in got if x[0] == least and any(x[1] == rows[i][1] for i in range(len(rows)) if group[i] == g)]
        assert len(found) == 1
        wanted += found
    assert got == sorted(wanted, key=repr)
    assert corpus_pipeline.join_ngrams(spark, docs.limit(0), "").count() == 0


def test_contaminated_documents_go(spark, tmp_path):
    item = " ".join(f"Item{i}" for i in range(20))
    spark.createDataFrame([(1, item), (2, "short one"), (3, None)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    filler = " ".join(f"w{i}" for i in range(400))
    texts = [item.lower() + " and more", filler, f"{filler} {item}", f"{filler} short ONE", "short one", None, "", " ".join(item.split()[:12])]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "r", "d", 7) for i, t in enumerate(texts)] * 2, SCHEMA)
    kept = corpus_pipeline.decontaminate_benchmark(spark, docs, str(tmp_path))
    # the third has 20 of 420 words: less than a twentieth; the fourth 2 of 402
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted([1, 2, 3, 5, 6, 7] * 2)
    assert corpus_pipeline.decontaminate_benchmark(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_lines_and_mix(spark, rows):
    line = "this line is in several documents of the corpus and goes from all but one"
    docs = [(i, f"{line}\nown line number {i} with words of its own {'x' * i}", "en", "s", 0, "r", "d", 7) for i in range(3)] + [(9, line, "en", "s", 0, "r", "d", 7), (10, None, "en", None, 0, "r", "d", 7)]
    kept = corpus_pipeline.dedup_lines(spark, spark.createDataFrame(docs, SCHEMA), "")
    got = {r.doc_id: (r.text, r.n_chars) for r in kept.collect()}
    assert set(got) == {0, 1, 2, 10} and line in got[0][0] and line not in got[1][0] and got[1][1] == len(got[1][0])
    mixed = corpus_pipeline.mix_sources(spark, spark.createDataFrame(rows, SCHEMA), "").collect()
    size = {id(r): len(WORD.findall(r[1] or "")) for r in rows}
    assert len(mixed) == len(rows) and sum(r.size for r in mixed) == sum(size.values())
    assert all(r.taken <= 2 * r.size for r in mixed)
    assert corpus_pipeline.mix_sources(spark, spark.createDataFrame([], SCHEMA), "").count() == 0
