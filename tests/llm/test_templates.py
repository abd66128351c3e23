"""Documents made from a template: what all of them have is not what they are looked for by."""

import random

from pyspark.sql import functions as F

from sommelix.llm import jaccard_join


def template(n, seed=3, choices=60):
    """Sentences of 30 words with two slots; no two different ones are near enough."""
    rnd = random.Random(seed)
    words = [f"fixed{i}" for i in range(30)]
    made = []
    for i in range(n):
        text = [*words]
        text[9], text[21] = f"a{rnd.randrange(choices)}", f"b{rnd.randrange(choices)}"
        made.append((i, " ".join(text)))
    return made


def test_templated_documents_meet_in_few_pairs(spark, monkeypatch):
    """Sentences of one template share its shingles; they are looked for by those of their slots, which fewer have."""
    n = 3000
    rows = template(n)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    joined = []
    parts = jaccard_join.described

    def described(*args):
        out = parts(*args)
        kept = jaccard_join._exploded(out, "kept", "id").groupBy("key").agg(F.count("*").alias("kept"))
        picked = jaccard_join._exploded(out, "picked", "id").groupBy("key").agg(F.count("*").alias("picked"))
        joined.append(kept.join(picked, "key").agg(F.sum(F.col("kept") * F.col("picked"))).first()[0] or 0)
        return out

    monkeypatch.setattr(jaccard_join, "described", described)
    got = {r.doc_id: r.component_id for r in jaccard_join.with_component_ids(jaccard_join.jaccard_groups(docs)).collect()}
    first = {}
    for i, text in rows:
        first.setdefault(text, i)
    assert got == {i: first[text] for i, text in rows}
    different = len(first)
    assert joined[0] < 9 * different * different / 12  # the template's own keys alone would make 8 of all pairs
