"""A benchmark whose items share one text is divided into parts like any other."""

from sommelix.llm import decontaminate


def test_one_text_under_many_ids(spark):
    text = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    ids = [f"i{k}" for k in range(400)]
    rows = [(i, text) for i in ids] * 2 + [(None, text), ("other", "alpha beta"), ("none", None), ("empty", "")]
    benchmark = spark.createDataFrame(rows, "item_id string, text string")
    size = len(text) * 40
    items, n_parts = decontaminate._dealt(benchmark, size)
    largest = items.selectExpr("part", "length(text) AS n").groupBy("part").sum("n").agg({"sum(n)": "max"}).first()[0]
    assert n_parts >= 10 and largest <= 2 * size
    docs = spark.createDataFrame([(1, f"Lead. {text}, tail"), (2, "alpha, Beta"), (3, "nothing here"), (4, None)], "doc_id long, text string")
    for chars in (size, decontaminate.PART_CHARS):
        found = decontaminate.find_benchmark(docs, benchmark, part_chars=chars, keep=("doc_id",)).collect()
        got = {r.row.doc_id: (r.n_words, [list(h) for h in r.hits], sorted(r["items"])) for r in found}
        assert got == {1: (16, [[1, 14]], sorted(ids)), 2: (2, [[0, 2]], ["other"]), 3: (2, [], []), 4: (0, [], [])}
