"""Jaccard join of the smallest sets that can link."""

import random

from sommelix.llm import jaccard_join
from tests.llm.test_operators import brute_groups, found


def test_sets_of_three_link_with_sets_of_four(spark):
    rnd = random.Random(21)
    rows = []
    for k in range(40):
        w = [f"s{k}x{rnd.randrange(10**6)}" for _ in range(9)]
        pair = [w[:8], [w[1:8], w[:7]][k % 2]]  # 4 shingles, and 3 of them
        if k % 5 == 0:
            pair.append(w)  # 5 shingles: links with the 4, not with the 3
        if k % 7 == 0:
            pair += [w[1:7], w[:7], w[1:8]]  # 2 shingles never link, both ends do
        rows += [(len(rows) + i, " ".join(x)) for i, x in enumerate(pair)]
    rows += [(2000 + k, " ".join(["one", "common", "run", "of", "words", f"a{k}", f"b{k}"])) for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = jaccard_join.with_component_ids(jaccard_join.jaccard_groups(df))
    columns = ("doc_id", "n_shingles", "component_id")
    wanted = brute_groups(rows)
    assert found(got, *columns) == wanted
    assert sum(n == 3 and doc != least for doc, n, least in wanted) >= 40
