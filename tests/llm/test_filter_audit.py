"""The audit of filters against counting by hand, on copies, repeats, nulls and an empty table."""

import re
from itertools import permutations

from pyspark.sql import functions as F

from sommelix.llm import filter_audit

DOCS = "doc_id bigint, text string, lang string, n bigint, part string, hash string, E boolean"
LABELS = "doc_id bigint, quality int, toxic int, n int"
COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def failed(doc_id, text, smallest):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    first = smallest[text]
    return {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
        "D": bool(re.search(r"[#$%&*|]", text)),
        "E": first is not None and (doc_id is None or doc_id > first),
    }


def brute(docs, labels):
    smallest, good, toxic = {}, {}, {}
    for d, text, _ in docs:
        known = [x for x in (smallest.get(text or ""), d) if x is not None]
        smallest[text or ""] = min(known, default=None)
    for d, q, t in labels:
        good[d], toxic[d] = good.get(d, False) or q == 1, toxic.get(d, False) or t == 1
    rows = []
    for part in sorted({lang or "" for *_, lang in docs}):
        mine = [(failed(d, text, smallest), d is not None and good.get(d, False), d is not None and toxic.get(d, False)) for d, text, lang in docs if (lang or "") == part]
        made, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for k, f in enumerate(order):
                gone = [x for x in left if x[0][f]]
                left = [x for x in left if not x[0][f]]
                fails = sum(x[0][f] for x in mine)
                only = sum(x[0][f] and sum(x[0].values()) == 1 for x in mine)
                made.append([part, "".join(order), k + 1, len(left), len(gone), fails - len(gone), only, sum(x[1] for x in gone), sum(x[2] for x in gone), f])
                shapley[f] += len(gone)
        rows += [(*r[:-1], shapley[r[-1]]) for r in made]
    return sorted(rows)


def corpus():
    long = " ".join(f"w{i}" for i in range(230))
    texts = [
        None, "", "   ", "short", "short", "SHOUTED WORDS", "costs 5 $", long, long, long, long + " #", "la " * 300, "la " * 300 + "*",
        " ".join(f"W{i}" for i in range(250)), " ".join(f"W{i} |" for i in range(250)), "é" * 100 + " ABCD", "x" * 30000, "AB " * 400,
    ]
    docs = [(100 - i, t, ("en", "fr", None, "")[i % 4]) for i, t in enumerate(texts)]
    docs += [(7, long, "en"), (7, long, "en"), (None, long, "fr"), (None, "lonely", "fr"), (None, "lonely", "fr"), (None, None, "en")]
    docs += [(1000 + i, "hot copy", "en" if i % 3 else "de") for i in range(60)]
    labels = [(d, i % 2, i % 3 == 0 and 1 or 0) for i, (d, _, _) in enumerate(docs[::2])]
    return docs, [*labels, (7, 0, 1), (7, 1, 0), (99999, 1, 1), (None, 1, 1), (1003, None, None)]


def audit(spark, docs, labels):
    frame = spark.createDataFrame([(*d, 1, "x", "y", True) for d in docs], DOCS).repartition(3)
    marks = spark.createDataFrame([(*r, 5) for r in labels], LABELS)
    return filter_audit.filter_interactions(filter_audit.flagged_counts(frame, marks), "ABCDE")


def test_every_order_and_step(spark):
    docs, labels = corpus()
    got = audit(spark, docs, labels).select(*COLUMNS)
    assert sorted(map(tuple, got.collect())) == brute(docs, labels)


def test_empty_tables(spark):
    assert audit(spark, [], []).count() == 0
    got = audit(spark, [(1, None, None)], []).select(*COLUMNS)
    assert sorted(map(tuple, got.collect())) == brute([(1, None, None)], [])


def test_other_filters(spark):
    rows = [("p", a, b, 1, 1, 0) for a in (True, False) for b in (True, False) for _ in range(2 if a else 3)]
    flagged = spark.createDataFrame(rows, "part string, x boolean, y boolean, n bigint, good bigint, toxic bigint")
    got = filter_audit.filter_interactions(flagged, ["x", "y"]).where("filter_order = 'yx'").orderBy("step")
    assert [(r.kept, r.removed, r.redundant, r.unique_fails, r.shapley) for r in got.collect()] == [(5, 5, 0, 3, 8), (3, 2, 2, 2, 6)]


def test_copies_do_not_meet_in_one_task(spark):
    """Rows of one text are added up before they are dealt out by its hash."""
    docs = [(i, "hot copy", "en") for i in range(2000)]
    made = filter_audit.flagged_counts(spark.createDataFrame([(*d, 1, "x", "y", True) for d in docs], DOCS), spark.createDataFrame([], LABELS))
    assert sorted((r.E, r.n) for r in made.collect()) == [(False, 1), (True, 1999)]
    assert made.select(F.sum("n")).first()[0] == 2000
