"""Fill-in-the-middle against units listed one by one, and the exact round trip."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from sommelix.llm import fill_in_middle as fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, n int, form string, row int, output string"


def brute(doc_id, text, rate, spm):
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return len(units), "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def corpus():
    texts = [None, "", " ", "\n\t ", "one", " one ", "é ñ 你好 \U0001f600 x", "a<P>b", "x <M>", "<", "<P <S <M", "<<S", "word " * 5000, "   \x85 y"]
    texts += [" " * 3000, "z" * 3000, " " * 2000 + "end", "a\x00b c", "tail" + "\n" * 900, "".join(f"w{i}\n\t" for i in range(1025))]
    rows = [(i, t) for i, t in enumerate(texts * 12)]
    return [*rows, (5, "again"), (5, "again"), (None, "some words here"), (-3, "less than none <"), (1 << 62, "far out there")]


@pytest.mark.parametrize("rate,spm,every", [(50, 80, 256), (100, 50, 3), (100, 0, 1), (0, 80, 256)])
def test_outputs(spark, rate, spm, every):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "en", 1, "f", 2, "o") for r in rows], SCHEMA).repartition(3)
    made = fim.filled_in_middle(docs, rate=rate, spm_rate=spm, every=every)
    assert made.select("row.*").columns == docs.columns
    back = fim.restored(F.col("output"), F.col("form")).alias("back")
    got = made.select("row.doc_id", "row.text", "n", "form", "prefix_chars", "middle_chars", "output", back).collect()
    assert all(r.back == (r.text or "") for r in got)
    wanted = [(d, t, *brute(d, t, rate, spm)) for d, t in rows]
    assert sorted((tuple(r)[:-1] for r in got), key=repr) == sorted(wanted, key=repr)
    assert rate == 0 or {"psm", "spm"} & {r.form for r in got}


def test_checkpoints_lead_to_every_cut():
    for text in ("", " ", "aé  b\n\n你 c " * 7, "x" * 50 + "\t" * 60):
        units = UNIT.findall(text)
        for every in (1, 2, 5, 100):
            points = fim.Checkpoints(text.encode(), every)
            assert points.n == len(units) and len(points.units) == len(units) // every + 1
            for k in range(len(units) + 1):
                head = "".join(units[:k])
                assert points.end_of(k) == (len(head.encode()), len(head))


def test_query_digests(spark):
    docs = spark.createDataFrame(corpus(), "doc_id bigint, text string")
    made = fim.filled_in_middle(docs, keep=("doc_id",))
    assert made.select("row.*").columns == ["doc_id"]
    assert fim.filled_in_middle(docs.limit(0)).count() == 0
