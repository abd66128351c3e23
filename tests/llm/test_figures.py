"""op1's columns against plain regular expressions, and held-out figures of the trained operators."""

import hashlib
import re

import pytest

from sommelix.llm.queries import QUERIES

KINDS = {
    "assign": (re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), lambda m: len(m[2]) >= 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    "hex": (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
}


def base(text):
    found = [(m.start(), i, f"{kind}:{m.start()}:{m.end()}") for i, (kind, (rule, keep)) in enumerate(KINDS.items()) for m in rule.finditer(text or "") if keep(m)]
    return [s for *_, s in sorted(found)]


def folder(spark, tmp_path, rows):
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def check(out, texts):
    rows = out.collect()
    assert sorted((r.doc_id is not None, r.doc_id) for r in rows) == sorted((d is not None, d) for d, _ in texts)
    by_id = dict(texts)
    for r in rows:
        spans = base(by_id[r.doc_id])
        count = lambda kind: sum(s.startswith(kind) for s in spans)  # noqa: B023, E731
        assert (r.n_assign, r.n_access, r.n_hex) == (count("assign"), count("access"), count("hex")), by_id[r.doc_id]
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert set(spans) <= set(r.spans.split(",") if r.spans else [])


def test_secrets_of_odd_texts(spark, tmp_path):
    texts = [
        None, "", "password: hunter22 and Password='short'", "token = \"abcdef123456\" token=token=abcdef", "api_key:abcdefgh APIKEY==abcdefg", "é secret:ünicode passwd  =  a.b-c_d/e+f=",
        "AKIA" + "A" * 15, "AKIA" + "A" * 16, "AKIAAKIA" + "Z9" * 20, "f" * 23, "f" * 24, "x" + "0a" * 40 + "g" + "b" * 24, "passwordpassword=abcdefgh", "secret:\nabcdefgh",
        "token:" + "deadbeef" * 5, "\U0001f600 token:abcdef \U0001f600 " + "1" * 30, "password password: password:abcdef", "tokentoken: 'abc' token: abcdefg", "a" * 50000 + "G" + "AKIA" * 30,
    ]
    rows = list(enumerate(texts))
    check(QUERIES["op1_secret_scan"](spark, folder(spark, tmp_path, rows)), rows)


def test_secrets_of_the_given_documents(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert any(base(t) for _, t in rows)
    check(QUERIES["op1_secret_scan"](spark, sf), rows)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_languages_held_out(spark, sf):
    out = QUERIES["op6_language_id"](spark, sf).where("held_out").select("doc_id", "lang_pred")
    both = out.join(spark.read.parquet(f"{sf}/documents.parquet").where("lang IS NOT NULL").select("doc_id", "lang"), "doc_id")
    got = both.selectExpr("count(*) AS n", "count_if(lang = lang_pred) AS right").first()
    assert got.n > 200 and got.right >= 0.98 * got.n


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_quality_held_out(spark, sf):
    out = QUERIES["op7_quality_crf"](spark, sf).where("held_out").select("doc_id", "score")
    both = out.join(spark.read.parquet(f"{sf}/labels.parquet").where("quality IS NOT NULL").select("doc_id", "quality"), "doc_id").collect()
    good, bad = ([r.score for r in both if r.quality == q] for q in (1, 0))
    assert len(good) > 30 and len(bad) > 5
    auc = sum((g > b) + (g == b) / 2 for g in good for b in bad) / len(good) / len(bad)
    assert auc >= 0.95
