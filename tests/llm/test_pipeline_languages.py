"""What the pipeline's first stage keeps."""

import random

import pytest

import corpus_pipeline

SCHEMA = "doc_id bigint, text string, lang string"
TONGUES = {"xx": ["tha", "ing", "ous"], "yy": ["ich", "ung", "sch"], "zz": ["ção", "não", "inho"], "ww": ["ska", "ovi", "nyj"]}
STRANGE = "ψψξξ ωωφφ ζζββ γγδδ ηηθθ κκλλ"


def kept(spark, languages, more, labelled=True):
    rnd = random.Random(4)
    data = [(i, " ".join("".join(rnd.choices(TONGUES[t], k=3)) for _ in range(30)), t) for i in range(160) for t in [rnd.choice(languages)]]
    df = spark.createDataFrame([*data, *((1000 + i, t, None) for i, t in enumerate(more))], SCHEMA)
    df = df if labelled else df.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang")
    out = corpus_pipeline.identify_language(spark, df, "")
    assert out.columns == df.columns
    got = {r["doc_id"] for r in out.collect()}
    assert got >= set(range(160))
    return [t for i, t in enumerate(more) if 1000 + i in got]


def test_short_texts_are_not_rejected(spark):
    assert kept(spark, list(TONGUES), ["q", "qk 7", "ψψξ ωωφ", STRANGE, "12 !?", "", None]) == ["q", "qk 7", "ψψξ ωωφ"]


@pytest.mark.parametrize("n", [2, 3])
def test_few_languages_still_reject(spark, n):
    assert kept(spark, list(TONGUES)[:n], [STRANGE, "12"]) == []
    assert 1 / n < corpus_pipeline.least_score(n) < 1


def test_one_language_and_no_labels_keep_what_has_letters(spark):
    more = ["q", STRANGE, "é 1", "12 !?", "", None]
    assert kept(spark, ["xx"], more) == more[:3]
    assert kept(spark, ["xx", "yy"], more, labelled=False) == more[:3]


def test_the_bound_follows_the_number_of_languages():
    assert corpus_pipeline.least_score(4) == pytest.approx(corpus_pipeline.LEAST_SCORE)
    bounds = [corpus_pipeline.least_score(n) for n in range(1, 50)]
    assert bounds[0] == 1 and bounds == sorted(bounds, reverse=True)
