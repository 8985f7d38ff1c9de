"""Columns of the caller named like those that operators add pass through unchanged."""
import pytest

import corpus_pipeline
from riskstream.llm.common import written
from riskstream.llm.language import identify, learn_languages
from riskstream.llm.repeats import without_repeats

SF = "/root/testdata/sf0.001"
TAKEN = ("start", "kind", "number", "lang_pred", "Lang_Score", "_id", "_text", "_Hash", "_more", "_no_id", "removed", "FP", "row",
         "item", "window", "words", "raw", "total", "part", "hash", "more")
LINE = "a line of more than ten words that two of the documents here both have"


@pytest.fixture
def clashing(docs_of):
    df = docs_of([(1, None), (2, ""), (3, LINE + "\nand an own end"), (4, LINE + "\nwith its other, longer end. Tel +49 30 1234567"),
                  (4, "x" * 50), (None, "no id at all"), (5, "word " * 2000)])
    return df.selectExpr("*", *[f"concat('{c} of ', doc_id) AS `{c}`" for c in TAKEN], "'dot' AS `a.b`")


def own(df):
    return all(r[c] == (None if r.doc_id is None else f"{c} of {r.doc_id}") for r in df.collect() for c in TAKEN if c in df.columns)


def test_stages(spark, clashing):
    docs, kept = clashing, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), "stage")
        assert docs.columns == clashing.columns and own(docs)
        kept.append(docs.count())
    assert kept[0] == 5 and kept[-1] >= 3
    assert any("<phone>" in r.text for r in docs.collect())
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= 3


def test_results_stand_in_place_of_columns_of_their_name(clashing):
    found = without_repeats(clashing)
    assert found.columns == [*[c for c in clashing.columns if c != "removed"], "removed"]
    assert [(r.doc_id, [(s.start, s.end, s.kept_doc_id) for s in r.removed]) for r in found.collect()] == [(4, [(0, len(LINE) + 1, 3)])]
    assert own(found.drop("removed"))
    found = identify(clashing, learn_languages(clashing))
    assert found.columns[-2:] == ["lang_pred", "lang_score"] and "Lang_Score" not in found.columns
    assert {r.lang_pred for r in found.collect()} == {"en", "und"}
