import numpy as np

from riskstream.llm.language import ContextTree, byte_bits, identify, learn_languages
from riskstream.llm.queries import op4_language_id


def test_costs_are_those_of_a_distribution():
    tree = ContextTree([b"the cat sat on the mat", "größe".encode()])
    assert np.allclose(np.exp2(-tree.costs.astype(float)).sum(axis=1), 1, atol=1e-5)


def plain_bits(texts, text):
    """Escape by method C with exclusion, counted afresh for each byte."""
    data, total = bytes(3) + text, 0.0
    grams = [bytes(3) + t for t in texts]
    for at in range(3, len(data)):
        left, weight, p = set(range(256)), 1.0, 0.0
        for order in (3, 2, 1, 0):
            context = data[at - order:at]
            seen = {}
            for g in grams:
                for i in range(3, len(g)):
                    if g[i - order:i] == context and g[i] in left:
                        seen[g[i]] = seen.get(g[i], 0) + 1
            if not seen:
                continue
            n, d = sum(seen.values()), len(seen)
            if data[at] in seen:
                p = weight * seen[data[at]] / (n + d)
                break
            weight, left = weight * d / (n + d), left - set(seen)
        total -= np.log2(p or weight / len(left))
    return total


def test_code_length_is_exact():
    texts = [b"banana bandana", b"an apple and a banana"]
    tree = ContextTree(texts)
    plain = (tree.pairs, tree.single, tree.longer, tree.costs)
    for text in (b"banana", b"xyz", b"a band and a nap", "é".encode()):
        found = byte_bits(plain, np.frombuffer(bytes(3) + text, np.uint8)).sum()
        assert abs(found - plain_bits(texts, text)) < 1e-3


def test_held_out_accuracy_and_shape(spark):
    rows = op4_language_id(spark, "/root/testdata/sf0.01").collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held = [r for r in rows if r.held_out and lang[r.doc_id]]
    assert len(rows) == len(lang) and len(held) > 100
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark, odd_docs, docs_of):
    model = learn_languages(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    found = identify(odd_docs, model)
    assert found.columns == [*odd_docs.columns, "lang_pred", "lang_score"]
    rows = found.collect()
    assert len(rows) == odd_docs.count()
    assert {r.doc_id for r in rows if r.lang_pred == "und"} == {1, 2, 4}
    assert identify(docs_of([]), model).count() == 0
    nothing = learn_languages(docs_of([]))
    assert {r.lang_pred for r in identify(odd_docs, nothing).collect()} == {"und"}


def test_blocks_give_the_same_as_whole_texts(monkeypatch):
    from riskstream.llm import language

    tree = ContextTree([b"some text to learn from " * 5])
    plain = [(tree.pairs, tree.single, tree.longer, tree.costs)]
    texts = [b"short", b"a longer text that is cut into blocks " * 20, b"", b"end"]
    whole = language._lengths(plain, texts)
    monkeypatch.setattr(language, "BLOCK", 64)
    assert np.allclose(whole, language._lengths(plain, texts))


def test_a_language_of_long_texts_only_is_learned(docs_of):
    from riskstream.llm.language import learn_languages
    docs = docs_of([(1, "long words " * 20), (None, "long words again " * 20)])
    assert learn_languages(docs, chars=50).languages == ["en"]
