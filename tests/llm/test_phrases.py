from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from riskstream.llm import phrases
from riskstream.llm.phrases import Filter, collocations, encoded, phrase_counts, words_and_marks
from riskstream.llm.queries import op11_collocations

SF = "/root/testdata/sf0.001"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, top, at_least):
    """From (lang, text), counting every phrase."""
    import re

    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        folded = re.sub("[A-Z]", lambda c: c[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", folded):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for n in range(1, 5):
                counts[lang].update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, found in counts.items():
        many = {p: n for p, n in found.items() if n >= at_least}
        most = Counter()
        for p, n in many.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    most[p[i:i + m]] = max(most[p[i:i + m]], n)
        kept = []
        for p, a in many.items():
            if len(p) > 1 and 100 * most[p] < 80 * a:
                score, _, l, r = min((2_000_000 * a // (many[p[:k]] + many[p[k:]]), k, many[p[:k]], many[p[k:]]) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def found(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")


@pytest.mark.parametrize("top, at_least, first", [(20, 3, 1), (3, 2, 2), (100_000, 4, None)])
def test_equals_sql_and_brute_force_over_several_rounds(spark, top, at_least, first):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("lang", "text").limit(60).collect()
    documents = spark.createDataFrame(rows, "lang string, text string")
    expected = brute([tuple(r) for r in rows], top, at_least)
    assert found(collocations(documents, top, at_least, first)) == expected
    duck = duckdb.connect()
    duck.register("documents", documents.toPandas())
    sql = duck.sql(phrases.oracle(top, at_least))
    order = [sql.columns.index(c) for c in COLUMNS]
    assert sorted(tuple(r[i] for i in order) for r in sql.fetchall()) == expected


def test_query_equals_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    sql = duck.sql(phrases.oracle())
    order = [sql.columns.index(c) for c in COLUMNS]
    assert found(op11_collocations(spark, SF)) == sorted(tuple(r[i] for i in order) for r in sql.fetchall())


def test_words_and_marks():
    assert words_and_marks("Ab\tÀb, c.D\r\n\x1fe\u00a0f") == [b"ab", "Àb".encode(), b".", b"c", b".", b"d", b".", b".", "\x1fe\u00a0f".encode()]
    assert words_and_marks(None) == words_and_marks(" \t ") == []


def test_texts_longer_than_a_run_and_overlaps(spark, monkeypatch):
    rows = [("en", "a a a a a b c d " * 12 + ". " + "x y z " * 9), ("en", "a b c"), (None, "p q " * 7), ("", "p q " * 7)]
    expected = brute(rows, 50, 2)
    assert found(collocations(documents(spark, rows), 50, 2)) == expected
    monkeypatch.setattr(phrases, "RUN_WORDS", 7)
    monkeypatch.setattr(phrases, "CHUNK_WORDS", 10)
    monkeypatch.setattr(phrases, "ROWS", 3)
    assert found(collocations(documents(spark, rows), 50, 2)) == expected


def test_ties_at_the_last_place(spark):
    rows = [("en", ". ".join(f"w{i} v{i}" for i in range(30)))] * 3
    first = found(collocations(documents(spark, rows), 5, 3, 1))
    assert first == brute(rows, 5, 3) and [r[2] for r in first] == ["w0 v0", "w1 v1", "w10 v10", "w11 v11", "w12 v12"]


def test_a_frequent_longer_phrase_drops_what_it_holds(spark):
    rows = [("en", "new york city")] * 8 + [("en", "new york")] * 2 + [("en", "big new york times")] * 1
    phrases_kept = {r[2] for r in found(collocations(documents(spark, rows), 10, 2))}
    assert phrases_kept == {"new york", "new york city"}        # 8 of 11 are under 80 %
    rows = [("en", "new york city")] * 9 + [("en", "new york")] * 2
    assert {r[2] for r in found(collocations(documents(spark, rows), 10, 2))} == {"new york city"}


def test_counts_may_pass_32_bits_and_products_64(spark):
    big = 3_000_000_000_000_000_000
    counts = spark.createDataFrame([("en", "a", big + 5), ("en", "b", big + 1)], phrases.COUNTED)
    row = phrases.scored(spark.createDataFrame([("en", "a b", big)], phrases.COUNTED), counts).first()
    assert (row.score, row.bound) == (2_000_000 * big // (2 * big + 6), 2_000_000 * big // (2 * big + 5))


def test_a_full_filter_lets_more_through_but_changes_no_count(spark, monkeypatch):
    rows = [("en", " ".join(f"w{i % 17} w{i % 5}" for i in range(400)))]
    expected = brute(rows, 30, 3)
    monkeypatch.setattr(phrases, "LEAST_BITS", 6)
    monkeypatch.setattr(phrases, "MOST_BITS", 6)
    assert found(collocations(documents(spark, rows), 30, 3, 1)) == expected


def test_filter_holds_all_it_was_made_of(spark):
    rows = [("en", f"a{i} b{i}") for i in range(500)]
    some = Filter.of(spark.createDataFrame(rows, "lang string, phrase string"))
    assert some(phrases._phrase_hashes(*map(list, zip(*rows)))).all()
    others = phrases._phrase_hashes(["fr"] * 500, [p for _, p in rows])
    assert some(others).mean() < 0.1 and others.dtype == np.uint64


def test_odd_rows(odd_docs, docs_of, spark):
    rows = [(r.lang, r.text) for r in odd_docs.collect()]
    assert found(collocations(odd_docs, 100, 2)) == brute(rows, 100, 2)
    assert collocations(docs_of([])).count() == 0
    assert collocations(docs_of([(1, None), (2, "")])).count() == 0
    one = phrase_counts(encoded(docs_of([(1, "a a")])), 1).collect()
    assert sorted((r.phrase, r.n) for r in one) == [("", 2), ("a", 2)]


def test_a_third_of_all_words_in_one_language_and_phrase(spark):
    rows = [("en", "hot pair " * 2000)] * 4 + [(f"l{i}", f"x{i} y{i} z") for i in range(300) for _ in range(2)]
    assert found(collocations(documents(spark, rows), 3, 2)) == brute(rows, 3, 2)
