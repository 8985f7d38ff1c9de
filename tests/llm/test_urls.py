import random

import duckdb

from riskstream.llm import urls
from riskstream.llm.queries import URL_RULES, op13_url_filter
from riskstream.llm.urls import ALLOW, BLOCK, Rule, Vocabulary, allowed, judged, parts, term_hits

SF = "/root/testdata/sf0.01"
ODD = [None, "", "no scheme at all", "http://", "://", "HTTP://WWW.EXAMPLE.NET", "https://a.example.net/en", "https://a.example.net/en/1?x=/fr/",
       "http://net/", "http://anet/", "http://x.net?porn", "http://y.org/fr/../de", "https://q.example.com/de/#frag", "http://ÄÖ.Org/fr/X",
       "http://u:p@h.net:80/", "x://y://z.net/", "http://casino.example.org/", "http://casinos-and.example.org/", "http://e.org/cheap-free",
       "http://e.org/cheap-cheap", "http://e.org/mycheap/free9", "http://e.org/cheap\nfree", "http://e.org/ßcheap_Free", "a" * 100_000 + " porn",
       "http://.net/", "http://a..net/x"]


def table(spark, rows):
    return spark.createDataFrame([(i, u) for i, u in enumerate(rows)], "page_id long, url string")


def same_as_sql(spark, pages, sql):
    duck = duckdb.connect()
    duck.register("pages", pages.toPandas())
    theirs = duck.sql(sql)
    ours = pages.sparkSession.createDataFrame(judged(pages, URL_RULES).collect(), judged(pages).schema)
    rows = sorted((tuple(r[c] for c in sorted(ours.columns)) for r in ours.collect()), key=repr)
    order = [theirs.columns.index(c) for c in sorted(ours.columns)]
    assert rows == sorted((tuple(r[i] for i in order) for r in theirs.fetchall()), key=repr)


def test_query_equals_sql(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    same_as_sql(spark, pages.select("page_id", "url"), urls.oracle(URL_RULES))
    found = op13_url_filter(spark, SF).collect()
    assert len(found) == pages.count() and {r.verdict for r in found} == {ALLOW, BLOCK}
    assert all(r.verdict == (BLOCK if r.rule in ("net/", "example.com/de/") else ALLOW) for r in found if r.rule)


def test_odd_urls_equal_sql(spark):
    same_as_sql(spark, table(spark, ODD + ODD[:5]), urls.oracle(URL_RULES))


def test_random_urls_equal_sql(spark):
    draw = random.Random(3)
    piece = ["net", "org", "com", "example", "fr", "de", "en", "casino", "cheap", "free", "x", "/", ".", "-", "?", "#", "://", "http://", "é", " ", "_"]
    same_as_sql(spark, table(spark, ["".join(draw.choices(piece, k=draw.randint(1, 14))) for _ in range(1500)]), urls.oracle(URL_RULES))


def test_parts():
    assert parts("Http://WWW.Ä.Com/A?b#c") == ("www.Ä.com", "/A")
    assert parts("http://h#/x") == ("h", "") and parts("http://h?x://y") == ("h", "") and parts("mailto:x") == parts(None) == ("", "")


def test_longest_rule_wins(spark):
    rules = [Rule(BLOCK, "net"), Rule(ALLOW, "b.net"), Rule(BLOCK, "b.net", "/x/"), Rule(ALLOW, "a.b.net", "/x"), Rule(BLOCK, "b.net", "/same/"),
             Rule(ALLOW, "b.net", "/same/")]
    pages = table(spark, ["s://net/", "s://b.net/", "s://a.b.net/x/", "s://c.b.net/x/", "s://b.net/same/", "s://cb.net/", "s://b.net"])
    found = [(r.rule, r.verdict) for r in judged(pages, rules).orderBy("page_id").collect()]
    # "b.net/x/" and "a.b.net/x" of 8 and 9 characters
    assert found == [("net/", BLOCK), ("b.net/", ALLOW), ("a.b.net/x", ALLOW), ("b.net/x/", BLOCK), ("b.net/same/", ALLOW), ("net/", BLOCK),
                     (None, ALLOW)]


def test_boundaries_and_counts():
    automaton = Vocabulary(("bad-word",), ("soft", "word", "off"), 2).automaton()
    assert term_hits(automaton, "SOFT.soft/softer_9soft") == (0, 2, {"soft"})
    assert term_hits(automaton, "a-bad-word-b") == (1, 1, {"word"})
    assert term_hits(automaton, "xbad-word") == (0, 1, {"word"})
    assert term_hits(Vocabulary((), ()).automaton(), "anything") == (0, 0, set())


def test_one_strict_or_several_different_soft_terms(spark):
    vocabulary = Vocabulary(("s",), ("a", "b", "c"), 3)
    pages = table(spark, ["s://h/a/a/a", "s://h/a/b", "s://h/a/b/c", "x://h/s", "x://h/"])
    found = judged(pages, (), vocabulary).orderBy("page_id").collect()
    assert [r.verdict for r in found] == [BLOCK, BLOCK, BLOCK, BLOCK, ALLOW]     # the scheme `s` is a word too
    pages = table(spark, ["x://h/a/a/a", "x://h/a/b", "x://h/a/b/c"])
    found = judged(pages, (), vocabulary).orderBy("page_id").collect()
    assert [(r.soft_hits, r.soft_terms, r.verdict) for r in found] == [(3, 1, ALLOW), (2, 2, ALLOW), (3, 3, BLOCK)]


def test_allowed_keeps_rows_and_clashing_columns(spark):
    pages = table(spark, ["http://e.org/", "http://casino.org/", None, "http://e.org/"]).selectExpr(
        "*", "'x' AS host", "1 AS verdict", "'z' AS Rule", "array(1) AS `a b`")
    kept = allowed(pages, URL_RULES)
    assert kept.columns == pages.columns and sorted(r.page_id for r in kept.collect()) == [0, 2, 3]
    assert judged(pages.limit(0), URL_RULES).count() == 0 and allowed(pages.limit(0)).count() == 0
    assert judged(pages.unionByName(pages), URL_RULES).count() == 8
