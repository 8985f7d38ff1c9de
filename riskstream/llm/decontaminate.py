"""Documents that hold a benchmark item, also with other numbers, names and units."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from riskstream.llm.common import as_row, from_row, written

WIDTH = 5               # words of a window
SHARE = 0.8             # of an item's windows
BROADCAST_ROWS = 200_000

# Measures that make a word after a number a unit.
UNITS = ("mm cm m km in ft yd mi mile miles meter meters metre metres mg g kg lb lbs oz ton tons ml l liter liters "
         "litre litres s sec second seconds min minute minutes h hour hours day days week weeks month months year "
         "years percent dollar dollars euro euros pound pounds cent cents degree degrees mph kmh").split()


def with_words(df: DataFrame) -> DataFrame:
    """`df` with raw, the words of `text` without punctuation, and words, the same as a template: a word with a
    digit is <num>, a measure after one is <unit>, a word that starts with a capital is <name>, the rest
    is lower-cased. raw_folded and folded: the same with case folded first, so without <name>. Null text has none."""
    plain = F.trim(F.regexp_replace(F.regexp_replace("text", r"[^\p{L}\p{N}\s]+", ""), r"\s+", " "))
    template = F.regexp_replace(plain, r"(?<!\S)\S*[0-9]\S*", "<num>")
    template = F.regexp_replace(template, r"(?<=<num> )(?:" + "|".join(UNITS) + r")(?!\S)", "<unit>")
    template = F.regexp_replace(template, r"(?<!\S)\p{Lu}\S*", "<name>")
    cut = lambda text: F.when(F.length(text) > 0, F.split(text, " ", -1)).otherwise(F.array().cast("array<string>"))
    folded = F.regexp_replace(F.lower(plain), r"(?<!\S)\S*[0-9]\S*", "<num>")
    folded = F.regexp_replace(folded, r"(?<=<num> )(?:" + "|".join(UNITS) + r")(?!\S)", "<unit>")
    return df.withColumns({"raw": cut(plain), "words": cut(F.lower(template)), "raw_folded": cut(F.lower(plain)), "folded": cut(folded)})


KINDS = {"template": ("raw", "words"), "folded": ("raw_folded", "folded")}


def _windows(df: DataFrame, kinds: Sequence[str], width: int, at: str, *kept: str) -> DataFrame:
    """(*kept, kind, `at`, window): the hash of each window of `width` words. Only narrow columns leave a row: words that went
    along into every window would make the work grow with the square of a text's length."""
    def placed(kind: str) -> DataFrame:
        words = F.col(KINDS[kind][1])
        number = F.greatest(F.size(words) - width + 1, F.lit(0))
        shifted = F.arrays_zip(*[F.slice(words, k + 1, number).alias(f"w{k}") for k in range(width)])
        return df.select(*kept, F.lit(kind).alias("kind"), F.posexplode(shifted).alias("pos", "window")).select(
            *kept, "kind", (F.col("pos") + 1).alias(at), F.xxhash64("window").alias("window"))

    return reduce(DataFrame.union, map(placed, kinds))


def _placeholders(df: DataFrame, kinds: Sequence[str], at: str, word: str, *kept: str) -> DataFrame:
    """(*kept, kind, `at`, `word`): the words of a text that its template replaces."""
    def placed(kind: str) -> DataFrame:
        raw, words = KINDS[kind]
        return df.select(*kept, F.lit(kind).alias("kind"), F.posexplode(F.arrays_zip(
            F.col(raw).alias("raw"), F.col(words).alias("words"))).alias("pos", "both")).where(
            F.col("both.words").startswith("<")).select(*kept, "kind", (F.col("pos") + 1).alias(at), F.col("both.raw").alias(word))

    return reduce(DataFrame.union, map(placed, kinds))


def _small(df: DataFrame) -> DataFrame:
    """A written table, broadcast if it has at most `BROADCAST_ROWS`."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _same_text(left: str, right: str) -> Column:
    return F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id")) & (F.col(f"{left}._text") == F.col(f"{right}._text"))


class _Found(NamedTuple):
    """Windows that documents share with items, of documents that may hold the item, and the words in the slots."""
    windows: DataFrame      # doc_id, _text, item, item_at, kind, diagonal
    items: DataFrame        # item, item_id, total
    was: DataFrame          # item, kind, place, was
    now: DataFrame          # doc_id, _text, kind, doc_place, now


def _found(docs: DataFrame, benchmark: DataFrame, kinds: Sequence[str], width: int, share: float) -> _Found:
    """One pass over the texts finds the windows. An item whose windows, whatever their slots, are too few is dropped
    here; only the texts that are left are read again for the words in their slots."""
    items = with_words(benchmark.where(F.col("item_id").isNotNull()).select("item_id", "text")).withColumn(
        "item", F.xxhash64("item_id", "text")).dropDuplicates(["item"]).where(F.size("words") >= width)
    items = written(items.withColumn("total", F.size("words") - width + 1), "benchmark-items")
    sought = written(_windows(items, kinds, width, "item_at", "item", "total"), "benchmark-windows")
    texts = docs.select("doc_id", F.xxhash64("text").alias("_text"), "text")
    keys = ["doc_id", "_text", "item"]
    hits = written(_windows(with_words(texts), kinds, width, "doc_at", "doc_id", "_text").join(
        _small(sought), ["kind", "window"]).select(
        *keys, "total", "item_at", "kind", (F.col("doc_at") - F.col("item_at")).alias("diagonal")), "benchmark-hits")
    # Sets are bounded by the item's size.
    enough = hits.groupBy(*keys, "total").agg(F.collect_set("item_at").alias("places")).where(
        F.size("places") >= F.ceil(F.lit(share) * F.col("total")))
    enough = written(enough.select(*keys), "benchmark-candidates")
    windows = hits.alias("h").join(
        _small(enough).alias("c"), _same_text("h", "c") & (F.col("h.item") == F.col("c.item")), "left_semi").drop("total")
    candidates = written(enough.select("doc_id", "_text").distinct(), "benchmark-texts")
    again = texts.alias("t").join(_small(candidates).alias("c"), _same_text("t", "c"), "left_semi").dropDuplicates(["doc_id", "_text"])
    return _Found(
        written(windows, "benchmark-found"), items.select("item", "item_id", "total"),
        _placeholders(items, kinds, "place", "was", "item"),
        written(_placeholders(with_words(again), kinds, "doc_place", "now", "doc_id", "_text"), "benchmark-slots"))


def _held(found: _Found, kinds: Sequence[str], width: int, share: float) -> DataFrame:
    """(doc_id, _text, item_id, windows, total, same) of each item of which enough windows lie on consistent diagonals."""
    keys = ["doc_id", "_text", "item", "diagonal"]
    windows = found.windows.where(F.col("kind").isin(*kinds))
    places = windows.select(*keys, "kind", F.explode(F.sequence("item_at", F.col("item_at") + width - 1)).alias("place"))
    asked = places.join(_small(found.was), ["item", "kind", "place"])
    now = found.now.withColumnRenamed("kind", "now_kind")
    slots = asked.alias("a").join(now.alias("n"), _same_text("a", "n") & (F.col("a.kind") == F.col("n.now_kind")) & (
        F.col("a.place") + F.col("a.diagonal") == F.col("n.doc_place"))).select(
        *[F.col(f"a.{k}") for k in keys], F.struct("a.kind", "a.was", "n.now").alias("slot"))
    slots = slots.groupBy(*keys).agg(F.collect_set("slot").alias("slots")).select(
        *keys, F.size(F.array_distinct(F.transform("slots", lambda s: F.struct(s["kind"], s["was"])))).alias("asked"),
        F.size("slots").alias("answers"), F.forall("slots", lambda s: s["was"] == s["now"]).alias("same"))
    diagonals = windows.groupBy(*keys).agg(F.collect_set("item_at").alias("places"))
    same_diagonal = _same_text("d", "s") & (F.col("d.item") == F.col("s.item")) & (F.col("d.diagonal") == F.col("s.diagonal"))
    consistent = diagonals.alias("d").join(slots.alias("s"), same_diagonal, "left").where(
        F.col("s.asked").isNull() | (F.col("s.asked") == F.col("s.answers"))).select(
        "d.doc_id", "d._text", "d.item", "d.places", F.coalesce("s.same", F.lit(True)).alias("same"))
    per_item = consistent.groupBy("doc_id", "_text", "item").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set("places")))).cast("long").alias("windows"), F.min("same").alias("same"))
    return per_item.join(_small(found.items), "item").where(
        F.col("windows") >= F.ceil(F.lit(share) * F.col("total"))).drop("item")


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, share: float = SHARE) -> DataFrame:
    """(doc_id, item_id, windows, share, same): the items that a document holds.

    An item is held if at least `share` of its template windows of `width` words are found, each on a
    diagonal (distance between the places in document and item) whose slots are consistent: wherever
    the item repeats a number, name or unit, the document repeats what it has put there. `same`: no slot
    differs. `_text` is the hash of the document's text; rows that repeat doc_id and text are one.

    Items of fewer than `width` words, null texts and null item_ids are never found. Items are told apart
    by item_id and text, so an item_id with two texts is found by either. The windows of the benchmark are
    broadcast if there are at most `BROADCAST_ROWS`; more are joined by a shuffle. Extra columns are ignored.
    """
    kinds = ("template",)
    held = _held(_found(docs, benchmark, kinds, width, share), kinds, width, share)
    return held.groupBy("doc_id", "_text", "item_id").agg(
        F.max("windows").alias("windows"), F.max(F.col("windows") / F.col("total")).alias("share"),
        F.max("same").alias("same"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, share: float = SHARE) -> DataFrame:
    """`docs`, all columns, without the rows that hold a benchmark item: by its template alone as in `benchmark_hits`, or by its template
    windows together with windows of case-folded words, in which only numbers and units are placeholders, so that a copy in
    other case is found as well; slots are told apart by kind of window. Null and empty texts stay. Columns of any name pass."""
    kinds = tuple(KINDS)
    found = _found(docs, benchmark, kinds, width, share)
    hits = written(_held(found, ("template",), width, share).select("doc_id", "_text").union(
        _held(found, kinds, width, share).select("doc_id", "_text")).distinct(), "benchmark-held")
    keyed = docs.select(as_row(docs), "doc_id", F.xxhash64("text").alias("_text"))
    return from_row(keyed.alias("t").join(_small(hits).alias("h"), _same_text("t", "h"), "left_anti"), docs)


ORACLE = """
WITH base AS (
    SELECT 'd' AS kind, doc_id AS id, text FROM documents
    UNION ALL SELECT 'b', item_id, text FROM benchmark),
plain AS (
    SELECT kind, id, trim(regexp_replace(regexp_replace(text, '[^\\p{L}\\p{N}\\s]+', '', 'g'), '\\s+', ' ', 'g')) AS t
    FROM base),
cut AS (
    SELECT kind, id, string_split(t, ' ') AS raw FROM plain WHERE t <> ''),
typed AS (
    SELECT kind, id, raw, list_transform(raw, lambda x: CASE
        WHEN regexp_matches(x, '[0-9]') THEN '<num>'
        WHEN regexp_matches(x, '^\\p{Lu}') THEN '<name>' ELSE lower(x) END) AS w FROM cut),
template AS (
    SELECT kind, id, raw, list_transform(range(1, len(w) + 1), lambda i: CASE
        WHEN i > 1 AND w[i - 1] = '<num>' AND list_contains([{units}], raw[i]) THEN '<unit>' ELSE w[i] END) AS w
    FROM typed),
places AS (
    SELECT kind, id, raw, w, unnest(range(1, len(w) - 3)) AS p FROM template WHERE len(w) >= 5),
windows AS (
    SELECT kind, id, p, array_to_string(w[p:p + 4], ' ') AS window, w[p:p + 4] AS w, raw[p:p + 4] AS raw FROM places),
totals AS (SELECT id AS item_id, count(*) AS total FROM windows WHERE kind = 'b' GROUP BY id),
found AS (
    SELECT d.id AS doc_id, b.id AS item_id, b.p, d.p - b.p AS diagonal, d.w, b.raw AS was, d.raw AS now
    FROM windows d JOIN windows b ON d.kind = 'd' AND b.kind = 'b' AND d.window = b.window),
slots AS (
    SELECT doc_id, item_id, diagonal, was[k] AS was, now[k] AS now
    FROM found, unnest(range(1, 6)) AS u(k) WHERE w[k] LIKE '<%'),
mapped AS (
    SELECT doc_id, item_id, diagonal, count(DISTINCT was) AS a, count(DISTINCT was || ' ' || now) AS b,
           bool_and(was = now) AS same FROM slots GROUP BY ALL),
held AS (
    SELECT f.doc_id, f.item_id, count(DISTINCT f.p) AS windows, bool_and(coalesce(m.same, true)) AS same
    FROM found f LEFT JOIN mapped m USING (doc_id, item_id, diagonal)
    WHERE coalesce(m.a = m.b, true) GROUP BY f.doc_id, f.item_id)
SELECT doc_id, item_id, windows, windows / total AS share, same
FROM held JOIN totals USING (item_id) WHERE windows >= ceil(0.8 * total)
""".replace("{units}", ", ".join(f"'{u}'" for u in UNITS))
