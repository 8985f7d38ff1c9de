"""Collocations: the best-scored phrases of each language, by best-first growth with bounds from counts of prefixes."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskstream.llm.common import arrow_pieces, written

LONGEST = 4
NO_LANGUAGE = "und"
SCALE, PERCENT = 2_000_000, 80
RUN_WORDS = 200_000             # words of a run, one row of the written corpus
MOST_RUNS = 64                  # languages that a task has open runs of
CHUNK_WORDS = 1_000_000         # words that a task counts at once
ROWS = 100_000                  # of a batch that a task hands on
FEW_LANGUAGES = 10_000          # a table with a row for each is sent to every task
LEAST_BITS, MOST_BITS = 20, 27  # size of a filter, as powers of two: at most 16 MB
# Splitters become a word of their own, which no phrase holds; what is left of white space ends words.
SPLIT = bytes.maketrans(b".,;:!?\n\x0b\x0c\rABCDEFGHIJKLMNOPQRSTUVWXYZ\t", b"." * 10 + b"abcdefghijklmnopqrstuvwxyz ")
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))

COUNTED = "lang string, phrase string, n long"


def words_and_marks(text: str | None) -> list[bytes]:
    """Words in order, A-Z lower-cased, with b"." wherever pieces of the text meet."""
    return (text or "").encode().translate(SPLIT).replace(b".", b" . ").split()


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of phrases from the hashes of two parts, in order. Only filters use them."""
    with np.errstate(over="ignore"):
        x = left * MIX[0] + (right ^ (right >> np.uint64(29))) * MIX[1]
        return (x ^ (x >> np.uint64(32))) * MIX[2]


def _word_hashes(lang: str, words: Iterable[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(word, seed) for word in words), np.uint64)


def _windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the phrase of `size` words from each place."""
    out = hashes
    for k in range(1, size):
        out = _joined(out[:len(out) - 1], hashes[k:])
    return out


def _phrase_hashes(langs: list[str], phrases: list[str]) -> np.ndarray:
    """Of phrases with equally many words."""
    seeds = {lang: xxhash.xxh64_intdigest(lang.encode()) for lang in set(langs)}
    words = np.array([[xxhash.xxh64_intdigest(word, seeds[lang]) for word in phrase.encode().split(b" ")] for lang, phrase in zip(langs, phrases)], np.uint64)
    out = words[:, 0]
    for k in range(1, words.shape[1]):
        out = _joined(out, words[:, k])
    return out


class Filter:
    """A set of phrases as bits of their hashes: says yes to every phrase in it and to few others, whatever their number. It only
    decides what is counted; what is counted is counted in full."""

    def __init__(self, bits: int, table: np.ndarray):
        self.bits, self.table = bits, table

    @classmethod
    def of(cls, phrases: DataFrame) -> Filter:
        """The driver gets one number per 64 bits, at most 2^21 of them; more phrases than a tenth of the bits pass more others."""
        bits = min(MOST_BITS, max(LEAST_BITS, ceil(log2(max(1, phrases.count()) * 16))))

        def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    slots = _phrase_hashes(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist()) >> np.uint64(64 - bits)
                    ones = np.uint64(1) << (slots & np.uint64(63))
                    yield pa.RecordBatch.from_arrays([pa.array((slots >> np.uint64(6)).astype(np.int64)), pa.array(ones.view(np.int64))], ["at", "ones"])

        marks = phrases.select("lang", "phrase").mapInArrow(marked, "at long, ones long").groupBy("at").agg(F.bit_or("ones").alias("ones"))
        found = marks.toArrow()
        table = np.zeros(1 << (bits - 6), np.uint64)
        table[found.column("at").to_numpy()] = found.column("ones").to_numpy().view(np.uint64)
        return cls(bits, table)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        slots = hashes >> np.uint64(64 - self.bits)
        return (self.table[slots >> np.uint64(6)] >> (slots & np.uint64(63))) & np.uint64(1) > 0


# What to count: takes the hashes of the words of a run, and gives for a phrase size the places to count.
Admits = Callable[[Callable[[int], np.ndarray], list[Filter]], np.ndarray]


def _counts(words: pa.Array, ids: np.ndarray, size: int, places: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The different phrases at `places`, and how often each is there; exact, as it compares numbers of words."""
    def paired(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)

    parts = [ids[places + k] for k in range(size)]
    keys = parts[0] if size == 1 else paired(parts[0], parts[1])
    for part in parts[2:]:
        keys = paired(np.unique(keys, return_inverse=True)[1], part)
    _, first, n = np.unique(keys, return_index=True, return_counts=True)
    columns = [words.take(pa.array(part[first])) for part in parts]
    return pc.binary_join_element_wise(*columns, " ") if size > 1 else columns[0], n


class _Run:
    """Words of one language in order, numbered as they come. The first is b".", which is no word."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = {b".": 0}
        self.ids: list[np.ndarray] = []
        self.held = 0
        self.leads: list[int] = []

    def add(self, tokens: list[bytes], goes_on: bool) -> None:
        numbers = self.numbers
        for token in set(tokens):
            numbers.setdefault(token, len(numbers))
        if goes_on:
            self.leads.append(self.held)
        self.ids += [np.fromiter(map(numbers.__getitem__, tokens), np.uint32, len(tokens)), np.zeros(1, np.uint32)]
        self.held += len(tokens) + 1


def encoded(docs: DataFrame) -> DataFrame:
    """(lang, words, ids, leads): all texts as numbers of words, in runs of at most about RUN_WORDS that each list their own words.

    A longer text goes on in the next run, which repeats its last LONGEST - 1 words; `leads` says where such repetitions begin.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[str, _Run] = {}

        def closed(lang: str) -> pa.RecordBatch:
            done = runs.pop(lang)
            blobs = b" ".join(done.numbers), np.concatenate(done.ids).astype("<u4").tobytes(), np.array(done.leads, "<u4").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([lang]), *(pa.array([blob], pa.binary()) for blob in blobs)], ["lang", "words", "ids", "leads"])

        for batch in arrow_pieces(batches, "text"):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                lang, tokens = NO_LANGUAGE if lang is None else lang, words_and_marks(text)
                for start in range(0, len(tokens), RUN_WORDS):
                    if lang in runs and runs[lang].held + len(tokens) - start > RUN_WORDS:
                        yield closed(lang)
                    runs.setdefault(lang, _Run()).add(tokens[max(0, start - LONGEST + 1):start + RUN_WORDS], start > 0)
                if len(runs) > MOST_RUNS:
                    yield closed(next(iter(runs)))
        for lang in list(runs):
            yield closed(lang)

    texts = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "lang string, words binary, ids binary, leads binary")


class _Chunk:
    """Runs of one language, renumbered to be counted together."""

    def __init__(self, lang: str):
        self.lang = lang
        self.numbers: dict[bytes, int] = {b".": 0}
        self.ids: list[np.ndarray] = []
        self.held = 0
        self.leads: list[int] = []

    def add(self, words: pa.Buffer, ids: pa.Buffer, leads: pa.Buffer) -> int:
        numbers, listed = self.numbers, words.to_pybytes().split(b" ")
        for word in listed:
            numbers.setdefault(word, len(numbers))
        own = np.fromiter(map(numbers.__getitem__, listed), np.uint32, len(listed))
        self.ids.append(own[np.frombuffer(ids, "<u4")])
        self.leads += (np.frombuffer(leads, "<u4") + self.held).tolist()
        self.held += len(self.ids[-1])
        return len(self.ids[-1])

    def counted(self, size: int, admits: Admits | None, filters: list[Filter]) -> Iterator[pa.RecordBatch]:
        ids = np.concatenate(self.ids)
        word = ids > 0
        inside = word[:max(0, len(ids) - size + 1)].copy()
        for k in range(1, size):
            inside &= word[k:len(ids) - size + 1 + k]
        for lead in self.leads:         # counted in the run before
            inside[lead:lead + LONGEST - size] = False
        if admits is not None and len(inside):
            hashes = _word_hashes(self.lang, self.numbers)[ids]
            inside &= admits(lambda n: _windows(hashes, n), filters)
            del hashes
        places = np.flatnonzero(inside)
        if size == 1:       # the number of all words
            yield self._rows(pa.array([""]), np.array([len(places)]))
        if len(places):
            yield self._rows(*_counts(pa.array(list(self.numbers), pa.binary()).cast(pa.string()), ids, size, places))

    def _rows(self, phrases: pa.Array, n: np.ndarray) -> pa.RecordBatch:
        langs = pa.array([self.lang], pa.string()).take(pa.array(np.zeros(len(n), np.int32)))
        return pa.RecordBatch.from_arrays([langs, phrases, pa.array(n.astype(np.int64))], ["lang", "phrase", "n"])


def phrase_counts(runs: DataFrame, size: int, admits: Admits | None = None, filters: tuple[Filter, ...] = ()) -> DataFrame:
    """(lang, phrase, n) of the phrases that `admits` lets through: every occurrence in `encoded` runs, overlaps too, summed per
    task first. For words, the empty phrase holds the number of all."""
    spark = runs.sparkSession
    sent = [(f.bits, spark.sparkContext.broadcast(f.table)) for f in filters]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [Filter(bits, table.value) for bits, table in sent]
        chunks: dict[str, _Chunk] = {}
        held = 0

        def flushed() -> Iterator[pa.RecordBatch]:
            while chunks:
                for rows in chunks.pop(next(iter(chunks))).counted(size, admits, tables):
                    yield from (rows.slice(at, ROWS) for at in range(0, rows.num_rows, ROWS))
                pa.default_memory_pool().release_unused()

        for batch in batches:
            for lang, *blobs in zip(*batch.columns):
                lang = lang.as_py()
                held += chunks.setdefault(lang, _Chunk(lang)).add(*(blob.as_buffer() for blob in blobs))
                if held >= CHUNK_WORDS:
                    yield from flushed()
                    held = 0
        yield from flushed()

    return runs.mapInArrow(run, COUNTED).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _score(a: str, parts: str) -> Column:
    """floor(2000000 a / parts) in whole numbers of any size that counts can take."""
    return F.expr(f"CAST({SCALE} AS DECIMAL(7, 0)) * CAST({a} AS DECIMAL(19, 0)) DIV ({parts})")


def _sum(left: str, right: str) -> str:
    return f"CAST({left} AS DECIMAL(19, 0)) + CAST({right} AS DECIMAL(19, 0))"


def _words(start: str, count: str) -> Column:
    return F.expr(f"array_join(slice(split(phrase, ' '), {start}, {count}), ' ')")


def _cuts(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """Each phrase at each of its cuts, with the counts of both parts (null where a part is not counted yet), and the count of
    its first word."""
    size = "size(split(phrase, ' '))"
    parts = phrases.withColumn("k", F.explode(F.expr(f"sequence(1, {size} - 1)"))).withColumns(
        {"left": _words("1", "k"), "right": _words("k + 1", f"{size} - k")})
    l, r = (counts.select("lang", F.col("phrase").alias(side), F.col("n").alias(name)) for side, name in (("left", "l"), ("right", "r")))
    return parts.join(l, ["lang", "left"], "left").join(r, ["lang", "right"], "left").select("lang", "phrase", "n", "k", "l", "r", "right")


def scored(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, phrase, n, k, l, r, score, bound, full): the lowest-scoring cut, with the smallest k of equal ones.

    `bound` is what no phrase that begins with this one can exceed: it occurs at most n times, its parts after the first word at
    least as often, and the first word as often as it does. `full` is false where a left part is not counted, and
    `open` names the right part that is not: such a part counts as often as the phrase, which can only raise the score.
    """
    cut = _cuts(phrases, counts).withColumn("score", _score("n", _sum("l", "coalesce(r, n)")))
    best = F.min(F.when(F.col("l").isNotNull(), F.struct("score", "k", "l", "r")))
    bound = F.max(F.when(F.col("k") == 1, _score("n", _sum("l", "n"))))
    out = cut.groupBy("lang", "phrase", "n").agg(
        best.alias("best"), bound.alias("bound"), F.every(F.col("l").isNotNull()).alias("full"),
        F.max(F.when(F.col("r").isNull(), F.col("right"))).alias("open"))
    return out.select("lang", "phrase", "n", "best.k", "best.l", "best.r", "best.score", "bound", "full", "open")


def _thresholds(pairs: DataFrame, wanted: int) -> DataFrame:
    """(lang, least): a score that at least `wanted` pairs of the language reach, or 0. From counts by
    score in steps of 1,024: a thousand rows a language."""
    steps = pairs.groupBy("lang", F.expr("score DIV 1024").alias("step")).agg(F.count(F.lit(1)).alias("pairs"))
    above = Window.partitionBy("lang").orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, 0)
    reached = steps.withColumn("reached", F.sum("pairs").over(above))
    return reached.groupBy("lang").agg(F.coalesce(F.max(F.when(F.col("reached") >= wanted, F.col("step"))) * 1024, F.lit(0)).alias("least"))


def _inner(longer: DataFrame) -> DataFrame:
    """(lang, phrase, most): the count of the most frequent phrase of one word more that holds it. One of two or more words more
    is no more frequent than one of these."""
    size = "size(split(phrase, ' '))"
    return longer.select("lang", F.explode(F.array(_words("1", f"{size} - 1"), _words("2", f"{size} - 1"))).alias("phrase"), "n").groupBy(
        "lang", "phrase").agg(F.max("n").alias("most"))


def _surviving(candidates: DataFrame, longer: DataFrame) -> DataFrame:
    dropped = F.expr(f"coalesce(CAST(100 AS DECIMAL(3, 0)) * CAST(most AS DECIMAL(19, 0)) >= CAST({PERCENT} AS DECIMAL(3, 0)) "
                     "* CAST(n AS DECIMAL(19, 0)), false)")
    return candidates.join(_inner(longer), ["lang", "phrase"], "left").where(~dropped).drop("most")


def _both(left: DataFrame, right: DataFrame) -> DataFrame:
    """Counts of two rounds; a phrase in both has the same count in both."""
    return left.unionByName(right).groupBy("lang", "phrase").agg(F.max("n").alias("n"))


def _pairs(windows: Callable[[int], np.ndarray], filters: list[Filter]) -> np.ndarray:
    known = filters[0](windows(1))
    return known[:-1] & known[1:]


def _grown(size: int) -> Admits:
    """Phrases that begin with an expanded one of a word less, or end with a candidate. All their pairs are frequent."""
    def admits(windows: Callable[[int], np.ndarray], filters: list[Filter]) -> np.ndarray:
        frequent, expanded, candidates = filters
        pairs, parts = frequent(windows(2)), windows(size - 1)
        out = expanded(parts)[:-1] | candidates(parts)[1:]
        for k in range(size - 1):
            out &= pairs[k:len(pairs) - (size - 2) + k]
        return out

    return admits


def _tails(windows: Callable[[int], np.ndarray], filters: list[Filter]) -> np.ndarray:
    return filters[0](windows(LONGEST - 1))


def collocations(docs: DataFrame, top: int = 2000, at_least: int = 30, first_wanted: int | None = None) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first `top` phrases of 2 to 4 words.

    All is counted per language (null: `und`) over all of `docs`. Words and pairs of frequent words are counted whole. The frontier,
    best bounds first, is then what can still lead to a score of at least `least`, and `least` starts where some
    multiple of `top` pairs reach it. Phrases of 3 and 4 words are counted where they grow from the frontier or hold a
    candidate, so every candidate from `least` on has its exact score and is kept or dropped for good. A language with fewer than
    `top` kept ones goes on with a lower `least`, 0 at last; since ties at the last place reach `least` too, the order of the first `top`
    is then settled. Each round's counts are written tables; filters of fixed size tell the tasks what to count.

    Null and empty texts have no words; rows that repeat count each for itself; an empty table gives an empty result.
    Only `text` and `lang` are read.
    """
    runs = written(encoded(docs), "runs")
    frequent = F.col("n") >= at_least
    every_word = written(phrase_counts(runs, 1).where(frequent | (F.col("phrase") == "")), "words")
    words, totals = every_word.where("phrase <> ''").where(frequent), every_word.where("phrase = ''").select("lang", F.col("n").alias("total"))
    counted = written(phrase_counts(runs, 2, _pairs, (Filter.of(words),)).where(frequent), "pairs")
    pairs = written(scored(counted, words), "scored-pairs")
    any_pair = Filter.of(pairs)
    counts = {1: words, 2: counted, 3: None, 4: None}
    wanted = first_wanted or 4 * top
    unsettled, kept = None, None
    while True:
        least = _thresholds(pairs, wanted)
        if unsettled is not None:
            least = least.join(unsettled, "lang", "left_semi")
        least = written(least, "thresholds")
        found = _settled(runs, pairs, any_pair, counts, least, frequent)
        result = written(found, "settled")
        kept = result if kept is None else kept.unionByName(result)
        done = result.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
        unsettled = written(least.join(done, "lang", "left").where((F.coalesce("kept", F.lit(0)) < top) & (F.col("least") > 0)).select("lang"), "unsettled")
        if unsettled.isEmpty():
            break
        # What a language had is found again, and more: its earlier rows go.
        kept = kept.join(unsettled, "lang", "left_anti")
        wanted *= 8
    return ranked(kept, top).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")


def ranked(kept: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("n"), "phrase")
    return kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top).withColumnRenamed("n", "a")


def _settled(runs: DataFrame, pairs: DataFrame, any_pair: Filter, counts: dict[int, DataFrame | None], least: DataFrame,
             frequent: Column) -> DataFrame:
    """(lang, phrase, n, l, r, score) of all candidates with a score of `least` or more that no longer one drops."""
    per_language = F.broadcast(least) if least.count() <= FEW_LANGUAGES else least

    def reach(phrases: DataFrame, measure: str) -> DataFrame:
        return phrases.join(per_language, "lang").where(F.col(measure) >= F.col("least")).drop("least")

    candidates = {2: reach(pairs, "score")}
    expanded = reach(pairs, "bound")
    below = counts[1].unionByName(counts[2])
    longer: dict[int, DataFrame] = {}
    for size in range(3, LONGEST + 1):
        filters = (any_pair, Filter.of(expanded), Filter.of(candidates[size - 1]))
        new = written(phrase_counts(runs, size, _grown(size), filters).where(frequent), f"phrases-{size}")
        counts[size] = new if counts[size] is None else written(_both(counts[size], new), f"phrases-{size}")
        longer[size] = counts[size]
        found = written(scored(counts[size], below), f"scored-{size}")
        reached = reach(found.where("full"), "score")
        missing = reached.where("open IS NOT NULL").select("lang", F.col("open").alias("phrase")).distinct()
        if size == LONGEST:
            missing = written(missing, "missing")
            if not missing.isEmpty():
                tails = phrase_counts(runs, size - 1, _tails, (Filter.of(missing),)).where(frequent)
                counts[size - 1] = written(_both(counts[size - 1], tails), "phrases-3")
                below = counts[1].unionByName(counts[2]).unionByName(counts[3])
                found = written(scored(reached.select("lang", "phrase", "n"), below), "scored-again")
                reached = reach(found.where("full"), "score")
        candidates[size] = reached
        expanded = reach(found.where("bound IS NOT NULL"), "bound")
        below = below.unionByName(counts[size])
    parts = [_surviving(candidates[size], longer[size + 1]) if size < LONGEST else candidates[size] for size in candidates]
    rows = [p.select("lang", "phrase", "n", "l", "r", "score") for p in parts]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def oracle(top: int = 2000, at_least: int = 30) -> str:
    """The same in DuckDB's SQL, which counts all phrases."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    grams = " UNION ALL ".join(
        f"SELECT lang, {n} AS size, array_to_string(ws[i:i + {n - 1}], ' ') AS phrase FROM pieces, unnest(range(1, len(ws) - {n - 2})) AS t(i)"
        for n in range(1, LONGEST + 1))
    return f"""
WITH split AS (
  SELECT coalesce(lang, '{NO_LANGUAGE}') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\n\x0B\f\r]')) AS piece FROM documents),
pieces AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS ws FROM split),
totals AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS total FROM pieces GROUP BY lang),
counts AS (SELECT lang, size, phrase, count(*) AS f FROM ({grams}) GROUP BY ALL HAVING count(*) >= {at_least}),
cuts AS (
  SELECT lang, size, phrase, f AS a, k, array_to_string(ws[1:k], ' ') AS head, array_to_string(ws[k + 1:], ' ') AS tail
  FROM (SELECT *, string_split(phrase, ' ') AS ws FROM counts WHERE size > 1), unnest(range(1, size)) AS t(k)),
cut_scores AS (
  SELECT c.lang, c.size, c.phrase, c.a, c.k, h.f AS l, t.f AS r, CAST({SCALE}::HUGEINT * c.a // (h.f::HUGEINT + t.f) AS BIGINT) AS score
  FROM cuts c JOIN counts h ON h.lang = c.lang AND h.phrase = c.head JOIN counts t ON t.lang = c.lang AND t.phrase = c.tail),
lowest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM cut_scores) WHERE place = 1),
parts AS (
  SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(f) AS most
  FROM (SELECT *, string_split(phrase, ' ') AS ws FROM counts WHERE size > 2), unnest(range(2, size)) AS t(m), unnest(range(1, size - m + 2)) AS u(i)
  GROUP BY ALL)
SELECT lang, rank, phrase, a, l, r, total AS n, score FROM (
  SELECT lang, phrase, a, l, r, score, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest LEFT JOIN parts USING (lang, phrase) WHERE most IS NULL OR 100::HUGEINT * most < {PERCENT}::HUGEINT * a)
JOIN totals USING (lang) WHERE rank <= {top}"""
