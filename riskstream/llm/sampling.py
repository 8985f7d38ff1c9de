"""Fingerprints by consistent weighted sampling: equal samples estimate the generalised Jaccard similarity."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from riskstream.llm.common import shuffle_partitions, words_of

SAMPLES = 64
MOST_TERMS = 100_000            # words whose values a task keeps, and terms compared at once
WORDS_AT_ONCE = 200_000         # whose texts are fingerprinted together; a longer text is taken alone
MOST_WEIGHED = 40_000           # pairs of a repeated word and its weight whose values a task keeps
BLOCK_CHARS = 1 << 21           # characters fingerprinted at once
DRAWN_AT_ONCE = 256             # terms, so that their numbers stay in a core's cache
GOLDEN, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _uniform(hashes: np.ndarray, number: int, samples: int) -> np.ndarray:
    """Numbers in (0, 1), one per term and sample, by mixing the term's hash with a counter."""
    with np.errstate(over="ignore"):
        x = hashes[:, None] + (np.arange(samples, dtype=np.uint64) * np.uint64(5) + np.uint64(number + 1)) * GOLDEN
        x ^= x >> np.uint64(30)
        x *= MIX
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    x >>= np.uint64(40)
    return (x.astype(np.float32) + np.float32(0.5)) * np.float32(2.0 ** -24)


def _draws(hashes: np.ndarray, samples: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r and log c of Gamma(2, 1), and beta uniform: the same for a term wherever it stands."""
    r = -np.log(_uniform(hashes, 0, samples) * _uniform(hashes, 1, samples))
    log_c = np.log(-np.log(_uniform(hashes, 2, samples) * _uniform(hashes, 3, samples)))
    return r, log_c, _uniform(hashes, 4, samples)


def _weighed(hashes: np.ndarray, weights: np.ndarray, samples: int) -> tuple[np.ndarray, np.ndarray]:
    """The value of each term and sample, and 16 bits of the pair (term, t)."""
    values, codes = np.empty((len(hashes), samples), np.float32), np.empty((len(hashes), samples), np.uint16)
    for at in range(0, len(hashes), DRAWN_AT_ONCE):
        here = slice(at, at + DRAWN_AT_ONCE)
        r, log_c, beta = _draws(hashes[here], samples)
        steps = np.floor(np.log(weights[here])[:, None] / r + beta)
        values[here] = log_c - r * (steps - beta) - r
        with np.errstate(over="ignore"):
            mixed = (hashes[here, None] ^ (steps.astype(np.int64).view(np.uint64) * GOLDEN)) * MIX
        codes[here] = mixed >> np.uint64(48)
    return values, codes


class Sampler:
    """Signatures of texts; a term is a word with its number of occurrences as weight.

    A term of weight w has t = floor(log w / r + beta) and the value log c - r (t - beta) - r; the sample is the
    pair (term, t) with the smallest value. Two texts have the same sample with a probability of the sum of
    smaller weights over the sum of larger ones. Values depend on word and weight alone, so those of
    words that stand once and those of pairs (repeated word, weight) are kept, each up to a bound; of words, the
    half that most texts have stays when the bound is met.
    """

    def __init__(self, samples: int = SAMPLES):
        self.samples = samples
        self.places: dict[bytes, int] = {}
        self.hashes = np.zeros(0, np.uint64)
        self.values, self.codes = np.zeros((0, samples), np.float32), np.zeros((0, samples), np.uint16)
        self.texts_with = np.zeros(0, np.int32)
        self._forget_weighed()

    def _forget_weighed(self) -> None:
        self.weighed: dict[int, int] = {}
        self.weighed_values = np.zeros((0, self.samples), np.float32)
        self.weighed_codes = np.zeros((0, self.samples), np.uint16)

    def _shrink(self, most: int) -> None:
        """Keeps the `most` words that most texts have; a count is halved, so that what was frequent long ago can go."""
        kept = np.sort(np.argsort(-self.texts_with, kind="stable")[:most])
        words = list(self.places)
        self.places = dict(zip((words[i] for i in kept), range(len(kept))))
        self.hashes, self.values, self.codes = self.hashes[kept], self.values[kept], self.codes[kept]
        self.texts_with = self.texts_with[kept] // 2
        self._forget_weighed()                          # they are known by place

    def _learn(self, words_of_texts: list[Iterable[bytes]]) -> None:
        words = set().union(*words_of_texts)
        new = words.difference(self.places)
        if len(self.places) + len(new) > MOST_TERMS and self.places:
            self._shrink(max(0, min(MOST_TERMS // 2, MOST_TERMS - len(new))))
            new = words.difference(self.places)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, new), np.uint64, len(new))
        values, codes = _weighed(hashes, np.ones(len(new), np.float32), self.samples)
        self.places.update(zip(new, range(len(self.places), len(self.places) + len(new))))
        self.hashes, self.values = np.concatenate((self.hashes, hashes)), np.concatenate((self.values, values))
        self.codes = np.concatenate((self.codes, codes))
        self.texts_with = np.concatenate((self.texts_with, np.zeros(len(new), np.int32)))

    def _weigh(self, places: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Rows of the kept values of repeated words; those that are not kept yet are drawn together."""
        keys = ((places << 32) | weights.astype(np.int64)).tolist()
        new = [k for k in dict.fromkeys(keys) if k not in self.weighed]
        if new:
            if len(self.weighed) + len(new) > MOST_WEIGHED:
                self._forget_weighed()
                new = list(dict.fromkeys(keys))
            wanted = np.array(new, np.int64)
            values, codes = _weighed(
                self.hashes[wanted >> 32], (wanted & 0xFFFFFFFF).astype(np.float32), self.samples)
            self.weighed.update(zip(new, range(len(self.weighed), len(self.weighed) + len(new))))
            self.weighed_values = np.concatenate((self.weighed_values, values))
            self.weighed_codes = np.concatenate((self.weighed_codes, codes))
        return np.fromiter(map(self.weighed.__getitem__, keys), np.int64, len(keys))

    def signatures(self, texts: list[str]) -> np.ndarray:
        """A row of 16-bit samples for each text; zeros for one without words. Texts with the same words, each as often, have the
        same row, whatever stands beside them."""
        out = np.zeros((len(texts), self.samples), np.uint16)
        held: list[tuple[int, list[bytes]]] = []
        size = 0
        for i, text in enumerate(texts):
            words = words_of(text.encode())
            if held and size + len(words) > WORDS_AT_ONCE:
                self._sign(held, out)
                held, size = [], 0
            if words:
                held.append((i, words))
                size += len(words)
        if held:
            self._sign(held, out)
        return out

    def _sign(self, held: list[tuple[int, list[bytes]]], out: np.ndarray) -> None:
        """Fills the rows of `out` of these texts, which have WORDS_AT_ONCE words or are one text."""
        numbered = pa.array(chain.from_iterable(words for _, words in held), pa.large_binary()).dictionary_encode()
        found, numbers = numbered.dictionary.to_pylist(), numbered.indices.to_numpy()
        if len(held) == 1:
            times = np.bincount(numbers)
            smallest = None
            for at in range(0, len(found), MOST_TERMS):
                part = found[at:at + MOST_TERMS]
                self._learn([part])
                smallest = self._smallest(*self._by_hash(self._placed(part), times[at:at + MOST_TERMS]), smallest)
            out[held[0][0]] = smallest[1]
            return
        self._learn([found])
        places, numbers_by_hash = self._by_hash(self._placed(found), np.arange(len(found)))
        rank = np.empty(len(found), np.int64)
        rank[numbers_by_hash] = np.arange(len(found))
        keys = np.repeat(np.arange(len(held)), [len(words) for _, words in held]) << 32
        keys |= rank[numbers]
        keys.sort()
        starts = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1))
        weights = np.diff(starts, append=len(keys))
        keys = keys[starts]
        places = places[keys & 0xFFFFFFFF]
        self.texts_with += np.bincount(places, minlength=len(self.texts_with)).astype(np.int32)
        if (weights > 1).any():
            self._weigh(places[weights > 1], weights[weights > 1])
        ends = np.searchsorted(keys >> 32, np.arange(len(held)), side="right")
        for (i, _), start, end in zip(held, (0, *ends), ends):
            out[i] = self._sample(places[start:end], weights[start:end])

    def _placed(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))

    def _by_hash(self, places: np.ndarray, beside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Both by the words' hashes: of equal values the first counts, and that must not depend on other texts."""
        order = np.argsort(self.hashes[places])
        return places[order], beside[order]

    def _sample(self, places: np.ndarray, weights: np.ndarray) -> np.ndarray:
        return self._smallest(places, weights, None)[1]

    def _smallest(self, places: np.ndarray, weights: np.ndarray, known: tuple[np.ndarray, np.ndarray] | None
                  ) -> tuple[np.ndarray, np.ndarray]:
        """The smallest value of each sample and its code, among these terms and what is known."""
        smallest, found = known or (np.full(self.samples, np.inf, np.float32), np.zeros(self.samples, np.uint16))
        columns = np.arange(self.samples)
        for at in range(0, len(places), MOST_TERMS):
            here, times = places[at:at + MOST_TERMS], weights[at:at + MOST_TERMS]
            more = times > 1
            once, repeated = here[~more], here[more]
            for rows, values, codes in (
                    (once, self.values, self.codes),
                    (self._weigh(repeated, times[more]) if len(repeated) else repeated, None, None)):
                if not len(rows):
                    continue
                if values is None:                      # read after `_weigh`, which may replace them
                    values, codes = self.weighed_values, self.weighed_codes
                picked = values[rows]
                best = picked.argmin(axis=0)
                value = picked[best, columns]
                less = value < smallest
                smallest[less] = value[less]
                found[less] = codes[rows[best[less]], columns[less]]
        return smallest, found


def text_of(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def fingerprinted(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """(doc_id, fingerprint) of every whole text: four hex digits per sample. Null text is empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(samples)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                found = sampler.signatures([t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([text_of(s) for s in found])], ["doc_id", "fingerprint"])

    ids = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {ids}, fingerprint string")


def _cuts(docs: DataFrame, parts: int) -> list[float]:
    """Where descending doc_id are cut into about equal parts; ascending."""
    if parts < 2:
        return []
    shares = [i / parts for i in range(1, parts)]
    return sorted(set(docs.approxQuantile("doc_id", shares, 1 / (8 * parts))))


def compared_with_next(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Each document's fingerprint against that of its edited text and that of the next document.

    Documents are in the order of descending doc_id (nulls last; equal ones by a hash of the text, so repeated
    rows follow each other), and the first follows the last. The edited text is the text with its last
    floor(n / 2) of n code points replaced by the first as many of the next text. Returns doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next, both the share of equal samples.
    Null text is empty; a single row is its own next; no rows: no rows.

    Texts are cut by ranges of doc_id and sorted once, compressed on the way; the first row of each range
    goes to the range before it, too.
    """
    parts = shuffle_partitions(docs.sparkSession)
    cuts = _cuts(docs.select("doc_id"), parts)

    @pandas_udf("int")
    def part_of(ids: pd.Series) -> pd.Series:
        values = ids.to_numpy(np.float64, na_value=-np.inf)
        return pd.Series(len(cuts) - np.searchsorted(cuts, values, side="right"), dtype="int32")

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"), "text").withColumn(
        "part", part_of("doc_id"))
    # One row per range, whose number is that of the cuts.
    heads = keyed.groupBy("part").agg(
        F.max(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "hash")).alias("head")).orderBy("part").collect()
    follows = {(r.head.doc_id, r.head.hash): heads[i - 1].part for i, r in enumerate(heads)}

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=1).compress
        names = ["part", "halo", "doc_id", "hash", "packed"]
        for batch in batches:
            ids, hashes, texts, where = (batch.column(n).to_pylist() for n in ("doc_id", "hash", "text", "part"))
            rows = [(p, False, i, h, compress((t or "").encode())) for i, h, t, p in zip(ids, hashes, texts, where)]
            rows += [(follows[i, h], True, i, h, r[4]) for i, h, r in zip(ids, hashes, rows) if (i, h) in follows]
            kinds = [pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.binary()]
            for at in range(0, len(rows), 2000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows[at:at + 2000]), kinds)], names)

    sent = keyed.mapInArrow(send, "part int, halo boolean, doc_id long, hash long, packed binary")
    ordered = sent.repartitionById(len(cuts) + 1, "part").sortWithinPartitions(
        "halo", F.desc_nulls_last("doc_id"), F.desc("hash"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler, expand = Sampler(samples), zstandard.ZstdDecompressor()
        held: list[tuple[int | None, str]] = []         # rows; the last one is only the next of the one before

        def flush() -> pa.RecordBatch:
            texts = [t for _, t in held]
            edited = [t[:len(t) - len(t) // 2] + after[:len(t) // 2] for t, after in zip(texts, texts[1:])]
            # Beside each other, as they share most words.
            found = sampler.signatures([t for both in zip(texts, [*edited, ""]) for t in both])
            own, changed = found[::2], found[1:-1:2]
            return pa.RecordBatch.from_arrays([
                pa.array([i for i, _ in held[:-1]], pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
                pa.array([text_of(s) for s in own[:-1]]), pa.array([text_of(s) for s in changed]),
                pa.array((own[:-1] == changed).mean(axis=1)), pa.array((own[:-1] == own[1:]).mean(axis=1))],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

        size, ended = 0, False
        for batch in batches:
            for halo, i, packed in zip(*(batch.column(n).to_pylist() for n in ("halo", "doc_id", "packed"))):
                if ended:                               # repeated rows of one head follow it
                    continue
                held.append((i, expand.decompress(packed).decode()))
                size, ended = size + len(held[-1][1]), halo
                if size >= BLOCK_CHARS and len(held) > 1:
                    yield flush()
                    held[:-1] = []
                    size = len(held[0][1])
        if len(held) > 1:
            yield flush()

    return ordered.mapInArrow(
        compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                 "near_edited double, near_next double")
