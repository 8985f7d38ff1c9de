"""Texts scored by a causal self-attention model over subword ids, beside a unigram base."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from riskstream.llm.common import arrow_pieces, hash_part, kept_in_process, written
from riskstream.llm.subwords import Encoder

IDS = 50_257                # of the vocabulary
END_ID = 50_256             # ends a text, and stands before it
END_WORD = b" "             # no word has a space
FREQUENT = 2048             # ids with a row of their own; the others share one
CLASSES = 48
NEAR = 256                  # ids that describe a neighbourhood when classes are made
DIM = 16
PAST, STEP = 16, 16         # a window scores STEP ids and sees PAST more before them
WINDOWS = 512               # in a batch
TILE = 128                  # windows of a batch that are computed at once, so that they stay in a core's cache
SAMPLE_CHARS = 1_000_000    # ids whose windows a task shuffles before it learns from all of them
ROUNDS = 4                  # parts of the learned texts, after each of which the tasks' weights are averaged
TRAIN_STEPS, TRAIN_WINDOWS, RATE = 500, 128, 3e-3   # steps at least, where a task's texts are few
TRAINED = ("query", "key", "value", "query_at", "key_at", "value_at", "out")
BLOCK = 256                 # weights in a row, when tasks send theirs
FIXED = 1 << 20             # weights are summed as whole numbers of this part of one, so in any order
KEPT = 10                   # pairs' worth of what a row's class says, where pairs are few
OWN_SHARE = 0.5             # of a word's probability, from its ids
NEVER = -1e4                # logarithm of nothing
CHUNK_WORDS = 3_000_000     # words whose strings a task keeps; also bytes of texts that are numbered at once
BUCKETS = 1024              # parts of a chunk's words, and of its pairs, that meet those of other chunks


class WordEncoder(Encoder):
    """Encodes words in UTF-8, each with a space before it."""

    def __init__(self, path: str):
        super().__init__(path)
        self.begins = np.zeros(IDS, bool)               # ids of tokens with a space in front
        for i in range(self.encoding.n_vocab - 1):
            self.begins[i] = self.encoding.decode_single_token_bytes(i).startswith(b" ")

    def words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all, how many each has). The words are one text, which parts where an id has a space in front."""
        ids = self.encoding.encode_to_numpy(" " + b" ".join(words).decode(), disallowed_special=()).astype(np.int64)
        starts = np.flatnonzero(self.begins[ids])
        if len(starts) == len(words):
            return ids, np.diff(np.append(starts, len(ids)))
        each = [self.encoding.encode_ordinary(" " + w.decode()) for w in words]
        return np.array([i for e in each for i in e], np.int64), np.array(list(map(len, each)))

    def sequence(self, words: list[bytes]) -> np.ndarray:
        return np.append(self.words(words)[0] if words else np.zeros(0, np.int64), END_ID)


def word_ids(path: str) -> WordEncoder:
    return kept_in_process(("words", path), lambda: WordEncoder(path))


class Numbered:
    """The words of texts, numbered as they come, with their ids. The end is number 0."""

    def __init__(self, encoder: WordEncoder):
        self.encoder = encoder
        self.held: list[pa.Array] = [pa.array([], pa.large_binary())]
        self.lengths = [np.zeros(0, np.int64)]

    def add(self, texts: pa.Array) -> np.ndarray:
        """How many words and ends each text has."""
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
        words = split.flatten()
        there = pc.binary_length(words).to_numpy() > 0                 # white space at either end leaves an empty one
        ends = np.cumsum(pc.list_value_length(split).to_numpy())
        self.lengths.append(np.diff(np.append(0, np.cumsum(there))[ends], prepend=0) + 1)
        self.held.append(words.filter(pa.array(there)).cast(pa.binary()).cast(pa.large_binary()))
        return self.lengths[-1]

    def close(self) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of all texts' words, an end behind each; how many each has). The words are encoded at once."""
        coded, lengths = pa.concat_arrays(self.held).dictionary_encode(), np.concatenate(self.lengths)
        numbers = np.zeros(len(coded) + len(lengths), np.int64)
        is_word = np.ones(len(numbers), bool)
        is_word[np.cumsum(lengths) - 1] = False
        numbers[is_word] = coded.indices.to_numpy() + np.int64(1)
        words = coded.dictionary.to_numpy(zero_copy_only=False)
        ids, sizes = self.encoder.words(words) if len(words) else (np.zeros(0, np.int64),) * 2
        self.flat, self.sizes = np.append(END_ID, ids).astype("<u2"), np.append(1, sizes)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.held = []
        return numbers, lengths

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all, how many each has)"""
        return spelled(self.flat, self.starts, self.sizes, numbers)

    def sequences(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text and its end."""
        self.add(pa.array(texts, pa.string()))
        numbers, lengths = self.close()
        ids, each = self.ids(numbers)
        return np.split(ids.astype(np.int32), np.cumsum(each)[np.cumsum(lengths) - 1][:-1])


def spelled(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all numbered words, how many each has); the word of a number has `sizes` ids of `flat` from `starts` on."""
    each = sizes[numbers]
    at = np.repeat(starts[numbers] - (np.cumsum(each) - each), each)
    at += np.arange(len(at))
    return flat.take(at), each


def packed(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary rows: the bytes of `values` up to each of `ends`, from the one before on."""
    offsets = np.append(0, ends) * values.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(values)]).cast(pa.binary())


def unpacked(column: pa.Array | pa.ChunkedArray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(values of all rows of `packed`, how many each has)"""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), kind), np.array(list(map(len, rows)), np.int64) // np.dtype(kind).itemsize


def pair_keys(before: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return before.astype(np.int64) << 16 | ids


def learned(docs: DataFrame) -> DataFrame:
    """`docs` with `learn`: crc32 of the id as text modulo 7 is not 2; a null id is learned."""
    return docs.withColumn("learn", F.coalesce(hash_part("doc_id") % 7 != 2, F.lit(True)))


# Classes -------------------------------------------------------------------------------------------

def frequent_ids(counts: np.ndarray) -> np.ndarray:
    """The ids with rows of their own, most frequent first; the end is one."""
    counts = counts.copy()
    counts[END_ID] = max(counts[END_ID], 1)
    frequent = np.argsort(-counts, kind="stable")[:FREQUENT]
    return frequent[counts[frequent] > 0]


def make_classes(counts: np.ndarray, frequent: np.ndarray, pairs: np.ndarray, seed: int = 0) -> np.ndarray:
    """Class of every id, from how often each id stands and each row after each row. Frequent ids with alike neighbours
    share a class; the most frequent ids are classes of their own, and the last class has the ids without a row."""
    near = min(NEAR, len(frequent))
    features = np.hstack([np.hstack([table[:len(frequent), :near], table[:len(frequent), near:].sum(axis=1, keepdims=True)])
                          for table in (pairs, pairs.T)]).astype(float)
    features = np.sqrt(features / np.maximum(features.sum(axis=1, keepdims=True), 1))
    alone = min(12, len(frequent))
    kinds = CLASSES - 1 - alone
    weights, points = np.maximum(counts[frequent[alone:]], 1), features[alone:]
    classes = np.full(IDS, CLASSES - 1)
    classes[frequent[:alone]] = np.arange(alone)
    if len(points):
        rng = np.random.default_rng(seed)
        centres = points[rng.choice(len(points), min(kinds, len(points)), replace=False, p=weights / weights.sum())]
        for _ in range(25):
            nearest = (points @ centres.T * 2 - (centres ** 2).sum(axis=1)).argmax(axis=1)
            for k in range(len(centres)):
                if (nearest == k).any():
                    centres[k] = np.average(points[nearest == k], axis=0, weights=weights[nearest == k])
        sure = counts[frequent[alone:]] >= 3
        classes[frequent[alone:][sure]] = alone + nearest[sure]
    return classes


def symbols_of(frequent: np.ndarray) -> np.ndarray:
    """The row of every id: its own, or the one that all others share."""
    symbols = np.full(IDS, FREQUENT)
    symbols[frequent] = np.arange(len(frequent))
    return symbols


# Attention -----------------------------------------------------------------------------------------

def windows(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids of each window, which of its last STEP are scored, number of the sequence). Every id of every sequence is
    scored in exactly one window; before a sequence stand PAST ends."""
    counts = np.array([-(-len(s) // STEP) for s in sequences])
    padded = [x for s, n in zip(sequences, counts) for x in (np.full(PAST, END_ID), s, np.full(n * STEP - len(s), END_ID))]
    starts = np.cumsum(counts * STEP + PAST) - (counts * STEP + PAST)
    owner = np.repeat(np.arange(len(sequences)), counts)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = starts[owner] + number * STEP
    ids = np.lib.stride_tricks.sliding_window_view(np.concatenate(padded), PAST + STEP)[at]
    left = np.array([len(s) for s in sequences])[owner] - number * STEP
    return ids, np.arange(STEP) < left[:, None], owner


SEEN = PAST + STEP - 1
MASK = np.where(np.arange(SEEN)[:, None] <= np.arange(STEP) + PAST - 1, 0, -1e9).astype(np.float32)


def _turned(x: np.ndarray) -> np.ndarray:
    """Each window's matrix, transposed; products of small matrices are quicker that way round."""
    return np.ascontiguousarray(x.transpose(0, 2, 1))


def attend(p: dict[str, np.ndarray], symbols: np.ndarray) -> tuple[np.ndarray, ...]:
    """Logits over classes of the last STEP ids of each window, and what the way back needs. One head: the row of the
    id before asks, all ids up to it answer. Weights stand by answering, then asking id, and aren't divided by their sums."""
    past = symbols[:, :-1]
    asking = past[:, PAST - 1:]
    q, k, v = p["query"].take(asking, axis=0), p["key"].take(past, axis=0), p["value"].take(past, axis=0)
    q += p["query_at"]
    k += p["key_at"]
    v += p["value_at"]
    weights = k @ _turned(q)
    weights += MASK
    np.exp(np.minimum(weights, 60, out=weights), out=weights)
    sums = (np.ones((1, SEEN), np.float32) @ weights).transpose(0, 2, 1)
    mixed = weights.transpose(0, 2, 1) @ v
    mixed /= sums
    logits = p["bigram"].take(asking.ravel(), axis=0)
    logits += mixed.reshape(-1, DIM) @ p["out"]
    return logits, q, k, v, weights, sums, mixed


def class_logs(p: dict[str, np.ndarray], ids: np.ndarray) -> np.ndarray:
    """Natural logarithm of the probability of the class of the last STEP ids of each window."""
    found = np.empty((len(ids), STEP), np.float32)
    for at in range(0, len(ids), TILE):
        some = ids[at:at + TILE]
        logits = attend(p, p["symbols"].take(some))[0]
        known = logits.ravel().take(np.arange(0, logits.size, CLASSES) + p["classes"].take(some[:, PAST:]).ravel())
        np.exp(np.minimum(logits, 60, out=logits), out=logits)
        known -= np.log(logits @ np.ones(CLASSES, np.float32))
        found[at:at + TILE] = known.reshape(-1, STEP)
    return found


def shares(p: dict[str, np.ndarray], before: np.ndarray, target: np.ndarray, pairs: np.ndarray | None = None) -> np.ndarray:
    """Natural logarithm of an id's share of its class after the id before, by the rows; where it is told how many such pairs
    the corpus has, by these, and what the rows say counts as KEPT pairs."""
    found = p["within"][p["symbols"][before], p["symbols"][target]] + p["rare"][target]
    return found if pairs is None else np.log((pairs + KEPT * np.exp(found)) / (p["follow"][before, p["classes"][target]] + KEPT))


def log_likelihood(p: dict[str, np.ndarray], ids: np.ndarray, counted: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Natural logarithm of the probability of the last STEP ids of each window. `counted`: sorted keys of pairs and how
    often the corpus has each."""
    before, target, pairs = ids[:, PAST - 1:-1], ids[:, PAST:], None
    if counted is not None:
        keys, n = counted
        wanted = pair_keys(before, target)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        pairs = np.where(keys[at] == wanted, n[at], 0)
    return class_logs(p, ids) + shares(p, before, target, pairs)


def _row_sums(rows: np.ndarray, change: np.ndarray, to: np.ndarray) -> None:
    """Sets each row of `to` to the sum of the columns of `change` that `rows` gives it. Dimension by dimension, as then the
    sums stay in a core's cache."""
    rows = rows.ravel()
    for d, values in enumerate(change.reshape(len(change), -1)):
        to[:, d] = np.bincount(rows, values, len(to))


class Trainer:
    """Adam on the cross-entropy of the classes; the bigram rows are counts of the corpus and stay. `p` has the weights."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.weights = np.concatenate([p[n].ravel() for n in TRAINED]).astype(np.float32)
        self.p = {**p, **self._parts(self.weights, p)}
        self.slope = np.zeros_like(self.weights)
        self.slopes = self._parts(self.slope, p)
        self.first, self.second, self.part, self.whole = (np.zeros_like(self.weights) for _ in range(4))
        self.steps = 0

    @staticmethod
    def _parts(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        ends = np.cumsum([like[n].size for n in TRAINED])
        return {n: part.reshape(like[n].shape) for n, part in zip(TRAINED, np.split(flat, ends[:-1]))}

    def step(self, ids: np.ndarray, scored: np.ndarray) -> None:
        p, slopes, size = self.p, self.slopes, len(ids)
        symbols, target = p["symbols"].take(ids), p["classes"].take(ids[:, PAST:])
        shares = (scored / np.float32(max(1, scored.sum()))).astype(np.float32)
        to_q, to_k, to_v = (np.empty((DIM, size, n), np.float32) for n in (STEP, SEEN, SEEN))
        self.slope[:] = 0
        for at in range(0, size, TILE):
            tile = slice(at, at + TILE)
            logits, q, k, v, weights, sums, mixed = attend(p, symbols[tile])
            share = shares[tile].reshape(-1, 1)
            slope = np.exp(np.minimum(logits, 60, out=logits), out=logits)
            slope *= share / (slope @ np.ones((CLASSES, 1), np.float32))
            slope.ravel()[np.arange(0, slope.size, CLASSES) + target[tile].ravel()] -= share.ravel()
            slopes["out"] += (slope.T @ mixed.reshape(-1, DIM)).T
            to_mixed = (slope @ p["out"].T).reshape(mixed.shape)
            to_mixed /= sums
            to_weights = v @ _turned(to_mixed)
            to_weights -= ((to_mixed * mixed) @ np.ones((DIM, 1), np.float32)).transpose(0, 2, 1)
            to_weights *= weights
            np.matmul(k.transpose(0, 2, 1), to_weights, out=to_q[:, tile].transpose(1, 0, 2))
            np.matmul(q.transpose(0, 2, 1), to_weights.transpose(0, 2, 1), out=to_k[:, tile].transpose(1, 0, 2))
            np.matmul(to_mixed.transpose(0, 2, 1), weights.transpose(0, 2, 1), out=to_v[:, tile].transpose(1, 0, 2))
        past = symbols[:, :-1]
        for name, rows, change in (("query", past[:, PAST - 1:], to_q), ("key", past, to_k), ("value", past, to_v)):
            _row_sums(rows, change, slopes[name])
            slopes[f"{name}_at"][:] = (np.ones(size, np.float32) @ change).T
        self.steps += 1
        rate, part, whole = RATE / (1 - 0.9 ** self.steps), self.part, self.whole      # in place, as new arrays take longer
        np.multiply(np.subtract(self.slope, self.first, out=part), 0.1, out=part)
        self.first += part
        np.subtract(np.multiply(self.slope, self.slope, out=part), self.second, out=part)
        self.second += np.multiply(part, 0.001, out=part)
        np.sqrt(np.divide(self.second, np.float32(1 - 0.999 ** self.steps), out=part), out=part)
        part += 1e-8
        self.weights -= np.divide(np.multiply(self.first, rate, out=whole), part, out=whole)

    def over(self, sequences: list[np.ndarray], rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
        """Steps over every window once, in a random order. Returns the windows and what is scored in them."""
        ids, scored, _ = windows(sequences)
        order = rng.permutation(len(ids))
        for at in range(0, len(order), WINDOWS):
            self.step(ids[order[at:at + WINDOWS]], scored[order[at:at + WINDOWS]])
        return ids, scored


def train(p: dict[str, np.ndarray], sequences: list[np.ndarray], seed: int = 0) -> None:
    """TRAIN_STEPS steps on windows drawn from the sequences."""
    ids, scored, _ = windows(sequences)
    rng, trainer = np.random.default_rng(seed), Trainer(p)
    for _ in range(TRAIN_STEPS):
        batch = rng.integers(0, len(ids), TRAIN_WINDOWS)
        trainer.step(ids[batch], scored[batch])
    p.update({n: trainer.p[n] for n in TRAINED})


# Corpus counts and the model -----------------------------------------------------------------------

def _tally(pairs: DataFrame, size: int, key) -> np.ndarray:
    """How often the learned texts have each key, below `size`, that `key` makes of the ids before and the ids of pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            pair, n = (unpacked(batch.column(c), "<i8")[0] for c in ("pairs", "n"))
            pair, n = pair[n > 0], n[n > 0]
            np.add.at(counts, key(pair >> 16, pair & 0xffff), n)
        at = np.flatnonzero(counts)
        for a in range(0, len(at), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(at[a:a + 50_000]), pa.array(counts[at[a:a + 50_000]])], ["key", "n"])

    found = pairs.mapInArrow(run, "key long, n long").groupBy("key").agg(
        F.sum("n").alias("n")).toPandas()              # of a size that the constants bound, whatever the corpus
    counts = np.zeros(size, np.int64)
    counts[found.key.to_numpy(np.int64)] = found.n.to_numpy(np.int64)
    return counts


def _round(texts: DataFrame, model: dict, seed: int) -> None:
    """Trains on every window of every text of `texts`, given by its `ids`: each task on those of its partition, from the weights
    of `model`, which then become the tasks' average, by windows. A task with few texts goes over them again."""
    context = texts.sparkSession.sparkContext
    shared = context.broadcast({n: model[n] for n in ("classes", "symbols", "bigram", *TRAINED)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(shared.value)
        rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
        held: list[np.ndarray] = []
        size = learned_from = 0

        for batch in batches:
            for ids in map(lambda x: np.frombuffer(x.as_buffer(), "<u2"), batch.column("ids")):
                if held and size >= SAMPLE_CHARS:
                    learned_from += len(trainer.over(held, rng)[0])
                    held, size = [], 0
                held.append(ids)
                size += len(ids)
        if held:
            all_held = not learned_from
            ids, scored = trainer.over(held, rng)
            learned_from += len(ids)
            while all_held and trainer.steps < TRAIN_STEPS // ROUNDS:
                batch = rng.integers(0, len(ids), TRAIN_WINDOWS)
                trainer.step(ids[batch], scored[batch])
            whole = np.rint(trainer.weights.astype(np.float64) * FIXED).astype(np.int64) * learned_from
            parts = np.split(whole, np.arange(BLOCK, len(whole), BLOCK))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(len(parts), dtype=np.int32)), pa.array(np.full(len(parts), learned_from, np.int64)),
                pa.array([x.tobytes() for x in parts], pa.binary())], ["block", "n", "weights"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for block, n, weights in zip(*(batch.column(c).to_pylist() for c in ("block", "n", "weights"))):
                own = sums.setdefault(block, [0, 0])
                own[0] += n
                own[1] = own[1] + np.frombuffer(weights, np.int64)
        yield pa.RecordBatch.from_arrays([
            pa.array(list(sums), pa.int32()), pa.array([n for n, _ in sums.values()], pa.int64()),
            pa.array([x.tobytes() for _, x in sums.values()], pa.binary())], ["block", "n", "weights"])

    kind = "block int, n long, weights binary"
    rows = sorted(texts.mapInArrow(run, kind).repartition("block").mapInArrow(add, kind).collect())   # as many as the weights fill
    if rows:
        flat = np.concatenate([np.frombuffer(r.weights, np.int64) / (r.n * FIXED) for r in rows]).astype(np.float32)
        model.update(Trainer._parts(flat, model))


def learn(docs: DataFrame, tokenizer: str, seed: int = 0, chunks: DataFrame | None = None) -> dict:
    """The model, a dict of arrays. p(id | ids before) = p(class | ids before) p(id | class, id before), and a word's probability
    is OWN_SHARE of that of its ids, the rest that of the word among all words of the corpus.

    `docs` has doc_id, text and learn; `chunks` is their table, if it is there. Rows of ids, classes, counts and attention
    weights all come from all texts that may be learned: counts by sums over the chunks' pairs of ids, weights in ROUNDS
    passes, each over a part of the texts, in which each window is learned from where it lies and the tasks' weights are averaged.
    Counts of words and of pairs of ids grow with the corpus and are no part of the model: `scored` joins them. Without
    any text, ids are equally likely.
    """
    chunks = written(_chunks(docs, tokenizer), "numbered-chunks", "kind") if chunks is None else chunks
    learned_pairs = chunks.where("kind = 2").select("pairs", "n")
    rows = FREQUENT + 1
    ids = _tally(learned_pairs, IDS, lambda before, ids: ids)
    frequent = frequent_ids(ids)
    symbols = symbols_of(frequent)
    pairs = _tally(learned_pairs, rows * rows, lambda before, ids: symbols[before] * rows + symbols[ids]).reshape(rows, rows)
    classes = make_classes(ids, frequent, pairs, seed)
    follow = _tally(learned_pairs, IDS * CLASSES, lambda before, ids: before * CLASSES + classes[ids]).reshape(IDS, CLASSES)

    row_class = np.full(rows, CLASSES - 1)
    row_class[:len(frequent)] = classes[frequent]
    row_ids = np.bincount(symbols, ids + 0.1, minlength=rows)           # rows of no id stay at nothing
    class_ids = np.bincount(row_class, row_ids, minlength=CLASSES)
    rare = np.where(symbols == FREQUENT, np.log((ids + 0.1) / max(row_ids[FREQUENT], 0.1)), 0)
    in_class = row_ids / class_ids[row_class]
    after = np.stack([np.bincount(row_class, row, minlength=CLASSES) for row in pairs])
    within = np.log(np.maximum((pairs + KEPT * in_class) / (after[:, row_class] + KEPT), 1e-30))
    overall = np.maximum(class_ids / class_ids.sum(), 1e-12)
    bigram = np.log((after + KEPT * overall) / (after.sum(axis=1, keepdims=True) + KEPT))
    rng = np.random.default_rng(seed)
    draw = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
    model = {
        "classes": classes.astype(np.int64), "symbols": symbols.astype(np.int64), "rare": rare.astype(np.float32),
        "within": within.astype(np.float32), "bigram": bigram.astype(np.float32), "follow": follow.astype(np.float32),
        "query": draw(rows, DIM), "key": draw(rows, DIM), "value": draw(rows, DIM),
        "query_at": draw(STEP, DIM), "key_at": draw(PAST + STEP - 1, DIM), "value_at": draw(PAST + STEP - 1, DIM),
        "out": np.zeros((DIM, CLASSES), np.float32)}
    for number in range(ROUNDS):
        _round(chunks.where(F.expr("kind = 1 AND NOT held_out") & (F.col("part") == number)).select("ids"), model, seed + number)
    return model


class Known:
    """What the corpus says of the words and pairs of ids of some texts: `numbers` of the words, their ids (`flat`, of which each
    word has as many as `sizes` says), how often each is learned (`c`), and `counts` of all pairs, by `keys`."""

    def __init__(self, model: dict, train_tokens: int, numbers: np.ndarray, flat: np.ndarray, sizes: np.ndarray, c: np.ndarray,
                 keys: np.ndarray, counts: np.ndarray):
        order, sizes = np.argsort(keys), sizes.astype(np.int64)
        self.model, self.keys = model, keys[order]
        self.pair_logs = shares(model, self.keys >> 16, self.keys & 0xffff, counts[order])
        starts = np.cumsum(sizes) - sizes
        inside = np.ones(len(flat), bool)
        inside[starts] = False
        logs = np.zeros(len(flat))
        logs[inside] = self.shares(flat[:-1][inside[1:]], flat[inside])
        place = np.argsort(numbers)
        self.c, self.flat, self.starts, self.sizes = c[place], flat, starts[place], sizes[place]
        self.inside = np.add.reduceat(logs, starts)[place]              # of each word's ids but the first
        self.first, self.last = flat[self.starts], flat[self.starts + self.sizes - 1]
        self.alone = np.where(self.c > 0, np.log(np.maximum(self.c, 1) / max(train_tokens, 1)), NEVER)
        self.alone[0] = NEVER                                           # the end is an id only

    def shares(self, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return self.pair_logs[np.searchsorted(self.keys, pair_keys(before, ids))]

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        """log10 of the probability of each text, given as the numbers of its words and the end. What the pairs within a word
        say is looked up with the word; only that of its first id and the id before depends on the place."""
        whole = np.concatenate(texts)
        ids, lengths = spelled(self.flat, self.starts, self.sizes, whole)
        firsts = np.cumsum(lengths) - lengths
        sizes = np.array(list(map(len, texts)))
        heads = np.cumsum(sizes) - sizes
        ids, scored, _ = windows(np.split(ids, firsts[heads[1:]]))
        by_word = np.add.reduceat(class_logs(self.model, ids)[scored].astype(np.float64), firsts) + self.inside[whole]
        by_word += self.shares(self.last[np.roll(whole, 1)], self.first[whole])     # an end stands before each text
        both = np.logaddexp(by_word + np.log(OWN_SHARE), self.alone[whole] + np.log(1 - OWN_SHARE))
        return np.add.reduceat(both, heads) / np.log(10)


# Scoring -------------------------------------------------------------------------------------------

def _buckets(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order of the keys by bucket, buckets, where each ends)"""
    bucket = (keys * 0x9E3779B1 >> 20) % BUCKETS
    found, n = np.unique(bucket, return_counts=True)
    return np.argsort(bucket, kind="stable"), found, np.cumsum(n)


class _Chunk:
    """The words and pairs of ids of some consecutive texts."""

    def __init__(self, name: str, encoder: WordEncoder):
        self.name, self.numbered, self.words = name, Numbered(encoder), 0
        self.held: list[pa.RecordBatch] = []

    def add(self, part: pa.RecordBatch) -> None:
        self.words += int(self.numbered.add(part.column("text")).sum())
        self.held.append(part.select(["doc_id", "learn", "part"]))

    def rows(self) -> Iterator[pa.RecordBatch]:
        numbers, lengths = self.numbered.close()
        learned = np.zeros(len(self.numbered.sizes), np.int64)
        pairs: tuple[list, list] = [], []                                   # keys; how often learned
        ends = np.cumsum(lengths)
        row = 0
        for part in self.held:
            last, n = row + part.num_rows, part.num_rows
            own, to = numbers[ends[row] - lengths[row]:ends[last - 1]], np.cumsum(lengths[row:last])
            ids, each = self.numbered.ids(own)
            learn = part.column("learn").to_numpy(zero_copy_only=False)
            use = np.repeat(learn, lengths[row:last])
            learned += np.bincount(own[use], minlength=len(learned))
            keys, use = pair_keys(np.roll(ids, 1), ids).astype(np.uint32), np.repeat(use, each)     # an end stands before each text
            for some, counts in ((keys[~use], 0), (keys[use], 1)):
                found, times = np.unique(some, return_counts=True)
                pairs[0].append(found)
                pairs[1].append(times * counts)
            yield _rows(n, chunk=[self.name] * n, kind=np.ones(n, np.int32), doc_id=part.column("doc_id"), held_out=~learn, part=part.column("part"),
                        numbers=packed(own.astype("<u4"), to), ids=packed(ids, np.cumsum(each)[to - 1]))
            row = last

        order, buckets, ends = _buckets(np.add.reduceat(self.numbered.flat, self.numbered.starts, dtype=np.int64))
        ids, each = self.numbered.ids(order)
        yield _rows(len(ends), chunk=[self.name] * len(ends), kind=np.zeros(len(ends), np.int32), bucket=buckets.astype(np.int32),
                    numbers=packed(order.astype("<u4"), ends), ids=packed(ids, np.cumsum(each)[ends - 1]),
                    sizes=packed(each.astype("<u4"), ends), n=packed(learned[order], ends))
        keys, place = np.unique(np.concatenate(pairs[0]), return_inverse=True)
        times = np.bincount(place, np.concatenate(pairs[1]), len(keys)).astype(np.int64)
        keys = keys.astype(np.int64)
        order, buckets, ends = _buckets(keys)
        yield _rows(len(ends), chunk=[self.name] * len(ends), kind=np.full(len(ends), 2, np.int32), bucket=buckets.astype(np.int32),
                    pairs=packed(keys[order], ends), n=packed(times[order], ends))


FIELDS = {"chunk": pa.string(), "kind": pa.int32(), "bucket": pa.int32(), "numbers": pa.binary(), "ids": pa.binary(), "sizes": pa.binary(),
          "pairs": pa.binary(), "n": pa.binary(), "doc_id": pa.int64(), "held_out": pa.bool_(), "part": pa.int64()}


def _rows(size: int, **columns) -> pa.RecordBatch:
    arrays = [pa.array(columns[name], kind) if name in columns else pa.nulls(size, kind) for name, kind in FIELDS.items()]
    return pa.RecordBatch.from_arrays(arrays, list(FIELDS))


def _chunks(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Rows of kind 0: a bucket of the distinct words of a chunk of texts, numbered, with their ids and learned occurrences. Of kind
    1: its texts, with the numbers of their words and their ids. Of kind 2: a bucket of its distinct pairs of ids with their learned
    occurrences. `part`: the round in which a text teaches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(tokenizer)
        task, made = TaskContext.get().partitionId(), 0
        chunk = _Chunk(f"{task}-{made}", encoder)
        for part in arrow_pieces(batches, "text", CHUNK_WORDS):
            chunk.add(part)
            if chunk.words >= CHUNK_WORDS:
                yield from chunk.rows()
                made += 1
                chunk = _Chunk(f"{task}-{made}", encoder)
        if chunk.words:
            yield from chunk.rows()

    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS)).alias("part")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "learn", part).mapInArrow(
        run, "chunk string, kind int, bucket int, numbers binary, ids binary, sizes binary, pairs binary, n binary, doc_id long, held_out boolean, part long")


def _word_counts(bucket: pa.Table) -> pa.Table:
    """`c`: the corpus's learned occurrences of each word of each chunk; `n` and `v`: in one row, those of all words, and how many
    words have any. Words are known by their ids."""
    sizes, rows = unpacked(bucket["sizes"], "<u4")
    words = packed(unpacked(bucket["ids"], "<u2")[0], np.cumsum(sizes, dtype=np.int64)).dictionary_encode().indices.to_numpy()
    c = np.bincount(words, unpacked(bucket["n"], "<i8")[0]).astype(np.int64)
    others = [0] * (len(rows) - 1)
    return pa.table({"chunk": bucket["chunk"], "bucket": bucket["bucket"], "c": packed(c[words], np.cumsum(rows)),
                     "n": [int(c.sum()), *others], "v": [int(np.count_nonzero(c)), *others]})


def _pair_counts(bucket: pa.Table) -> pa.Table:
    """`c`: the corpus's learned occurrences of each pair of ids of each chunk."""
    keys, rows = unpacked(bucket["pairs"], "<i8")
    found, pairs = np.unique(keys, return_inverse=True)
    c = np.bincount(pairs, unpacked(bucket["n"], "<i8")[0]).astype(np.int64)
    return pa.table({"chunk": bucket["chunk"], "bucket": bucket["bucket"], "pairs": bucket["pairs"], "c": packed(c[pairs], np.cumsum(rows))})


def scored(docs: DataFrame, tokenizer: str, seed: int = 0) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of `docs`.

    A text's tokens are its words, A-Z lower-cased, and one end; null text is empty, so it has the end alone. `score` is the
    model's log10 probability of the words' subword ids and the end, `base_score` that of the tokens by add-one smoothed
    counts. Both learn from the rows that `learned` names. Repeated rows count, and are scored, each. Other columns are
    ignored. No rows: no rows.

    A chunk of texts sends each of its distinct words and pairs of ids once, in buckets; there they meet those of all chunks, the
    counts of the whole corpus come back, and the chunk's texts are scored.
    """
    docs = learned(docs.select("doc_id", "text"))
    chunks = written(_chunks(docs, tokenizer), "numbered-chunks", "kind")
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, tokenizer, seed, chunks))    # of a size that the constants fix
    words = written(chunks.where("kind = 0").select("chunk", "bucket", "ids", "sizes", "n").groupBy("bucket").applyInArrow(
        _word_counts, "chunk string, bucket int, c binary, n long, v long"), "word-counts")
    pairs = chunks.where("kind = 2").select("chunk", "bucket", "pairs", "n").groupBy("bucket").applyInArrow(
        _pair_counts, "chunk string, bucket int, pairs binary, c binary")
    totals = words.agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    train_tokens = totals.n or 0
    usual = float(np.log10(train_tokens + (totals.v or 0) + 1))
    columns = {"bucket": "int", "numbers": "binary", "ids": "binary", "sizes": "binary", "c": "binary", "pairs": "binary", "doc_id": "long",
               "held_out": "boolean"}
    parts = [(chunks.where("kind = 0"), ["bucket", "numbers", "ids", "sizes"]), (words, ["bucket", "c"]), (pairs, ["bucket", "pairs", "c"]),
             (chunks.where("kind = 1"), ["numbers", "doc_id", "held_out"])]
    spellings, counts, pairs, texts = (df.select("chunk", F.lit(k).alias("kind"), *[
        F.col(name) if name in own else F.lit(None).cast(kind).alias(name) for name, kind in columns.items()]) for k, (df, own) in enumerate(parts))
    met = spellings.union(counts).union(pairs).union(texts).repartition("chunk").sortWithinPartitions("chunk", "kind", "bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, known = None, None
        for batch in batches:
            labels = np.array(batch.column("chunk").to_pylist(), object)
            kinds = batch.column("kind").to_numpy()
            cuts = [0, *(np.flatnonzero((labels[1:] != labels[:-1]) | (kinds[1:] != kinds[:-1])) + 1), len(labels)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if labels[a] != name:
                    name, known = labels[a], None
                    found: dict[tuple[int, str], list[np.ndarray]] = {}
                if kinds[a] < 3:                                            # spellings; counts of words; pairs and theirs
                    for column, kind in ((("numbers", "<u4"), ("ids", "<u2"), ("sizes", "<u4")), (("c", "<i8"),),
                                         (("pairs", "<i8"), ("c", "<i8")))[kinds[a]]:
                        found.setdefault((kinds[a], column), []).append(unpacked(part.column(column), kind)[0])
                    continue
                if known is None:
                    known = Known(shared.value, train_tokens, *(np.concatenate(found.pop(x)) for x in (
                        (0, "numbers"), (0, "ids"), (0, "sizes"), (1, "c"), (2, "pairs"), (2, "c"))))
                for at in range(0, part.num_rows, 100):
                    some = part.slice(at, 100)
                    numbers = [np.frombuffer(x, "<u4").astype(np.int64) for x in some.column("numbers").to_pylist()]
                    rows = [known.c[x] for x in numbers]
                    yield pa.RecordBatch.from_arrays([
                        some.column("doc_id"), some.column("held_out"), pa.array([len(c) for c in rows], pa.int64()),
                        pa.array([int(np.count_nonzero(c)) for c in rows], pa.int64()), pa.array([train_tokens] * len(rows), pa.int64()),
                        pa.array([float(np.log10(c + 1).sum()) - len(c) * usual for c in rows]), pa.array(known.scores(numbers))],
                        ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return met.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                               "base_score double, score double")
