"""Language identification by prediction by partial matching over bytes."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from riskstream.llm.common import arrow_pieces, as_row, from_row, give_back, hash_part, utf8

ORDER = 3
SAMPLE_ROWS = 150           # training texts of a language
SAMPLE_CHARS = 20_000       # a longer text isn't learned from
BLOCK = 1 << 20             # bytes scored at once
UNKNOWN = "und"


class ContextTree:
    """One language's byte contexts up to ORDER bytes, with frozen escape statistics.

    In a context that has seen n bytes, d of them distinct, a byte seen c times has probability
    c / (n + d), and all unseen ones together d / (n + d), which the context one byte shorter shares
    out; bytes already ruled out count no more there. Below the empty context, the bytes that are left
    share evenly. So each context's costs are those of a probability distribution over 256 bytes.
    Before a text stand ORDER zero bytes.

    `state` finds the longest known context of three bytes: `pairs` maps the last two to a node and
    `longer` a node and the byte before them to a state. `costs` has the bits of each state and byte.
    """

    def __init__(self, texts: list[bytes]):
        counts: list[dict[bytes, np.ndarray]] = [defaultdict(lambda: np.zeros(256)) for _ in range(ORDER + 1)]
        for text in texts:
            data = np.frombuffer(bytes(ORDER) + text, np.uint8)
            wide = data.astype(np.uint32)
            grams = (wide[:-3] << 24) | (wide[1:-2] << 16) | (wide[2:-1] << 8) | wide[3:]
            for gram, n in zip(*np.unique(grams, return_counts=True)):
                gram = int(gram).to_bytes(4, "big")
                for order in range(ORDER + 1):
                    counts[order][gram[ORDER - order:ORDER]][gram[ORDER]] += n
        rows: list[np.ndarray] = []
        places: dict[bytes, int] = {}
        for order in range(ORDER + 1):
            for context in sorted(counts[order]) if order else [b""]:
                places[context] = len(rows)
                rows.append(self._costs([counts[k].get(context[order - k:]) for k in range(order, -1, -1)]))
        self.costs = np.array(rows, np.float32)
        singles = np.array([places.get(bytes([b]), 0) for b in range(256)], np.int32)
        known = sorted(c for c in places if len(c) == 2)
        self.pairs = np.zeros(1 << 16, np.int32)             # node 0: the pair is unknown
        self.longer = np.zeros((len(known) + 1, 256), np.int32)
        self.single = singles
        for node, pair in enumerate(known, 1):
            self.pairs[pair[0] << 8 | pair[1]] = node
            self.longer[node] = [places.get(bytes([b]) + pair, places[pair]) for b in range(256)]

    @staticmethod
    def _costs(chain: list[np.ndarray | None]) -> np.ndarray:
        share, left = np.zeros(256), np.ones(256, bool)
        weight = 1.0
        for counts in chain:
            if counts is None:
                continue
            seen = np.where(left, counts, 0)
            n, d = seen.sum(), np.count_nonzero(seen)
            if d == 0:
                continue
            share += weight * seen / (n + d)
            weight *= d / (n + d)
            left &= seen == 0
        share[left] += weight / max(1, np.count_nonzero(left))
        return -np.log2(np.maximum(share, 1e-300))


@dataclass
class LanguageModel:
    languages: list[str]
    trees: list[ContextTree]

    def plain(self) -> tuple:
        """Names and arrays only, which any Python can read."""
        return self.languages, [(t.pairs, t.single, t.longer, t.costs) for t in self.trees]


def byte_bits(tree: tuple, data: np.ndarray) -> np.ndarray:
    """Code length of each byte after the first ORDER."""
    pairs, single, longer, costs = tree
    back = [data[ORDER - k:len(data) - k] for k in range(1, ORDER + 1)]
    node = pairs[(back[1].astype(np.int32) << 8) | back[0]]
    state = np.where(node == 0, single[back[0]], longer[node, back[2]])
    return costs[state, data[ORDER:]]


def learning_part(docs: DataFrame) -> DataFrame:
    """Rows whose language may be learned: crc32 of the id as text modulo 4 is not 2; a null id is learned."""
    return docs.where(F.coalesce(hash_part("doc_id") % 4 != 2, F.lit(True)))


def learn_languages(docs: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> LanguageModel:
    """One tree for each distinct non-null `lang` of rows that may be learned.

    Of each language at most `rows` whole texts of 1 to `chars` characters are read, those with the
    smallest hash of text and id; that bounds the sample. A language that has longer texts only is learned
    from their first `chars` characters. Only the languages' numbers of rows and the sample reach the driver.
    """
    usable = learning_part(docs).where(F.col("lang").isNotNull() & (F.length("text") > 0))
    short = F.length("text") <= chars
    found = usable.groupBy("lang").agg(F.count(F.when(short, 1)), F.count("*")).collect()
    counts = {lang: few or n for lang, few, n in found}
    if not counts:
        return LanguageModel([], [])
    usable = usable.where(short | F.col("lang").isin([lang for lang, few, _ in found if not few]))
    order = F.xxhash64("text", "doc_id")
    # A third of the bound more than needed in the mean, then cut: each task sends few rows.
    least = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, (2 * rows + 50) / n))])
    drawn = usable.where((F.pmod(order, F.lit(1 << 20)) / float(1 << 20)) < least[F.col("lang")])
    sample: dict[str, list[tuple[int, str]]] = defaultdict(list)
    for r in drawn.select("lang", order.alias("at"), F.substring("text", 1, chars).alias("text")).collect():
        sample[r.lang].append((r.at, r.text))
    languages = sorted(sample)
    return LanguageModel(languages, [
        ContextTree([t.encode() for _, t in sorted(sample[lang])[:rows]]) for lang in languages])


def _letters(texts: list[str | None]) -> list[bool]:
    return [bool(t) and (t[0].isalpha() or any(map(str.isalpha, t))) for t in texts]


def _lengths(trees: list[tuple], texts: list[bytes]) -> np.ndarray:
    """Bits of every text (row) in every language (column), in blocks of a bounded number of bytes."""
    total = np.zeros((len(texts), len(trees)))

    def score(rows: list[int], parts: list[bytes]) -> None:
        """Parts carry the ORDER bytes before them, which belong to no part's own sum."""
        data = np.frombuffer(b"".join(parts), np.uint8)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        starts = np.cumsum(sizes) - sizes
        own = np.ones(len(data) - ORDER, bool)
        for k in range(ORDER):
            own[np.maximum(starts[1:] - ORDER + k, 0)] = False
        for j, tree in enumerate(trees):
            np.add.at(total[:, j], rows, np.add.reduceat(np.where(own, byte_bits(tree, data), 0).astype(np.float64), starts))

    rows, parts, held = [], [], 0
    for i, text in enumerate(texts):
        text = bytes(ORDER) + text
        for at in range(0, len(text) - ORDER, BLOCK):
            rows.append(i)
            parts.append(text[at:at + BLOCK + ORDER])
            held += len(parts[-1])
            if held >= BLOCK:
                score(rows, parts)
                rows, parts, held = [], [], 0
    if parts:
        score(rows, parts)
    return total


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """`docs`, all columns, with lang_pred and lang_score.

    lang_pred is the language whose tree codes the whole text in the fewest bits (ties: the first by name), lang_score
    its share if each language had probability 2^-bits: 0 to 1. A text that is null or has no letter,
    or a model without languages: `und` and 0. Only the text is looked at. The new columns stand in place of
    those that `docs` may have of the same names.
    """
    docs = docs.drop("lang_pred", "lang_score")
    shared = docs.sparkSession.sparkContext.broadcast(model.plain())   # bounded by the sample's bounds

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, trees = shared.value
        for batch in arrow_pieces(batches, "text"):
            column = batch.column(batch.schema.names.index("text"))
            spoken = _letters(column.to_pylist())
            predicted, scores = [UNKNOWN] * len(spoken), [0.0] * len(spoken)
            if languages:
                at = [i for i, letters in enumerate(spoken) if letters]
                texts = utf8(column)
                for i, bits in zip(at, _lengths(trees, [texts[i] for i in at])):
                    best = int(np.argmin(bits))
                    predicted[i] = languages[best]
                    scores[i] = float(1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(predicted), pa.array(scores)], ["row", "text", "lang_pred", "lang_score"])
        give_back()

    rows = docs.select(as_row(docs, "text"), "text")
    schema = StructType([*rows.schema.fields, StructField("lang_pred", StringType()), StructField("lang_score", DoubleType())])
    both = docs.withColumns({"lang_pred": F.lit(None), "lang_score": F.lit(None)})
    return from_row(rows.mapInArrow(run, schema), both, text="text", lang_pred="lang_pred", lang_score="lang_score")
