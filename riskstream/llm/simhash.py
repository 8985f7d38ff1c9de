"""SimHash fingerprints and their near copies by pigeonring filtering."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from riskstream.llm.common import arrow_pieces, as_row, from_row, give_back, utf8, words_of, written
from riskstream.llm.graph import components

BITS = 64
BLOCK = 1 << 15                     # hashes summed at once
BUCKET = 20_000                     # fingerprints of a bucket that one task compares


def fingerprint(text: bytes, width: int = 4, seed: int = 42) -> int:
    """Bit k is set if more than half of the shingles' XXH64 have it. No word: 0. Fewer words than
    `width`: one shingle of them all."""
    words = words_of(text)
    if not words:
        return 0
    width = min(width, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - width + 1].tolist()
    ends = ends[width - 1:].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, len(starts), BLOCK):
        spans = zip(starts[at:at + BLOCK], ends[at:at + BLOCK])
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(counts * 2 > len(starts), bitorder="little")
    return int(packed.view("<i8")[0])


def with_fingerprint(docs: DataFrame, width: int = 4, seed: int = 42, others: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, *others, fp): the fingerprint of each row's whole text as a signed long; null text is empty."""
    kept = ["doc_id", *others]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_pieces(batches, "text"):
            values = [fingerprint(text, width, seed) for text in utf8(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in kept), pa.array(values, pa.int64())], [*kept, "fp"])
        give_back()

    types = ", ".join(f"{name} {docs.schema[name].dataType.simpleString()}" for name in kept)
    return docs.select(*kept, "text").mapInArrow(run, f"{types}, fp long")


# Pigeonring. Cut the ring of bits into m = most + 1 segments. If two fingerprints differ in `most`
# bits or fewer, there is a segment from which every chain of l segments has at most l * most / m
# differences: the first segment none, and the two after it together at most a few. Cut into one
# part more than those few, one part is equal as well; with the first segment it is the key of an
# equality join. What the join finds must keep the budgets of all longer chains.

def _segments(most: int) -> list[tuple[int, int]]:
    """(first bit, number of bits) of each segment."""
    m = most + 1
    cuts = [BITS * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _budget(length: int, most: int) -> int:
    return length * most // (most + 1)


def _layout(most: int) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """Of each start: the rotation that puts its segment lowest, the segment's width, and the place
    and width of the parts of what follows."""
    segments = _segments(most)
    layout = []
    for i, (first, width) in enumerate(segments):
        chain = [segments[(i + k) % len(segments)][1] for k in (1, 2)] if most > 1 else [BITS - width]
        parts = _budget(3, most) + 1 if most > 1 else 1
        cuts = [width + sum(chain) * k // parts for k in range(parts + 1)]
        layout.append((first, width, [(a, b - a) for a, b in zip(cuts, cuts[1:])]))
    return layout


def ring_keys(fp: Column, most: int) -> Column:
    """The keys of a fingerprint, an array of longs; the number of its table is in the high bits."""
    keys = []
    for first, width, parts in _layout(most):
        turned = F.shiftrightunsigned(fp, first).bitwiseOR(F.shiftleft(fp, BITS - first)) if first else fp
        head = turned.bitwiseAND(F.lit((1 << width) - 1))
        for at, bits in parts:
            part = F.shiftrightunsigned(turned, at).bitwiseAND(F.lit((1 << bits) - 1))
            keys.append(F.lit(len(keys) << 48).bitwiseOR(F.shiftleft(head, 24)).bitwiseOR(part))
    return F.array(*keys)


def _within_ring(x: np.ndarray, start: int, most: int) -> np.ndarray:
    """Which differences `x` keep the budget of every chain from this start; the longest is the whole ring."""
    segments, total, kept = _segments(most), np.zeros(x.shape, np.int64), np.ones(x.shape, bool)
    for k in range(len(segments)):
        first, width = segments[(start + k) % len(segments)]
        total = total + np.bitwise_count((x >> np.uint64(first)) & np.uint64((1 << width) - 1))
        kept &= total <= _budget(k + 1, most)
    return kept


def _forest(fps: np.ndarray, start: int, most: int) -> list[tuple[int, int]]:
    """Edges that join what is linked within a bucket: a spanning forest, never all pairs."""
    edges, left = [], fps
    while len(left):
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            at = frontier.pop()
            near = _within_ring(left ^ at, start, most)
            found, left = left[near], left[~near]
            edges += [(at, other) for other in found]
            frontier += list(found)
    return edges


def _bucket_edges(most: int):
    tables = [start for start, (_, _, parts) in enumerate(_layout(most)) for _ in parts]

    def links(keys: np.ndarray, blocks: np.ndarray, fps: np.ndarray) -> list[tuple[int, int]]:
        cuts = np.flatnonzero((np.diff(keys) != 0) | (np.diff(blocks) != 0)) + 1
        starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(keys)]))
        sizes, edges = ends - starts, []
        pairs = starts[sizes == 2]                       # most buckets with company have two
        which = np.array([tables[k >> 48] for k in keys[pairs]], np.int64)
        for start in np.unique(which):
            a, b = fps[pairs[which == start]], fps[pairs[which == start] + 1]
            near = _within_ring(a ^ b, start, most)
            edges += zip(a[near], b[near])
        for s, e in zip(starts[sizes > 2], ends[sizes > 2]):
            edges += _forest(fps[s:e], tables[keys[s] >> 48], most)
        return edges

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None             # the bucket at the end of what came so far
        for batch in batches:
            now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            now = now if held is None else [np.concatenate(x) for x in zip(held, now)]
            if not len(now[0]):
                continue
            last = (now[0] == now[0][-1]) & (now[1] == now[1][-1])
            cut = int(np.argmax(last))
            held = [x[cut:] for x in now]
            if cut:
                yield _edge_batch(links(now[0][:cut], now[1][:cut], now[2][:cut].view(np.uint64)))
        if held is not None and len(held[0]):
            yield _edge_batch(links(held[0], held[1], held[2].view(np.uint64)))
        held = None
        give_back()

    return run


def _edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    ends = np.array(edges, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])


def near_edges(fps: DataFrame, most: int = 4, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) between different values of the long column `fp` whose transitive closure is that of
    "at most `most` bits differ".

    Buckets of equal keys are compared inside one task, and only a spanning forest of a bucket leaves
    it. A bucket of more than `bucket` fingerprints is cut into blocks and each pair of blocks is a
    bucket of its own, so no task holds more than two blocks and no link is lost.
    """
    keys = fps.select("fp", F.explode(ring_keys(F.col("fp"), most)).alias("key"))
    large = written(keys.groupBy("key").count().where(F.col("count") > bucket), "large-buckets")
    n = F.ceil(F.col("count") / bucket).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit(1)), n).cast("int")
    pair = F.transform(F.sequence(F.lit(0), n - 1), lambda other: F.least(own, other) * n + F.greatest(own, other))
    blocks = F.when(F.col("count").isNull(), F.array(F.lit(0))).otherwise(pair)
    rows = keys.join(large, "key", "left").select("key", F.explode(blocks).alias("block"), "fp")
    rows = rows.repartition("key", "block").sortWithinPartitions("key", "block", "fp")
    return rows.mapInArrow(_bucket_edges(most), "a long, b long").distinct()


def near_components(docs: DataFrame, most: int = 4, width: int = 4) -> DataFrame:
    """(doc_id, fp, component_id): documents linked, directly or through others, by fingerprints with at
    most `most` (2 to 7) differing bits; component_id is the smallest doc_id among them.

    Null or empty texts and texts without words have fingerprint 0 and are linked like any other. Rows
    that repeat a doc_id are kept, each with its own text's fingerprint. A null doc_id names a component
    only if that holds nothing else. Other columns are ignored. Empty input: no rows.
    """
    return _labelled(written(with_fingerprint(docs, width), "fingerprints"), most).select(
        "doc_id", "fp", "component_id")


def _labelled(rows: DataFrame, most: int) -> DataFrame:
    if not 2 <= most <= 7:
        raise ValueError("`most` must be 2 to 7")
    nodes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "fingerprint-nodes")
    roots = components(near_edges(nodes.select("fp"), most))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "doc_id", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    labels = written(rooted.join(smallest, "root").select("fp", "component_id"), "fingerprint-labels")
    return rows.join(labels, "fp")


def one_of_each(docs: DataFrame, most: int = 4, width: int = 4) -> DataFrame:
    """`docs`, all columns, without the near copies: the row of a component's smallest doc_id stays.

    Rows of one doc_id in a component stay or go together; rows that repeat both doc_id and text are one
    row. A row with a null doc_id stays only if its component has no doc_id at all. Columns of any name pass.
    """
    text = F.xxhash64("text").alias("_text")
    keyed = docs.select(
        as_row(docs), F.col("doc_id").isNull().alias("_no_id"), text,
        F.coalesce("doc_id", F.lit(0).cast(docs.schema["doc_id"].dataType)).alias("_id"))
    keys = ["_no_id", "_id", "_text"]
    rows = written(with_fingerprint(docs.select("doc_id", text, "text"), width, others=("_text",)), "fingerprints")
    kept = _labelled(rows, most).where("doc_id <=> component_id").select(
        F.col("doc_id").isNull().alias("_no_id"),
        F.coalesce("doc_id", F.lit(0).cast(docs.schema["doc_id"].dataType)).alias("_id"), "_text")
    return from_row(keyed.join(kept.distinct(), keys).dropDuplicates(keys), docs)
