"""Two tokenizers aligned over texts: groups of tokens that cover the same bytes, and an inverted index of linked id pairs."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, functions as F

from riskstream.llm.common import arrow_pieces, kept_in_process, shuffle_partitions, written
from riskstream.llm.subwords import PATTERN

SPACE = "▁"                # stands for a space in pieces of the second vocabulary
MOST_IN_GROUP = 4096            # links of a group that are listed one by one
BLOCK_BITS = 12                 # documents of a block, as a power of two: a whole bitmap has 512 bytes
MOST_LINKS = 2_000_000          # linked pairs of documents that a task turns into postings at once
POSTING = "pair long, block long, plane int, bits binary"


class Aligner:
    """Tokenizes texts both ways and cuts them where tokens of both end. `ranks` is a byte-level vocabulary as base64 tokens and
    ranks, `pieces` a model that puts a space in front of a text."""

    def __init__(self, ranks: str, pieces: str):
        with open(ranks, "rb") as file:
            tokens = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        # Without special tokens: their strings in a text are plain text.
        self.a = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=tokens, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.bytes_a = [token for token, _ in sorted(tokens.items(), key=lambda x: x[1])]
        self.bytes_b = [_piece_bytes(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.lengths_a, self.lengths_b = (np.array([len(x) for x in side], np.int64) for side in (self.bytes_a, self.bytes_b))
        # Each id as it is written: inside a list, and at its end.
        self.written = [f"{i}{end}" for side, last in ((self.bytes_a, "|"), (self.bytes_b, ";")) for i in range(len(side)) for end in (",", last)]

    def groups(self, text: str | None) -> Groups | None:
        """None where there are no tokens: no text, or tokens whose bytes differ from it."""
        if not text:
            return None
        whole = " " + text
        a, b = self.a.encode_ordinary(whole), self.b.encode(text)
        raw = whole.encode()
        if b"".join([self.bytes_a[i] for i in a]) != raw or b"".join([self.bytes_b[i] for i in b]) != raw:
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        return Groups(a, b, *grouped(np.cumsum(self.lengths_a[a]), np.cumsum(self.lengths_b[b])))

    def text_of(self, found: Groups) -> str:
        """`a1,a2|b1;a3|b2,b3`: both sides' ids, group after group."""
        a, b, group_a, group_b = found
        out = np.empty(len(a) + len(b), np.int64)
        # What stands before a token: its own side so far, and the other side's groups so far.
        before_a = np.searchsorted(group_b, group_a)
        before_b = np.searchsorted(group_a, group_b, "right")
        out[np.arange(len(a)) + before_a] = 2 * a + np.append(group_a[1:] != group_a[:-1], True)
        out[np.arange(len(b)) + before_b] = 2 * (len(self.bytes_a) + b) + np.append(group_b[1:] != group_b[:-1], True)
        return "".join([self.written[i] for i in out.tolist()])[:-1]


class Groups(NamedTuple):
    """Ids of both sides, and the number of each token's group."""
    a: np.ndarray
    b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray

    @property
    def sizes(self) -> tuple[np.ndarray, np.ndarray]:
        return np.bincount(self.group_a), np.bincount(self.group_b)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """The different linked pairs (a shifted by 32 bits, and b), and how often each is linked."""
        n_a, n_b = self.sizes
        starts_a, starts_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        large = n_a * n_b > MOST_IN_GROUP
        each = np.where(large[self.group_a], 0, n_b[self.group_a])
        offset = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        pairs = [np.repeat(self.a, each) << 32 | self.b[np.repeat(starts_b[self.group_a], each) + offset]]
        times = [np.ones(len(pairs[0]), np.int64)]
        for g in np.flatnonzero(large):
            (x, m), (y, n) = (np.unique(ids[start:start + size], return_counts=True) for ids, start, size in (
                (self.a, starts_a[g], n_a[g]), (self.b, starts_b[g], n_b[g])))
            pairs.append((x[:, None] << 32 | y).ravel())
            times.append((m[:, None] * n).ravel())
        pair, time = np.concatenate(pairs), np.concatenate(times)
        order = np.argsort(pair, kind="stable")
        pair, time = pair[order], time[order]
        first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
        return pair[first], np.add.reduceat(time, first)


def grouped(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each token the number of offsets before its end at which tokens of both sides end. Both sides end at the same offset."""
    shared_a = ends_b[np.searchsorted(ends_b, ends_a)] == ends_a
    shared_b = ends_a[np.searchsorted(ends_a, ends_b)] == ends_b
    return np.cumsum(shared_a) - shared_a, np.cumsum(shared_b) - shared_b


def _piece_bytes(piece: str) -> bytes:
    if found := re.fullmatch("<0x([0-9A-F]{2})>", piece):
        return bytes([int(found[1], 16)])
    return piece.replace(SPACE, " ").encode()


STATS = ("n_a", "n_b", "n_groups", "n_links")


def aligned(docs: DataFrame, ranks: str, pieces: str) -> DataFrame:
    """(number, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times): the alignment of each whole text of `docs`.

    `number` tells rows apart, repeated ones too, so the result must be written before it is read twice. `pairs` are the different linked ids
    (a shifted by 32 bits, and b), `times` how often the text links them, both little-endian unsigned 64-bit. A null
    or empty text, or one whose tokens' bytes differ from its own, has zeros and an empty digest.
    """
    ids = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = kept_in_process(("aligner", ranks, pieces), lambda: Aligner(ranks, pieces))
        for batch in arrow_pieces(batches, "text"):
            rows = [_row(aligner, text) for text in batch.column("text").to_pylist()]
            if rows:
                kinds = [pa.int64()] * len(STATS) + [pa.string(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("number"), batch.column("doc_id"), *(pa.array(v, k) for v, k in zip(zip(*rows), kinds))],
                    ["number", "doc_id", *STATS, "groups_sha256", "pairs", "times"])

    stats = ", ".join(f"{name} long" for name in STATS)
    numbered = docs.select(F.monotonically_increasing_id().alias("number"), "doc_id", F.col("text").cast("string").alias("text"))
    return numbered.mapInArrow(run, f"number long, doc_id {ids}, {stats}, groups_sha256 string, pairs binary, times binary")


def _row(aligner: Aligner, text: str | None) -> tuple[int, int, int, int, str, bytes, bytes]:
    found = aligner.groups(text)
    if found is None:
        return 0, 0, 0, 0, "", b"", b""
    n_a, n_b = found.sizes
    pairs, times = found.links()
    return (len(found.a), len(found.b), len(n_a), int(n_a @ n_b), hashlib.sha256(aligner.text_of(found).encode()).hexdigest(),
            pairs.astype("<i8").tobytes(), times.astype("<i8").tobytes())


def packed_postings(pair: np.ndarray, block: np.ndarray, plane: np.ndarray, low: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row per (pair, block, plane): the set of places `low` in the block, in the shorter of two forms, places as 16-bit
    numbers or the block's bitmap. Entries must be sorted by all four and differ."""
    size = 1 << BLOCK_BITS
    new = np.flatnonzero(np.concatenate(([True], (pair[1:] != pair[:-1]) | (block[1:] != block[:-1]) | (plane[1:] != plane[:-1])))) if len(pair) else np.zeros(0, np.int64)
    ends = np.append(new[1:], len(pair))
    short = low.astype("<u2")
    step = 100_000
    for at in range(0, len(new), step):
        first, last = new[at:at + step], ends[at:at + step]
        bits = pa.Array.from_buffers(pa.binary(), len(first), [
            None, pa.py_buffer((np.append(first, last[-1:]) - first[0]).astype(np.int32) * 2), pa.py_buffer(short[first[0]:last[-1]].tobytes())])
        dense = (last - first) * 2 >= size // 8
        if dense.any():
            shapes = []
            for a, b in zip(first[dense], last[dense]):
                flags = np.zeros(size, np.uint8)
                flags[low[a:b]] = 1
                shapes.append(np.packbits(flags, bitorder="little").tobytes())
            bits = pc.replace_with_mask(bits, pa.array(dense), pa.array(shapes, pa.binary()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(pair[first]), pa.array(block[first]), pa.array(plane[first].astype(np.int32)), bits], ["pair", "block", "plane", "bits"])


def unpacked(bits: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, low) of every place in every set."""
    size = 1 << BLOCK_BITS
    lengths = pc.binary_length(bits).to_numpy(zero_copy_only=False)
    dense = lengths == size // 8
    few = bits.filter(pa.array(~dense))
    rows, lows = [np.repeat(np.flatnonzero(~dense), lengths[~dense] // 2)], [np.frombuffer(b"".join(few.to_pylist()), "<u2").astype(np.int64)]
    if dense.any():
        flags = np.unpackbits(np.frombuffer(b"".join(bits.filter(pa.array(dense)).to_pylist()), np.uint8).reshape(-1, size // 8), axis=1, bitorder="little")
        at, places = np.nonzero(flags)
        rows.append(np.flatnonzero(dense)[at])
        lows.append(places)
    return np.concatenate(rows), np.concatenate(lows)


def _column(batch: pa.RecordBatch | pa.Table, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False) if isinstance(batch, pa.RecordBatch) else batch.column(name).to_numpy()


def partial_postings(links: DataFrame) -> DataFrame:
    """(pair, block, plane, bits) from `aligned` rows: for each linked pair and each block of documents, one bitmap per binary digit of
    the number of links (plane p holds the documents whose number has the digit 2^p). A block may have several parts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        count = 0

        def flushed() -> Iterator[pa.RecordBatch]:
            number, pair, times = (np.concatenate(x) for x in zip(*held))
            parts = []
            for plane in range(int(times.max()).bit_length()):
                here = (times >> plane) & 1 > 0
                parts.append((pair[here], number[here] >> BLOCK_BITS, np.full(here.sum(), plane), number[here] & ((1 << BLOCK_BITS) - 1)))
            yield from packed_postings(*_sorted(*(np.concatenate(x) for x in zip(*parts))))
            held.clear()

        for batch in batches:
            for number, pairs, times in zip(batch.column("number").to_pylist(), batch.column("pairs").to_pylist(), batch.column("times").to_pylist()):
                if pairs:
                    found = np.frombuffer(pairs, "<i8")
                    held.append((np.full(len(found), number, np.int64), found, np.frombuffer(times, "<i8")))
                    count += len(found)
                if count >= MOST_LINKS:
                    yield from flushed()
                    count = 0
        if held:
            yield from flushed()

    return links.select("number", "pairs", "times").mapInArrow(run, POSTING)


def _sorted(*entries: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.lexsort(entries[::-1])
    return tuple(x[order] for x in entries)


def merged_postings(parts: DataFrame) -> DataFrame:
    """(pair, block, plane, bits, n_docs, n_links): the parts of each (pair, block) with their bitmaps OR-merged plane by plane, and
    counted: `n_links` is the plane's bits times its weight, `n_docs` those of all planes together, on the pair's first row in the block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            if not table.num_rows:
                continue
            # The last (pair, block) may go on in the next batch.
            pair, block = _column(table, "pair"), _column(table, "block")
            open_from = int(np.argmax((pair == pair[-1]) & (block == block[-1])))
            rest = table.slice(open_from)
            if open_from:
                yield from merged(table.slice(0, open_from))
        if rest is not None:
            yield from merged(rest)

    def merged(table: pa.Table) -> Iterator[pa.RecordBatch]:
        row, low = unpacked(table.column("bits").combine_chunks())
        pair, block, plane, low = _sorted(_column(table, "pair")[row], _column(table, "block")[row], _column(table, "plane")[row], low)
        same = np.concatenate(([False], (pair[1:] == pair[:-1]) & (block[1:] == block[:-1]) & (plane[1:] == plane[:-1]) & (low[1:] == low[:-1])))
        pair, block, plane, low = (x[~same] for x in (pair, block, plane, low))
        documents = _document_counts(pair, block, low)
        for out in packed_postings(pair, block, plane, low):
            key = list(zip(_column(out, "pair").tolist(), _column(out, "block").tolist()))
            row, _ = unpacked(out.column("bits"))
            n_links = np.bincount(row, minlength=out.num_rows) << _column(out, "plane")
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array([documents.pop(k, 0) for k in key], pa.int64()), pa.array(n_links.astype(np.int64))],
                [*out.schema.names, "n_docs", "n_links"])

    spread = parts.repartition(shuffle_partitions(parts.sparkSession), "pair", "block").sortWithinPartitions("pair", "block")
    return spread.mapInArrow(run, f"{POSTING}, n_docs long, n_links long")


def _document_counts(pair: np.ndarray, block: np.ndarray, low: np.ndarray) -> dict[tuple[int, int], int]:
    """Documents of each (pair, block), whatever their planes."""
    pair, block, low = _sorted(pair, block, low)
    new = np.concatenate(([True], (pair[1:] != pair[:-1]) | (block[1:] != block[:-1]) | (low[1:] != low[:-1])))
    pair, block = pair[new], block[new]
    starts = np.flatnonzero(np.concatenate(([True], (pair[1:] != pair[:-1]) | (block[1:] != block[:-1]))))
    sizes = np.diff(np.append(starts, len(pair)))
    return dict(zip(zip(pair[starts].tolist(), block[starts].tolist()), sizes.tolist()))


def pair_counts(postings: DataFrame) -> DataFrame:
    """(a, b, pair, n_docs, n_links, best): per linked pair of ids the documents that link it and the links, and whether no other
    pair of the same `a` has more documents. A row per pair: the two vocabularies bound their number."""
    counts = postings.groupBy("pair").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links")).withColumns(
        {"a": F.shiftright("pair", 32), "b": F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))})
    most = counts.groupBy("a").agg(F.max("n_docs").alias("most"))
    return counts.join(most, "a").select("a", "b", "pair", "n_docs", "n_links", (F.col("n_docs") == F.col("most")).alias("best"))


def document_scores(postings: DataFrame, counts: DataFrame) -> DataFrame:
    """(number, n_best, count_sum): what the postings give back to their documents. A task holds the sums of one block at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 1 << BLOCK_BITS
        at, sums, best = None, np.zeros(size, np.int64), np.zeros(size, np.int64)

        def given() -> Iterator[pa.RecordBatch]:
            low = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array((at << BLOCK_BITS) + low), pa.array(best[low]), pa.array(sums[low])], ["number", "n_best", "count_sum"])

        for batch in batches:
            blocks = _column(batch, "block")
            row, low = unpacked(batch.column("bits"))
            weight = np.int64(1) << _column(batch, "plane").astype(np.int64)
            count, is_best = (_column(batch, "n_docs") * weight)[row], (_column(batch, "best") * weight)[row]
            for block in np.unique(blocks).tolist():
                if block != at:
                    if at is not None:
                        yield from given()
                    at = block
                    sums[:], best[:] = 0, 0
                here = blocks[row] == block
                np.add.at(sums, low[here], count[here])
                np.add.at(best, low[here], is_best[here])
        if at is not None:
            yield from given()

    weighed = postings.select("pair", "block", "plane", "bits").join(counts.select("pair", "n_docs", "best"), "pair")
    by_block = weighed.select("block", "plane", "bits", "n_docs", F.col("best").cast("long").alias("best")).repartition(
        shuffle_partitions(postings.sparkSession), "block").sortWithinPartitions("block")
    return by_block.mapInArrow(run, "number long, n_best long, count_sum long")


def alignment_report(docs: DataFrame, ranks: str, pieces: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), a row per document.

    `count_sum` adds up, over a text's links, in how many documents the linked pair of ids is; `n_best` are the links whose pair has the most
    documents of all with its first id. Other columns of `docs` are not read; repeated rows count each for itself.
    """
    links = written(aligned(docs, ranks, pieces), "aligned")
    postings = written(merged_postings(written(partial_postings(links), "part-postings")), "postings")
    scores = document_scores(postings, written(pair_counts(postings), "pair-counts"))
    zero = [F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in ("n_best", "count_sum")]
    return links.join(scores, "number", "left").select("doc_id", *STATS, *zero, "groups_sha256")
