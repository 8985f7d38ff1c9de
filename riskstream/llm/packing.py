"""Documents cut into pieces of token ids, and pieces packed into sequences by sums of squares."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from riskstream.llm.common import arrow_pieces, give_back, written
from riskstream.llm.subwords import encoder

PIECES_PER_TASK = 40_000


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """(doc_id, piece, start, length, ids): each document's ids and `end_id`, in pieces of `capacity` ids.

    Only a document of more ids is cut; its first piece takes what is over. `ids` are little-endian
    unsigned 32-bit numbers. Null text is empty, and empty text is one piece of `end_id` alone. Rows
    that repeat a doc_id are cut each for itself. Whole texts, whatever their length.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = encoder(tokenizer)
        encode = kept.text_ids
        names = ["doc_id", "piece", "start", "length", "ids"]
        for batch in arrow_pieces(batches, "text"):
            at, pieces, starts, lengths, blobs = [], [], [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                ids = np.append(encode(text or ""), np.uint32(end_id)).astype("<u4")
                first = (len(ids) - 1) % capacity + 1
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    at.append(row)
                    pieces.append(k)
                    starts.append(a)
                    lengths.append(b - a)
                    blobs.append(ids[a:b].tobytes())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(pa.array(at, pa.int32())), pa.array(pieces, pa.int32()),
                pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(blobs, pa.binary())], names)
        kept.clear()            # the vocabulary stays, the words of the task go
        give_back()

    ids = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {ids}, piece int, start long, length long, ids binary")


class SumOfSquares:
    """Open bins by gap. An item goes where the sum over gaps of (bins with that gap)^2 ends up smallest:
    into a bin with a gap that fits, or into a new one. Ties go to the smallest gap."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.counts = np.zeros(capacity + 1, np.int64)       # by gap; a full bin counts no more
        self.opened = 0

    def place(self, size: int) -> tuple[int, int]:
        """(bin, offset)"""
        gaps = self.counts[size:self.capacity]
        grown = self.counts[:self.capacity + 1 - size]       # the gap that is left, by the gap that is used
        change = 2 * grown - 2 * np.append(gaps, 0)
        change[:-1] += 2                                     # one bin less there, one more here
        change[-1] += 1                                      # a new bin is only one more
        change[0] -= 2 * grown[0] + 1                        # no gap is left: nothing grows
        change[:-1][gaps == 0] = np.iinfo(np.int64).max
        gap = size + int(np.argmin(change))
        if gap == self.capacity:
            which, self.opened = self.opened, self.opened + 1
        else:
            which = self.bins[gap].pop()
            self.counts[gap] -= 1
        if gap > size:
            self.bins[gap - size].append(which)
            self.counts[gap - size] += 1
        return which, self.capacity - gap


def pack(pieces: DataFrame, capacity: int = 1024, per_task: int = PIECES_PER_TASK) -> DataFrame:
    """`pieces`, all columns, with sequence_id and offset: no sequence holds more than `capacity`.

    `pieces` has doc_id, piece and length (1 to `capacity`); it is read twice, so it should be a table.
    Pieces that fill a sequence are one. The others are dealt by a hash of (doc_id, piece, start) to
    tasks of about `per_task` pieces, each of which packs what it has, largest first; the last, partly
    filled sequences of a task are all that is lost to the split. Repeated rows are packed as often as
    they come. No rows: no rows.
    """
    full = pieces.where(F.col("length") >= capacity).withColumns({
        "sequence_id": -F.monotonically_increasing_id() - 1, "offset": F.lit(0).cast("long")})
    parts = pieces.where(F.col("length") < capacity)
    tasks = max(1, -(-parts.count() // per_task))
    dealt = parts.repartition(tasks, F.xxhash64("doc_id", "piece", "length")).sortWithinPartitions(
        F.desc("length"), "doc_id", "piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, base = SumOfSquares(capacity), TaskContext.get().partitionId() << 33
        for batch in batches:
            placed = [bins.place(size) for size in batch.column("length").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([base + b for b, _ in placed], pa.int64()),
                 pa.array([o for _, o in placed], pa.int64())], [*batch.schema.names, "sequence_id", "offset"])
        del bins
        give_back()

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return dealt.mapInArrow(run, f"{columns}, sequence_id long, offset long").unionByName(full)


def packed_documents(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """Every piece with its ids' crc32, its sequence and its place there; see `cut_pieces` and `pack`."""
    pieces = cut_pieces(docs, tokenizer, capacity, end_id)
    return pack(written(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pieces"), capacity)
