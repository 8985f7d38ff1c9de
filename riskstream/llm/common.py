"""What the operators share: reading, scratch tables, words, and text columns of Arrow batches."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Hashable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskstream.workspace import shared_folder


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str, partition_by: str | None = None) -> DataFrame:
    """`df` as a Parquet table in the shared folder: lineage ends there, and a lost executor loses
    nothing that has been written."""
    path = shared_folder(df.sparkSession, purpose)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def as_row(df: DataFrame, *without: str) -> Column:
    """All columns of `df` but `without` as one named row, so that none of them clashes with what an operator adds."""
    return F.struct(*[df[f"`{c}`"] for c in df.columns if c.lower() not in without]).alias("row")


def from_row(df: DataFrame, like: DataFrame, **replaced: str | Column) -> DataFrame:
    """The columns of `like`, in its order, out of `as_row`'s column; those in `replaced` from there."""
    columns = [replaced.get(c.lower(), F.col("row").getField(c)) for c in like.columns]
    return df.select(*[(F.col(x) if isinstance(x, str) else x).alias(c) for x, c in zip(columns, like.columns)])


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words_of(text: bytes) -> list[bytes]:
    """A-Z lower-cased, cut at space and U+0009 to U+000D; other letters and spaces stay."""
    return text.lower().split()


def hash_part(column: Column | str) -> Column:
    """crc32 of an id written as text; null for a null id."""
    column = F.col(column) if isinstance(column, str) else column
    return F.crc32(column.cast("string").cast("binary"))


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """A string column as UTF-8 bytes; null is empty."""
    return [value or b"" for value in column.cast(pa.large_binary()).to_pylist()]


def arrow_pieces(batches: Iterator[pa.RecordBatch], text: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Splits batches so that the texts of a piece hold about `most` bytes; a longer text is a piece."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(text)).fill_null(0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)


def kept_in_process(key: Hashable, make: Callable[[], Any]) -> Any:
    """What `make` returned when this process first asked for `key`. Functions that travel with a task have
    globals of their own, so the place is one that all of them see."""
    kept = vars(sys).setdefault("_riskstream_kept", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


def give_back() -> None:
    """Returns what this process has freed to the system. A worker is kept for the tasks of later stages and would hold it
    beside theirs."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):     # glibc's
        trim(0)
