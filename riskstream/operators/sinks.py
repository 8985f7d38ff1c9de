"""Partitioned Parquet writes of the lake layers."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, functions as F

from riskstream.operators.routes import Route
from riskstream.schemas import conform

COMPACTED = "compacted"
LEVELS = ("dt", "hr", "batch_id")


def write_layer(df: DataFrame, path: str, route: Route, batch_id: str | Column) -> None:
    """Batch write. Rows are brought together by hour and adaptively rebalanced, so that an hour
    with much data becomes several tasks and files, and many small hours share a task.

    Only the leaves of this `batch_id` (a name, or an expression over the rows) are replaced,
    which makes a repeated write harmless.
    """
    leaf = F.lit(batch_id) if isinstance(batch_id, str) else batch_id
    rows = conform(df.withColumn("batch_id", leaf), route.stored)
    write_leaves(rows.hint("rebalance", F.col("dt"), F.col("hr")), path)


def write_micro_batch(df: DataFrame, path: str, route: Route, batch_id: str, rows: int,
                      rows_per_file: int) -> None:
    """Write one route of a cached micro-batch of a known row count.

    A live micro-batch lies almost wholly in one hour. Hashing by hour would make one task of it;
    ranges over (hour, row hash) cut it into even pieces of at most about `rows_per_file`. The
    hash depends on the row alone, so a recomputed task sends every row to the same piece.
    """
    out = conform(df.withColumn("batch_id", F.lit(batch_id)), route.stored)
    files = max(1, ceil(rows / rows_per_file))
    write_leaves(out.repartitionByRange(files, "dt", "hr", F.xxhash64(*route.spread_by)), path)


def write_leaves(rows: DataFrame, path: str) -> None:
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*LEVELS).parquet(path))
