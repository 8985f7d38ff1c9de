"""Replay of history through the streaming job, as framed JSON messages in time order."""

from __future__ import annotations

from collections.abc import Iterable
from math import ceil

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

from riskstream import schemas
from riskstream.functions.frames import to_frame
from riskstream.operators.routes import ROUTES
from riskstream.settings import Settings
from riskstream.sources.events import Feeds
from riskstream.sources.feeds import CONTRACTS, Contract
from riskstream.sources.files import stream_files
from riskstream.streaming.hot_accounts import grown_hot_accounts
from riskstream.streaming.jobs import start_router, stream_session, unified_stream

REPLAYED = schemas.merge(schemas.RAW, StructType([StructField("proc_time", TimestampType())]))
ROWS_PER_CORE = 2_000_000


def topic_streams(spark: SparkSession, topics: str, max_files_per_trigger: int = 0) -> Feeds:
    """The staged topics as streams of raw messages."""
    return Feeds(*(
        stream_files(spark, f"{topics}/topic={name}", REPLAYED, max_files_per_trigger)
        for name in CONTRACTS
    ))


def as_messages(feed: DataFrame, contract: Contract) -> DataFrame:
    body = F.to_json(F.struct(*contract.schema.names))
    return feed.select(to_frame(body, contract.schema_id).alias("value"), "kafka_timestamp",
                       "proc_time", F.lit(contract.name).alias("topic"))


def stage_slice(feeds: Feeds, topics: str, first: int, after: int, untimed: bool = True) -> None:
    """Append the messages with first <= timestamp < after to the topic folders, in one job; `untimed`: and those
    without a timestamp, which go to the dead letters."""
    within = F.col("timestamp").between(first, after - 1)
    within = F.coalesce(within, F.lit(untimed))
    parts = [
        as_messages(feed.where(within), contract)
        for feed, contract in zip(feeds, CONTRACTS.values())
    ]
    messages = parts[0].union(parts[1]).union(parts[2])
    messages.write.mode("append").partitionBy("topic").parquet(topics)


def time_slices(feeds: Feeds, at_least: int = 1) -> list[tuple[int, int]]:
    """Equal time ranges that cover all feeds, each with about as many rows as the cluster's cores
    take in one micro-batch. One small aggregate."""
    times = feeds.transactions.select("timestamp").union(feeds.logins.select("timestamp")).union(
        feeds.activity.select("timestamp"))
    first, last, rows = times.agg(
        F.min("timestamp"), F.max("timestamp"), F.count("*")).first()
    if not rows:
        return []
    if first is None:       # no row has a time
        return [(0, 1)]
    cores = feeds.transactions.sparkSession.sparkContext.defaultParallelism
    count = max(at_least, ceil(rows / (ROWS_PER_CORE * cores)))
    width = (last - first) // count + 1
    return [(first + i * width, first + (i + 1) * width) for i in range(count)]


def replay(spark: SparkSession, settings: Settings, feeds: Feeds, slices: int = 3,
           only: Iterable[str] = tuple(ROUTES), hot: Iterable[str] = (), open_store=None,
           grow_hot: bool = False) -> list[int]:
    """Stream the feeds slice by slice into the lake; returns the input rows of each micro-batch.

    A slice is staged completely, then a query on the same checkpoint takes it as one micro-batch
    and stops. Batches therefore follow event time, no row falls behind the watermark however the
    files are ordered, and every slice but the first restarts from the checkpoint. `grow_hot`: before each slice the
    list of busy accounts is measured again.
    """
    session = stream_session(spark, settings)
    topics = settings.layer("_staging/topics")
    sizes: list[int] = []
    for number, (first, after) in enumerate(time_slices(feeds, slices)):
        stage_slice(feeds, topics, first, after, untimed=number == 0)
        busy = (*hot, *grown_hot_accounts(session, settings)) if grow_hot else tuple(hot)
        unified = unified_stream(
            topic_streams(session, topics), settings, "json", "proc_time", busy, only)
        query = start_router(unified, settings, open_store=open_store, available_now=True)
        query.awaitTermination()
        sizes += [progress.numInputRows for progress in query.recentProgress]
    return sizes
