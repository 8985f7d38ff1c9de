"""Assembly of the streaming jobs."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from riskstream.functions.clock import add_dt_hr, add_event_time
from riskstream.operators.interval_join import HotSpan
from riskstream.operators.routes import ROUTES
from riskstream.operators.scoring import score_transactions
from riskstream.plans.layers import Layers, unify
from riskstream.settings import Settings
from riskstream.sources.events import Feeds
from riskstream.sources.feeds import CONTRACTS, Contract, decode_feed, ingest
from riskstream.sources.kafka import read_kafka
from riskstream.streaming.hot_accounts import grown_hot_accounts
from riskstream.streaming.router import dual_write_router, foreach_batch_router

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_session(spark: SparkSession, settings: Settings) -> SparkSession:
    """A sibling session with the options a stateful stream needs; the caller's stays as it is.

    Join state lives in RocksDB, off the JVM heap, with changelog checkpoints. The number of state
    partitions is fixed when a checkpoint is made, so it is a setting and not what the cluster happens to have.
    """
    session = spark.newSession()
    partitions = settings.state_partitions or spark.conf.get("spark.sql.shuffle.partitions")
    for key, value in {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.streaming.join.stateFormatVersion": "3",
    }.items():
        session.conf.set(key, value)
    return session


def start_router(unified: DataFrame, settings: Settings, query: str = "risk_layers",
                 open_store: Callable[[], object] | None = None,
                 available_now: bool = False) -> StreamingQuery:
    """One query for all routes of `unified`, in append mode, on its own checkpoint."""
    trigger = {"availableNow": True} if available_now else {"processingTime": settings.trigger_interval}
    return (
        unified.writeStream.queryName(query).outputMode("append")
        .foreachBatch(foreach_batch_router(settings, open_store, query))
        .trigger(**trigger)
        .option("checkpointLocation", settings.checkpoint(query))
        .start()
    )


def rows_dropped_by_watermark(query: StreamingQuery) -> int:
    """Rows the joins of the recent micro-batches refused because they came behind the watermark.

    A trigger counts once per copy. Event time and lateness are different clocks: one event from the future moves the watermark
    ahead, and on-time rows then miss the joins. Alert on a number above zero.
    """
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)


def unified_stream(raw: Feeds, settings: Settings, body: str = "avro",
                   proc_time: Column | str | None = None, hot: Sequence[str | HotSpan] = (),
                   only: Iterable[str] = tuple(ROUTES),
                   contracts: Mapping[str, Contract] = CONTRACTS) -> DataFrame:
    """Raw framed topics -> tagged union. `contracts`: by feed, in the order of CONTRACTS."""
    feeds = Feeds(*(ingest(df, contracts[name], body) for df, name in zip(raw, CONTRACTS)))
    return unify(Layers(feeds, settings, proc_time, hot), only)


def kafka_topics(spark: SparkSession, settings: Settings) -> Feeds:
    return Feeds(*(
        read_kafka(spark, settings.bootstrap, topic, settings.starting_offsets,
                   settings.max_offsets_per_trigger, settings.fail_on_data_loss)
        for topic in (settings.topic_tx, settings.topic_logins, settings.topic_activity)
    ))


def run_stream(spark: SparkSession, settings: Settings, body: str = "avro",
               open_store: Callable[[], object] | None = None, split: bool = False,
               contracts: Mapping[str, Contract] = CONTRACTS) -> list[StreamingQuery]:
    """Start the three-topic job and return its queries.

    One query with one checkpoint writes everything. split=True runs the stateless layers and the alerts as
    two, so that a slow join never holds back the audit trail; each then has its own clock, so a row at the
    bound of lateness can be late in one and on time in the other, and its own first offsets, so they
    agree on all rows only if `starting_offsets` is "earliest".
    """
    session = stream_session(spark, settings)
    topics = kafka_topics(session, settings)
    # Joins on a query of their own may be ahead of the layers.
    hot = grown_hot_accounts(session, settings, time.time_ns() // 1000 if split else None)
    plain = [tag for tag in ROUTES if tag != "ALERT"]
    groups = {"layers": plain, "alerts": ["ALERT"]} if split else {"risk_layers": list(ROUTES)}
    return [
        start_router(unified_stream(topics, settings, body, hot=hot, only=only, contracts=contracts), settings, name, open_store)
        for name, only in groups.items()
    ]


def dual_write_stream(raw: DataFrame, settings: Settings, body: str = "avro") -> DataFrame:
    decoded = decode_feed(raw, CONTRACTS["transactions"], body)
    return add_dt_hr(add_event_time(score_transactions(decoded, settings.high_risk_threshold)))


def start_dual_write(scored: DataFrame, settings: Settings,
                     open_store: Callable[[], object] | None = None,
                     available_now: bool = False) -> StreamingQuery:
    trigger = {"availableNow": True} if available_now else {"processingTime": settings.trigger_interval}
    return (
        scored.writeStream.queryName("dual_write").outputMode("append")
        .foreachBatch(dual_write_router(settings, open_store))
        .trigger(**trigger)
        .option("checkpointLocation", settings.checkpoint("dual_write"))
        .start()
    )


def run_dual_write_stream(spark: SparkSession, settings: Settings, body: str = "avro",
                          open_store: Callable[[], object] | None = None) -> list[StreamingQuery]:
    """The single-topic job: no lateness, no joins; starts at the earliest offset.

    Its usual trigger is 10 seconds: Settings(root, trigger_interval="10 seconds").
    """
    raw = read_kafka(stream_session(spark, settings), settings.bootstrap, settings.topic_tx,
                     "earliest", settings.max_offsets_per_trigger, fail_on_data_loss=True)
    return [start_dual_write(dual_write_stream(raw, settings, body), settings, open_store)]
