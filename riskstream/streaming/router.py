"""foreachBatch sinks: one cached micro-batch, fanned out to its routes."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, functions as F
from pyspark.storagelevel import StorageLevel

from riskstream.operators.keyed import high_risk_cells, latest_by_key, put_rows, serving_alerts
from riskstream.operators.routes import ROUTES, Route
from riskstream.operators.sinks import write_micro_batch
from riskstream.settings import Settings
from riskstream.sources.commits import is_recorded, last_batch, note_commit, note_start

SINKS_AT_ONCE = 4


def leaf_name(batch: DataFrame, batch_id: int) -> str:
    """Names the write in the lake: the query's id, which its checkpoint keeps across restarts,
    and the batch number. A query on a fresh checkpoint gets other names and overwrites nothing."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query:
        raise RuntimeError("the router must run inside a streaming query")
    return f"{query}-{batch_id}"


def foreach_batch_router(settings: Settings, open_store: Callable[[], object] | None = None,
                         query: str | None = None) -> Callable[[DataFrame, int], None]:
    """Write every tagged row to the layer of its tag, and the alerts also to a keyed store.

    The batch is cached before anything looks at it, so the joins run once. One count per tag and hour
    fills the cache, sizes the files and skips the empty routes. Writes
    replace the batch's own leaves and puts are upserts, so a repeated batch changes nothing.
    With the name of the `query` a record is left when all of it is written: until then its leaves are not read by
    compaction, and a batch that is repeated after its record writes nothing (but is counted: that moves the joins' state on).
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        spark, leaf = batch.sparkSession, leaf_name(batch, batch_id)
        query_id = leaf.rpartition("-")[0]
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            hours = [tuple(r) for r in batch.groupBy("_type", F.col("dt").cast("string").alias("dt"), "hr").count().collect()]
            if query and is_recorded(spark, settings, query_id, batch_id):
                return
            if query and last_batch(spark, settings, query_id) is None:
                note_start(spark, settings, query, query_id)
            counts: dict[str, int] = {}
            for tag, _, _, rows in hours:
                counts[tag] = counts.get(tag, 0) + rows

            def write(tag: str) -> None:
                route = ROUTES[tag]
                write_micro_batch(batch.where(F.col("_type") == tag), settings.layer(route.layer),
                                  route, leaf, counts[tag], settings.rows_per_file)

            in_parallel(batch, write, [tag for tag in ROUTES if counts.get(tag)])
            if open_store is not None and counts.get("ALERT"):
                latest = serving_alerts(batch.where(F.col("_type") == "ALERT"))
                put_rows(latest, open_store, settings.put_batch)
            if query:
                note_commit(spark, settings, query, query_id, batch_id, hours)
        finally:
            batch.unpersist()

    return sink


def dual_write_router(settings: Settings, open_store: Callable[[], object] | None = None,
                      ) -> Callable[[DataFrame, int], None]:
    """Single-feed sink: all scored rows to one layer, the high-risk ones also to a keyed store."""
    silver = ROUTES["SILVER_TX"]
    route = Route("transactions", silver.schema, silver.spread_by)

    def sink(batch: DataFrame, batch_id: int) -> None:
        leaf = leaf_name(batch, batch_id)
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows = batch.count()
            if rows == 0:
                return
            write_micro_batch(batch, settings.layer(route.layer), route, leaf, rows,
                              settings.rows_per_file)
            if open_store is not None:
                cells = high_risk_cells(batch, "transaction_id")
                latest = latest_by_key(cells, F.desc("transaction_id")).drop("transaction_id")
                put_rows(latest, open_store, settings.put_batch)
        finally:
            batch.unpersist()

    return sink


def in_parallel(batch: DataFrame, write: Callable[[str], None], tags: list[str]) -> None:
    """The routes are independent Spark jobs; submitting a few at once keeps the cluster busy."""
    if not tags:
        return
    with ThreadPoolExecutor(min(SINKS_AT_ONCE, len(tags))) as pool:
        wrapped = inheritable_thread_target(batch.sparkSession)(write)
        for done in [pool.submit(wrapped, tag) for tag in tags]:
            done.result()
