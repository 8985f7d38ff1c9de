"""Commit records: one small file per finished micro-batch, written when all its routes have been."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession

from riskstream.settings import Settings
from riskstream.sources.files import folder_exists, level_values

RECORD = ("query string, query_id string, batch long, clock timestamp, watermark timestamp, offsets array<string>, "
          "hours array<struct<tag: string, dt: string, hr: int, row_count: long>>")
LIVE = re.compile(r"([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})-(\d+)")     # a leaf: query id and micro-batch
# Queries that write transactions, and the one beside "layers" that writes the alerts.
WRITERS, SECOND = ("risk_layers", "layers"), {"layers": "alerts"}


def _folder(settings: Settings, query_id: str = "") -> str:
    return settings.layer(f"_commits/{query_id}")


def _write(spark: SparkSession, settings: Settings, record: tuple) -> None:
    _, query_id, batch, clock = record[:4]
    path = f"{_folder(settings, query_id)}/day={clock:%Y-%m-%d}/batch={batch}"
    spark.createDataFrame([record], RECORD).coalesce(1).write.mode("overwrite").json(path)


def note_start(spark: SparkSession, settings: Settings, query: str, query_id: str) -> None:
    """Before the first write of a new query, so that what it is writing is not taken for rows of a lake without records."""
    now = datetime.now(timezone.utc)
    _write(spark, settings, (query, query_id, -1, now, None, [], []))


def note_commit(spark: SparkSession, settings: Settings, query: str, query_id: str, batch: int,
                hours: Iterable[tuple[str, str, int, int]]) -> None:
    """The batch is written: its clock, watermark and source offsets from the query's own log, and its rows by route and hour (null for rows
    without an event time)."""
    log = spark.read.text(f"{settings.checkpoint(query)}/offsets/{batch}").collect()
    clocks, *offsets = [row.value for row in log[1:]]
    times = json.loads(clocks)
    clock, watermark = (datetime.fromtimestamp(times[name] / 1000, timezone.utc) for name in ("batchTimestampMs", "batchWatermarkMs"))
    _write(spark, settings, (query, query_id, batch, clock, watermark, offsets, sorted(hours, key=repr)))


def last_batch(spark: SparkSession, settings: Settings, query_id: str) -> tuple[str, int] | None:
    """(day, batch) of a query's last record: -1 if it has finished none yet, None if it keeps no records. Folder names only."""
    days = sorted(level_values(spark, f"{_folder(settings, query_id)}/day=*"))
    for day in reversed(days):
        batches = [int(n) for n in level_values(spark, f"{_folder(settings, query_id)}/day={day}/batch=*")]
        if batches:
            return day, max(batches)
    return None


def finished(spark: SparkSession, settings: Settings, of: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """The leaves whose micro-batch is finished. Batches follow each other, so all up to the last recorded one are; leaves of
    queries without records, and such as no stream wrote, count as finished."""
    last: dict[str, int | None] = {}
    done = []
    for hr, leaf in of:
        live = LIVE.fullmatch(leaf)
        if live:
            if live[1] not in last:
                found = last_batch(spark, settings, live[1])
                last[live[1]] = found and found[1]
            if last[live[1]] is not None and int(live[2]) > last[live[1]]:
                continue
        done.append((hr, leaf))
    return done


def is_recorded(spark: SparkSession, settings: Settings, query_id: str, batch: int) -> bool:
    found = last_batch(spark, settings, query_id)
    return found is not None and batch <= found[1]


def records(spark: SparkSession, settings: Settings) -> DataFrame:
    """All records of the lake."""
    return spark.read.schema(RECORD).json(f"{_folder(settings)}*/day=*/batch=*")


def latest_records(spark: SparkSession, settings: Settings) -> list[Row]:
    """The last record of each query, one small file each."""
    if not folder_exists(spark, _folder(settings)):
        return []
    paths = []
    for query_id in level_values(spark, f"{_folder(settings)}*"):
        if found := last_batch(spark, settings, query_id):
            paths.append(f"{_folder(settings, query_id)}/day={found[0]}/batch={found[1]}")
    return spark.read.schema(RECORD).json(paths).collect() if paths else []


def clock_of_layers(spark: SparkSession, settings: Settings) -> datetime | None:
    """The clock up to which every micro-batch has been written whole, or None for a lake without records. Of several queries
    that wrote transactions the one in force is that which finished a batch last; where the alerts have a query of
    their own, both must have got so far."""
    latest: dict[str, datetime] = {}
    for row in latest_records(spark, settings):
        clock = row.clock.replace(tzinfo=timezone.utc) if row.clock.tzinfo is None else row.clock
        if row.batch >= 0:
            latest[row.query] = max(latest.get(row.query, clock), clock)
        else:
            latest.setdefault(row.query, datetime.min.replace(tzinfo=timezone.utc))
    writers = [name for name in WRITERS if name in latest]
    if not writers:
        return None
    writer = max(writers, key=latest.__getitem__)
    return min([latest[writer], *(latest[name] for name in (SECOND.get(writer),) if name in latest)])
