"""The accounts that a stream's joins split in parts: a list that grows and shrinks from one start to the next."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskstream.operators.interval_join import HotSpan, hot_keys
from riskstream.operators.routes import ROUTES
from riskstream.settings import Settings, seconds
from riskstream.sources.files import folder_exists, latest_hours

FEED_ROUTES = ("BRONZE_TX", "BRONZE_LOGIN", "BRONZE_ACTIVITY")
CHANGES = "account_id string, at long, hot boolean"


def grown_hot_accounts(spark: SparkSession, settings: Settings, now: int | None = None) -> list[HotSpan]:
    """Measures the busy accounts again and returns the spans in force; call it while the stream does not run.

    Every change is noted beside the checkpoints with the time up to which the stream may hold state: the latest event in the lake, or
    `now` (microseconds) if that is later, as it must be given where the joins run ahead of the layers. An account is
    split from the first cell after that time, so what is held stays where a join looks for it. One that is busy no longer is
    joined whole again from the next cell on, and leaves the list when no row of its span can come any more. In force are therefore at
    most 1 / `hot_share` accounts and those that left it lately.
    """
    recent = _recent(spark, settings)
    listed = _noted(spark, settings)
    if recent is None:
        return _spans(listed)
    busy = hot_keys(recent, "account_id", settings.hot_share)
    latest = recent.agg(F.max(F.unix_micros("event_time"))).first()[0]
    at = max(x for x in (latest, now, *(at for _, at, _ in listed)) if x is not None)
    hot_now = {span.key for span in _spans(listed) if span.until is None}
    changes = [(key, at, True) for key in busy if key not in hot_now] + [(key, at, False) for key in sorted(hot_now - set(busy))]
    if changes:
        spark.createDataFrame(changes, CHANGES).coalesce(1).write.mode("append").json(settings.checkpoint("hot_accounts"))
    oldest = at - 1_000_000 * (seconds(settings.watermark_delay) + seconds(settings.late_allowance) + 2 * max(
        seconds(settings.login_tx_window), seconds(settings.activity_tx_window)))
    return [span for span in _spans(listed + changes) if span.until is None or span.until >= oldest]


def _recent(spark: SparkSession, settings: Settings) -> DataFrame | None:
    """Account and time of all feeds' rows in the latest hours of the lake."""
    routes = [ROUTES[tag] for tag in FEED_ROUTES]
    found = {route: latest_hours(spark, settings.layer(route.layer), settings.hot_hours) for route in routes}
    latest = sorted({hour for hours in found.values() for hour in hours}, reverse=True)[:settings.hot_hours]
    parts = []
    for route, hours in found.items():
        layer = settings.layer(route.layer)
        paths = [f"{layer}/dt={dt}/hr={hr}" for dt, hr in hours if (dt, hr) in latest]
        if paths:
            rows = spark.read.schema(route.stored).option("basePath", layer).parquet(*paths)
            parts.append(rows.select("account_id", "event_time"))
    return reduce(DataFrame.union, parts) if parts else None


def _noted(spark: SparkSession, settings: Settings) -> list[tuple[str, int, bool]]:
    notes = settings.checkpoint("hot_accounts")
    if not folder_exists(spark, notes):
        return []
    # An entry without a time is of a list that was fixed at the first start.
    rows = spark.read.schema(CHANGES).json(notes).collect()
    return sorted((r.account_id, r.at if r.at is not None else -(1 << 62), r.hot is not False) for r in rows)


def _spans(changes: list[tuple[str, int, bool]]) -> list[HotSpan]:
    spans: dict[str, list[HotSpan]] = {}
    for key, at, hot in sorted(changes, key=lambda x: (x[1], x[2])):
        own = spans.setdefault(key, [])
        if hot and (not own or own[-1].until is not None):
            own.append(HotSpan(key, at))
        elif not hot and own and own[-1].until is None:
            own[-1] = own[-1]._replace(until=at)
    return [span for key in sorted(spans) for span in spans[key]]
