"""The hourly batch: readiness, partition sync, compaction, gold."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import SparkSession

from riskstream.operators.routes import ROUTES
from riskstream.plans.compaction import compact
from riskstream.plans.gold import load_gold
from riskstream.plans.serving import load_serving
from riskstream.plans.tables import create_tables, sync_day
from riskstream.settings import Settings, seconds
from riskstream.sources.commits import clock_of_layers
from riskstream.sources.files import folder_exists, read_hours


def hour_ready(spark: SparkSession, settings: Settings, dt: str, hr: int,
               now: datetime | None = None) -> bool:
    """Whether bronze holds rows of the hour and no on-time row of it can still arrive.

    A micro-batch that began in time may still be writing. Streams leave a record of each finished batch, so the hour is ready when one
    with a later clock is finished; a stream without rows makes no batches and is waited for no longer than `idle_allowance`. In a lake
    without records the wall clock alone decides: compaction replaces only leaves that it has read, so what
    lands later stays, and repeating the hour takes it in.
    """
    end = datetime.fromisoformat(dt).replace(tzinfo=timezone.utc) + timedelta(hours=int(hr) + 1)
    now = now or datetime.now(timezone.utc)
    due = end + timedelta(seconds=seconds(settings.late_allowance))
    if now < due:
        return False
    clock = clock_of_layers(spark, settings)
    if clock is not None and clock < due and now < due + timedelta(seconds=seconds(settings.idle_allowance)):
        return False
    route = ROUTES["BRONZE_TX"]
    layer = settings.layer(route.layer)
    if not folder_exists(spark, f"{layer}/dt={dt}/hr={int(hr)}"):
        return False
    return not read_hours(spark, layer, route.stored, dt, hr).isEmpty()


def run_hour(spark: SparkSession, settings: Settings, dt: str, hr: int,
             now: datetime | None = None) -> bool:
    """One hourly run; False when the hour is not ready. Repeating it changes nothing."""
    if not hour_ready(spark, settings, dt, hr, now):
        return False
    create_tables(spark, settings)
    compact(spark, settings, dt, hr)
    sync_day(spark, settings, dt)
    load_gold(spark, settings, dt)
    load_serving(spark, settings, dt)
    return True
