"""Repair of alerts that a stream never raised, because a row came behind the watermark of its joins.

Event time and lateness are different clocks: a row can be on time for the layers and yet be refused by the joins. It is then in
bronze and silver, and its alerts are missing.
"""

from __future__ import annotations

import uuid
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskstream import schemas
from riskstream.functions.clock import add_dt_hr
from riskstream.operators.alerts import activity_then_tx, login_then_tx
from riskstream.operators.interval_join import hot_keys
from riskstream.operators.routes import ROUTES
from riskstream.operators.sinks import write_layer
from riskstream.plans.versions import whole_days
from riskstream.settings import Settings, seconds
from riskstream.sources.commits import latest_records

REPAIR = "repair"
ALERT_WRITERS = ("risk_layers", "alerts")
IDENTITY = [name for name in schemas.ALERT.names if name != "emitted_at"]


def settled_until(spark: SparkSession, settings: Settings) -> datetime | None:
    """The watermark of the last finished batch of the query that writes alerts: the joins take no row before it any
    more. None: no stream keeps records here, so nothing is on its way."""
    found = [r for r in latest_records(spark, settings) if r.query in ALERT_WRITERS]
    if not found:
        return None
    last = max(found, key=lambda r: (r.batch >= 0, r.clock))
    if last.batch < 0 or last.watermark is None:
        return datetime.fromtimestamp(0, timezone.utc)
    return last.watermark.replace(tzinfo=timezone.utc) if last.watermark.tzinfo is None else last.watermark


def missing_alerts(spark: SparkSession, settings: Settings, dt: str) -> DataFrame | None:
    """Alerts that the rules raise on a day's finished rows and that are not stored, each as often as it is missing; None for a day
    without transactions.

    Both joins are those of the stream in batch, over the day's transactions and the triggers of a window before; what is stored
    is subtracted with its number of copies, so repeated rows keep theirs. Transactions that the running stream may still
    join are left out. Accounts with much of the day are split in parts.
    """
    day = date.fromisoformat(dt)
    tx = whole_days(spark, settings, "SILVER_TX", [dt])
    if tx is None:
        return None
    until = settled_until(spark, settings)
    if until is not None:
        tx = tx.where(F.col("event_time") < F.lit(until))
    hot = hot_keys(tx, "account_id", settings.hot_share)
    found = []
    for rule, tag, window in ((login_then_tx, "BRONZE_LOGIN", settings.login_tx_window),
                              (activity_then_tx, "BRONZE_ACTIVITY", settings.activity_tx_window)):
        back = -(-seconds(window) // 86_400)
        triggers = whole_days(spark, settings, tag, [str(day - timedelta(days=n)) for n in range(back, -1, -1)])
        if triggers is not None:
            found.append(schemas.conform(rule(tx, triggers, window, hot=hot, hot_parts=settings.hot_salts), schemas.ALERT))
    if not found:
        return None
    expected = (found[0].unionAll(found[1]) if len(found) == 2 else found[0]).select(*IDENTITY)
    stored = whole_days(spark, settings, "ALERT", [dt])
    return expected if stored is None else expected.exceptAll(stored.select(*IDENTITY))


def repair_alerts(spark: SparkSession, settings: Settings, dt: str) -> bool:
    """Append a day's missing alerts as a leaf of their own; False if the day has no transactions or no triggers.

    A second run finds nothing to add. One that breaks off has written some hours whole or none; the next one adds the rest. Run one
    at a time for a day, and the hourly and serving jobs of the day after it, as after any late leaf.
    """
    missing = missing_alerts(spark, settings, dt)
    if missing is None:
        return False
    route = ROUTES["ALERT"]
    write_layer(add_dt_hr(missing.withColumn("emitted_at", F.current_timestamp())), settings.layer(route.layer), route,
                f"{REPAIR}-{uuid.uuid4().hex}")
    return True
