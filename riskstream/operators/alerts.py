"""The two correlation rules."""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskstream.operators.interval_join import interval_join

# The wording of the alerts and the limits of the activity rule.
LOGIN_ALERT = ("LOGIN_THEN_TX", "login location != tx location within window")
ACTIVITY_ALERT = ("ACTIVITY_THEN_TX", "limit change then high tx within window")
WATCHED_ACTIVITY = "LIMIT_CHANGE"
HIGH_AMOUNT = 10000


def _labels(alert_type: str, reason: str) -> list[str]:
    return [f"'{alert_type}' AS alert_type", f"'{reason}' AS reason", "e.risk_score"]


def login_then_tx(tx: DataFrame, logins: DataFrame, window: str = "1 minute",
                  watermark: str | None = None, **join) -> DataFrame:
    """A transaction soon after a login from another place; one alert per matching login.

    A place that is unknown (null) on either side raises nothing.
    """
    pairs = interval_join(tx, logins, "account_id", window, watermark=watermark,
                          spread_by="transaction_id", **join)
    return pairs.where("e.location <> g.location").selectExpr(
        "e.account_id", "e.event_time", "e.transaction_id", "e.amount",
        "e.location AS tx_location", "g.location AS login_location",
        "g.ip_address", "g.device_type", "g.login_id", *_labels(*LOGIN_ALERT))


def activity_then_tx(tx: DataFrame, activity: DataFrame, window: str = "5 minutes",
                     watermark: str | None = None, **join) -> DataFrame:
    """A large transaction soon after a limit change.

    Catalyst moves both conditions to their own side of the join, in a stream below the watermarks
    too, so only rows that can still raise an alert are shuffled or held as state.
    """
    pairs = interval_join(tx, activity, "account_id", window, watermark=watermark,
                          spread_by="transaction_id", **join)
    return pairs.where(
        f"g.activity_type = '{WATCHED_ACTIVITY}' AND e.amount >= {HIGH_AMOUNT}"
    ).selectExpr(
        "e.account_id", "e.event_time", "e.transaction_id", "e.amount",
        "g.activity_type", "g.old_value", "g.new_value", *_labels(*ACTIVITY_ALERT))
