"""Row keys of the keyed serving tables."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def alert_row_key() -> Column:
    """account_epochMillis_transaction, from the UTC instant rather than a local clock."""
    return F.format_string(
        "%s_%d_%s", F.col("account_id"), F.unix_millis("event_time"), F.col("transaction_id"))


def high_risk_row_key() -> Column:
    return F.format_string("%s_%d", F.col("account_id"), F.col("timestamp"))
