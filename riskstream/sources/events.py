"""The three feeds, derived from a generic event table.

Time runs 20 times faster than in the table, so that 30 days of events become 36 hours of feeds.
Users share accounts, 15 to an account, so that the number of accounts, and with it the number
of alerts, grows in step with the table.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

# Values of this fixture. Only 'Unknown' has a meaning: the score looks for it.
LOCATIONS = ("New York", "London", "Paris", "Tokyo", "Berlin", "Unknown")
START_MILLIS = 1704067200000
SPEED = 20
USERS_PER_ACCOUNT = 15

TRANSACTION_TYPES = ("view", "purchase", "error")
LOGIN_TYPES = ("click",)
ACTIVITY_TYPES = ("signup",)


class Feeds(NamedTuple):
    transactions: DataFrame
    logins: DataFrame
    activity: DataFrame


EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def _quoted(names: tuple[str, ...]) -> str:
    return ", ".join(f"'{name}'" for name in names)


def _clocked(events: DataFrame, kinds: tuple[str, ...], accounts: int | None) -> DataFrame:
    """Columns all feeds share. The filter comes first, so that it reaches the Parquet scan."""
    account = f"user_id DIV {USERS_PER_ACCOUNT}" if accounts is None else f"user_id % {accounts}"
    micros = f"unix_micros(CAST(ts AS TIMESTAMP)) - {START_MILLIS * 1000}"
    first_lag = """CASE WHEN event_id % 50 = 0 THEN 900
                        WHEN event_id % 50 = 1 THEN 600 - event_id % 11
                        ELSE k % 7 END"""
    return (
        events.where(f"event_type IN ({_quoted(kinds)})")
        .selectExpr(
            "event_id", "value",
            "CAST(get_json_object(props, '$.k') AS BIGINT) AS k",
            f"{START_MILLIS} + ({micros}) DIV {SPEED * 1000} AS timestamp",
            f"concat('ACC-', CAST(1000 + {account} AS STRING)) AS account_id")
        .selectExpr(
            "*",
            f"element_at(array({_quoted(LOCATIONS)}), "
            f"CAST(1 + (event_id * 7 + k) % {len(LOCATIONS)} AS INT)) AS location",
            f"timestamp_millis(timestamp + 1000 * ({first_lag})) AS kafka_timestamp",
            f"timestamp_millis(timestamp + 1000 * ({first_lag} + event_id % 11)) AS proc_time")
    )


def feeds_from_events(events: DataFrame, accounts: int | None = None) -> Feeds:
    """Decoded feeds with broker time and a replay clock (`proc_time`).

    `accounts` folds all users into that many accounts, to make a few very busy ones.
    """
    clocks = ("timestamp", "kafka_timestamp", "proc_time")
    transactions = _clocked(events, TRANSACTION_TYPES, accounts).selectExpr(
        "concat('TX-', CAST(event_id AS STRING)) AS transaction_id", "account_id",
        "round(value * 100) AS amount", "'USD' AS currency", "'TRANSFER' AS transaction_type",
        "'RETAIL' AS merchant_category", "location", "k % 2 = 0 AS is_international", *clocks)
    logins = _clocked(events, LOGIN_TYPES, accounts).selectExpr(
        "account_id", "concat('LG-', CAST(event_id AS STRING)) AS login_id",
        "concat('192.168.1.', CAST(k + 1 AS STRING)) AS ip_address", "location",
        "CASE WHEN k % 2 = 0 THEN 'Mobile' ELSE 'Web' END AS device_type", *clocks)
    activity = _clocked(events, ACTIVITY_TYPES, accounts).selectExpr(
        "account_id",
        "CASE WHEN k % 4 = 0 THEN 'ADDRESS_CHANGE' ELSE 'LIMIT_CHANGE' END AS activity_type",
        "'5000' AS old_value", "'20000' AS new_value", *clocks)
    return Feeds(transactions, logins, activity)
