"""Column contracts of the feeds, the lake layers and the gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    BinaryType, BooleanType, DateType, DoubleType, IntegerType, LongType, StringType, StructField,
    StructType, TimestampType,
)


def struct(**columns) -> StructType:
    return StructType([StructField(name, kind()) for name, kind in columns.items()])


# --- wire feeds: fixed column lists, one per topic ---------------------------------------------
TRANSACTION = struct(
    transaction_id=StringType, account_id=StringType, amount=DoubleType, currency=StringType,
    transaction_type=StringType, merchant_category=StringType, location=StringType,
    timestamp=LongType, is_international=BooleanType,
)
LOGIN = struct(
    account_id=StringType, login_id=StringType, ip_address=StringType, location=StringType,
    device_type=StringType, timestamp=LongType,
)
ACTIVITY = struct(
    account_id=StringType, activity_type=StringType, old_value=StringType, new_value=StringType,
    timestamp=LongType,
)

# --- columns the pipeline adds -----------------------------------------------------------------
ARRIVAL = struct(kafka_timestamp=TimestampType, event_time=TimestampType)
LAGS = struct(
    spark_proc_time=TimestampType, source_to_kafka_lag_sec=LongType,
    kafka_to_spark_lag_sec=LongType, total_latency_sec=LongType,
)
SCORE = struct(risk_score=IntegerType, is_high_risk=BooleanType)
DEAD_LETTER = struct(dlq_reason=StringType)
ALERT = struct(
    account_id=StringType, event_time=TimestampType, transaction_id=StringType, amount=DoubleType,
    risk_score=IntegerType, alert_type=StringType, reason=StringType, tx_location=StringType,
    login_location=StringType, ip_address=StringType, device_type=StringType, login_id=StringType,
    activity_type=StringType, old_value=StringType, new_value=StringType,
    emitted_at=TimestampType,  # the micro-batch that raised it; null in alerts made from history
)
BAD_FRAME = struct(
    topic=StringType, value=BinaryType, kafka_timestamp=TimestampType, schema_id=LongType,
    dlq_reason=StringType,
)
RAW = struct(value=BinaryType, kafka_timestamp=TimestampType)

# Directory levels of every streamed layer. `batch_id` names the write that made the leaf, so a
# repeated micro-batch replaces its own leaf; compaction folds an hour into one leaf.
PARTITIONS = struct(dt=DateType, hr=IntegerType, batch_id=StringType)

# Counts are BIGINT: a day at scale has more rows than an INT holds.
GOLD_LOCATION_RISK = struct(
    location=StringType, alert_count=LongType, total_fraud_amount=DoubleType,
    avg_risk_score=DoubleType,
)
GOLD_DAILY_KPI = struct(
    total_transactions=LongType, total_alerts=LongType, fraud_percentage=DoubleType,
    high_risk_volume=DoubleType,
)

SERVING_ALERTS = struct(
    row_key=StringType, al_type=StringType, al_reason=StringType, tx_id=StringType,
    tx_amount=StringType, tx_risk=StringType,
)
SERVING_HIGH_RISK = struct(
    row_key=StringType, tx_amount=StringType, tx_risk_score=StringType, tx_location=StringType,
    tx_is_high_risk=StringType, tx_proc_ts=StringType,
)


def merge(*parts: StructType) -> StructType:
    return StructType([field for part in parts for field in part.fields])


def ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project to a contract: declared order and types, absent columns as typed nulls."""
    present = set(df.columns)
    return df.selectExpr(*[
        f"CAST({f'`{f.name}`' if f.name in present else 'NULL'} AS {f.dataType.simpleString()}) AS `{f.name}`"
        for f in schema.fields
    ])
