"""Time columns. All of them are JVM expressions and work on batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def add_event_time(df: DataFrame) -> DataFrame:
    """`timestamp` holds epoch milliseconds."""
    return df.withColumn("event_time", F.timestamp_millis("timestamp"))


def add_dt_hr(df: DataFrame, time: Column | str = "event_time") -> DataFrame:
    """Partition columns; `hr` is an INT, so directories read hr=7 and never hr=07."""
    return df.withColumns({"dt": F.to_date(time), "hr": F.hour(time)})


def add_lags(df: DataFrame, proc_time: Column | str | None = None) -> DataFrame:
    """Processing clock and the three whole-second lags.

    `proc_time` replaces the wall clock in replays of old data. In a stream the default is one
    value per micro-batch, so the on-time and late sides split exactly.
    """
    clock = F.current_timestamp() if proc_time is None else proc_time
    clock = F.col(clock) if isinstance(clock, str) else clock
    return df.withColumn("spark_proc_time", clock).selectExpr(
        "*",
        "unix_timestamp(kafka_timestamp) - unix_timestamp(event_time) AS source_to_kafka_lag_sec",
        "unix_timestamp(spark_proc_time) - unix_timestamp(kafka_timestamp) AS kafka_to_spark_lag_sec",
        "unix_timestamp(spark_proc_time) - unix_timestamp(event_time) AS total_latency_sec")
