"""Operational reports over the layers. `as_of` is the report's day; the default is today."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def of_day(df: DataFrame, as_of: str | None) -> DataFrame:
    """On a partitioned layer this prunes directories."""
    day: Column = F.current_date() if as_of is None else F.to_date(F.lit(as_of))
    return df.where(F.col("dt") == day)


def rows() -> Column:
    return F.count(F.lit(1))


def ingest_lag_by_hour(bronze: DataFrame) -> DataFrame:
    return (
        bronze.groupBy("dt", "hr")
        .agg(F.avg("source_to_kafka_lag_sec").alias("avg_network_lag"),
             F.avg("kafka_to_spark_lag_sec").alias("avg_spark_lag"))
        .orderBy(F.desc("dt"), F.desc("hr"))
    )


def fraud_heatmap(alerts: DataFrame, as_of: str | None = None) -> DataFrame:
    """Alerts without a transaction place (the activity rule) form a group of their own."""
    return (
        of_day(alerts, as_of).groupBy("tx_location")
        .agg(rows().alias("alert_count"), F.sum("amount").alias("value_at_risk"))
        .orderBy(F.desc("alert_count"), "tx_location")
    )


def dlq_audit(late: DataFrame) -> DataFrame:
    return late.groupBy("dt").agg(
        rows().alias("late_count"), F.sum("amount").alias("lost_realtime_visibility_amount"))


def top_risk_accounts(alerts: DataFrame, as_of: str | None = None, more_than: int = 2,
                      limit: int | None = None, hours: tuple[int, int] | None = None) -> DataFrame:
    """Accounts by number of alerts; `hours` narrows the day to a closed range of hours."""
    day = of_day(alerts, as_of)
    if hours is not None:
        day = day.where(F.col("hr").between(*hours))
    ranked = (
        day.groupBy("account_id")
        .agg(rows().alias("total_alerts"), F.max("risk_score").alias("peak_score"))
        .where(F.col("total_alerts") > more_than)
        .orderBy(F.desc("total_alerts"), "account_id")
    )
    return ranked if limit is None else ranked.limit(limit)
