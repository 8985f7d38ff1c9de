"""Daily gold aggregates and their idempotent load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskstream import schemas
from riskstream.plans.reports import of_day, rows
from riskstream.schemas import conform
from riskstream.settings import Settings


def location_risk(alerts: DataFrame, day: str | None) -> DataFrame:
    summary = of_day(alerts, day).groupBy(F.col("tx_location").alias("location")).agg(
        rows().alias("alert_count"), F.sum("amount").alias("total_fraud_amount"),
        F.avg("risk_score").alias("avg_risk_score"))
    return conform(summary, schemas.GOLD_LOCATION_RISK)


def _kpi(scored: DataFrame, day: str | None, risky: Column) -> DataFrame:
    """One row, also for a day without transactions (0 and nulls)."""
    flagged = F.sum(risky.cast("int"))
    summary = of_day(scored, day).agg(
        rows().alias("total_transactions"), flagged.alias("total_alerts"),
        (flagged / rows() * 100).alias("fraud_percentage"),
        F.sum(F.when(risky, F.col("amount")).otherwise(F.lit(0.0))).alias("high_risk_volume"))
    return conform(summary, schemas.GOLD_DAILY_KPI)


def daily_kpi(scored: DataFrame, day: str | None, threshold: int = 50) -> DataFrame:
    """From the score; reads the scored (silver) transactions."""
    return _kpi(scored, day, F.coalesce(F.col("risk_score") >= threshold, F.lit(False)))


def daily_kpi_by_flag(scored: DataFrame, day: str | None) -> DataFrame:
    """From the stored flag; equals daily_kpi at the threshold the flag was made with."""
    return _kpi(scored, day, F.col("is_high_risk"))


def load_gold(spark: SparkSession, settings: Settings, day: str) -> None:
    """Replace the day's partition in both gold tables from the silver tables."""
    loads = {
        "gold_location_risk": location_risk(
            spark.table(settings.table("silver_fraud_alerts")), day),
        "gold_daily_kpi_report": daily_kpi_by_flag(
            spark.table(settings.table("silver_transactions")), day),
    }
    for table, summary in loads.items():
        overwrite_day(spark, settings.table(table), day, summary)


def overwrite_day(spark: SparkSession, table: str, day: str, summary: DataFrame) -> None:
    columns = ", ".join(f"`{c}`" for c in summary.columns)
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION (dt = DATE'{day}') SELECT {columns} FROM {{src}}",
        src=summary)
