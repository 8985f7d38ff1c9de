"""Keyed serving tables in Parquet, for readers without the external store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskstream.operators.keyed import high_risk_cells, latest_by_key, serving_alerts
from riskstream.plans.gold import overwrite_day
from riskstream.plans.reports import of_day
from riskstream.settings import Settings


def serving_high_risk(scored: DataFrame, *extra: str) -> DataFrame:
    """One row per account and time, the last write: the latest batch, and within one the highest id."""
    order = list(dict.fromkeys(["spark_proc_time", "transaction_id", *extra]))
    cells = high_risk_cells(scored, *order, proc_ts=F.col("spark_proc_time"))
    latest = latest_by_key(cells, F.desc_nulls_last("spark_proc_time"), F.desc("transaction_id"))
    return latest.drop(*(name for name in order if name not in extra))


def load_serving(spark: SparkSession, settings: Settings, day: str) -> None:
    """Replace the day in both serving tables.

    A row key holds the event time, so all writes of a key lie in one day and rebuilding the day
    from the silver tables gives what upserting every write would give.
    """
    alerts = of_day(spark.table(settings.table("silver_fraud_alerts")), day)
    scored = of_day(spark.table(settings.table("silver_transactions")), day)
    overwrite_day(spark, settings.table("serving_alerts"), day, serving_alerts(alerts))
    overwrite_day(spark, settings.table("serving_high_risk"), day, serving_high_risk(scored))
