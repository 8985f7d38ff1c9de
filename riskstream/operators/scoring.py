from __future__ import annotations

from pyspark.sql import DataFrame

from riskstream.functions.risk import is_high_risk, risk_score


def score_transactions(tx: DataFrame, threshold: int = 50) -> DataFrame:
    return tx.withColumn("risk_score", risk_score()).withColumn("is_high_risk", is_high_risk(threshold))
