"""Transaction risk points."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Points for each sign of risk, and the condition that earns them.
RISK_POINTS = (
    ("amount > 10000", 50),
    ("is_international", 30),
    ("location = 'Unknown'", 20),
)


def risk_score() -> Column:
    """0..100. An unknown (null) condition earns nothing, so the score is never null."""
    return F.expr(" + ".join(
        f"CASE WHEN {condition} THEN {points} ELSE 0 END" for condition, points in RISK_POINTS))


def is_high_risk(threshold: int = 50) -> Column:
    return F.col("risk_score") >= F.lit(threshold)
