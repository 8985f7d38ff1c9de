"""On-time and late sides of a feed: processing time minus event time against an allowance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from riskstream.functions.clock import add_lags
from riskstream.settings import seconds


def mark_on_time(df: DataFrame, allowance: str = "10 minutes",
                 proc_time: Column | str | None = None, ahead: str | None = None) -> DataFrame:
    """Adds the lag columns, `on_time` (never null) and `dlq_reason` (null for on-time rows).

    The bound is inclusive and compares microseconds, not the truncated lag columns. A row without
    an event time is not on time: it goes to the dead letters instead of vanishing. So does one that lies more than `ahead` in the
    future (None: no bound): one such event in each feed would move a stream's watermark there, and all on-time rows would miss the joins.
    """
    oldest = f"spark_proc_time - INTERVAL '{seconds(allowance)}' SECOND"
    early = "false" if ahead is None else f"event_time > spark_proc_time + INTERVAL '{seconds(ahead)}' SECOND"
    return add_lags(df, proc_time).selectExpr(
        "*", f"coalesce(event_time >= {oldest} AND NOT ({early}), false) AS on_time"
    ).selectExpr(
        "*", "CASE WHEN on_time THEN NULL WHEN event_time IS NULL THEN 'no event time' "
             f"WHEN {early} THEN 'from the future' ELSE 'late' END AS dlq_reason")


def split_late(df: DataFrame, allowance: str = "10 minutes",
               proc_time: Column | str | None = None) -> tuple[DataFrame, DataFrame]:
    marked = mark_on_time(df, allowance, proc_time)
    on_time = marked.where("on_time").drop("on_time", "dlq_reason")
    late = marked.where("NOT on_time").drop("on_time")
    return on_time, late
