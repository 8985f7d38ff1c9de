"""Keyed serving rows: one row per key, last write wins."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import islice

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskstream.functions.keys import alert_row_key, high_risk_row_key


def _text(**cells: Column | str) -> list[Column]:
    return [
        (F.col(c) if isinstance(c, str) else c).cast("string").alias(name)
        for name, c in cells.items()
    ]


def alert_cells(alerts: DataFrame, *order: str) -> DataFrame:
    """Row key and text cells of each alert; null stays null. `order` columns pass through."""
    return alerts.select(
        alert_row_key().alias("row_key"), *order,
        *_text(al_type="alert_type", al_reason="reason", tx_id="transaction_id",
               tx_amount="amount", tx_risk="risk_score"),
    )


def high_risk_cells(scored: DataFrame, *order: str, proc_ts: Column | None = None) -> DataFrame:
    """Cells of the high-risk transactions, stamped with the processing time."""
    stamp = F.current_timestamp() if proc_ts is None else proc_ts
    return scored.where("is_high_risk").select(
        high_risk_row_key().alias("row_key"), *order,
        *_text(tx_amount="amount", tx_risk_score="risk_score", tx_location="location",
               tx_is_high_risk=F.lit("true"), tx_proc_ts=stamp),
    )


def latest_by_key(rows: DataFrame, *latest_first: Column, key: str = "row_key") -> DataFrame:
    """The state an upserting store would hold.

    Filtering a row number to 1 lets Spark drop the losers of each key before the shuffle
    (WindowGroupLimit), so a key with very many writes sends one row per map task.
    """
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*latest_first))
    return rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def serving_alerts(alerts: DataFrame, *extra: str) -> DataFrame:
    """One serving row per key: the write of the latest micro-batch, and within one the activity
    alert, which is put after the login alert."""
    order = [name for name in ("emitted_at", "alert_type") if name in alerts.columns]
    cells = alert_cells(alerts, *order, *extra)
    latest_first = {"emitted_at": F.desc_nulls_last, "alert_type": F.asc}
    return latest_by_key(cells, *[latest_first[name](name) for name in order]).drop(*order)


def put_rows(rows: DataFrame, open_store: Callable[[], object], batch_size: int = 200) -> None:
    """Send rows to an external keyed store from the executors.

    `open_store()` runs once per partition and returns an object with `put(list_of_dicts)` and
    `close()`. Puts must be upserts: a retried task sends its rows again. Errors are raised, so
    that Spark retries the task and, in a stream, the micro-batch.
    """
    def send(partition: Iterable) -> None:
        store = None
        try:
            pending = iter(partition)
            while chunk := list(islice(pending, batch_size)):
                store = store or open_store()
                store.put([row.asDict() for row in chunk])
        finally:
            if store is not None:
                store.close()

    rows.foreachPartition(send)
