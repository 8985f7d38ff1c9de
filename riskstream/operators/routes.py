"""Route tags, the aligned union of all routes, and the contract of each route."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from riskstream import schemas
from riskstream.functions.clock import add_dt_hr


@dataclass(frozen=True)
class Route:
    """Where the rows of one tag go. `spread_by` names the columns that tell rows apart."""
    layer: str
    schema: StructType
    spread_by: tuple[str, ...]

    @property
    def stored(self) -> StructType:
        return schemas.merge(self.schema, schemas.PARTITIONS)


def _tx(*more: StructType) -> StructType:
    return schemas.merge(schemas.TRANSACTION, schemas.ARRIVAL, schemas.LAGS, *more)


_TX_ROW, _LOGIN_ROW = ("transaction_id", "timestamp"), ("login_id", "timestamp")
_ACTIVITY_ROW = ("account_id", "timestamp", "kafka_timestamp", "activity_type")
_LOGIN = schemas.merge(schemas.LOGIN, schemas.ARRIVAL, schemas.LAGS)
_ACTIVITY = schemas.merge(schemas.ACTIVITY, schemas.ARRIVAL, schemas.LAGS)

ROUTES = {
    "BRONZE_TX": Route("bronze/transactions", _tx(), _TX_ROW),
    "BRONZE_LOGIN": Route("bronze/logins", _LOGIN, _LOGIN_ROW),
    "BRONZE_ACTIVITY": Route("bronze/activity", _ACTIVITY, _ACTIVITY_ROW),
    "SILVER_TX": Route("silver/transactions", _tx(schemas.SCORE), _TX_ROW),
    "ALERT": Route("silver/fraud_alerts", schemas.ALERT,
                   ("transaction_id", "alert_type", "login_id", "event_time")),
    "LATE_TX": Route("dlq/transactions", _tx(schemas.DEAD_LETTER), _TX_ROW),
    "LATE_LOGIN": Route("dlq/logins", schemas.merge(_LOGIN, schemas.DEAD_LETTER), _LOGIN_ROW),
    "LATE_ACTIVITY": Route("dlq/activity", schemas.merge(_ACTIVITY, schemas.DEAD_LETTER), _ACTIVITY_ROW),
    "BAD_FRAME": Route("dlq/frames", schemas.BAD_FRAME, ("value", "kafka_timestamp")),
}


def tagged(df: DataFrame, tag: str) -> DataFrame:
    return add_dt_hr(df).withColumn("_type", F.lit(tag))


def tag_feed(marked: DataFrame, on_time_tags: Sequence[str], late_tag: str) -> DataFrame:
    """Tag all sides of a feed in one pass.

    A row that has several routes is repeated after the scan; filtering the feed once per route
    would read and decode its source once per route. Bad frames are filed by their arrival time.
    """
    on_time = ", ".join(f"'{tag}'" for tag in on_time_tags)
    tags = f"CASE WHEN on_time THEN array({on_time}) ELSE array('{late_tag}') END"
    time = "event_time"
    if "frame_error" in marked.columns:
        tags = f"CASE WHEN frame_error IS NOT NULL THEN array('BAD_FRAME') ELSE {tags} END"
        time = F.expr("CASE WHEN frame_error IS NOT NULL THEN kafka_timestamp ELSE event_time END")
    return add_dt_hr(marked, time).withColumn("_type", F.explode(F.expr(tags))).drop("on_time", "frame_error")


def union_aligned(frames: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL by name; absent columns become nulls and columns are in alphabetical order."""
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return union.select(*sorted(union.columns))


def route_counts(unified: DataFrame) -> DataFrame:
    return unified.groupBy("_type").agg(F.count(F.lit(1)).alias("row_count"))
