"""Inner join of events that follow a trigger on the same key within a time window."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from riskstream.settings import seconds

CELL, PART = "_cell", "_part"


class HotSpan(NamedTuple):
    """A key that is split in parts for some time only. Both ends are microseconds up to which a stream may hold rows of
    the key as state; `until` None: from then on."""
    key: str
    since: int
    until: int | None = None

    def cells(self, width: int) -> tuple[int, int | None]:
        """The first cell that no such state touches, and that at which the span ends. A trigger reaches a window ahead."""
        first, after = ((at + width) // width + 1 if at is not None else None for at in (self.since, self.until))
        return first, after


def interval_join(events: DataFrame, triggers: DataFrame, key: str, window: str, *,
                  time: str = "event_time", watermark: str | None = None,
                  cells: bool = True, hot: Sequence[str | HotSpan] = (), hot_parts: int = 16,
                  spread_by: str | None = None) -> DataFrame:
    """Pairs with `trigger.time <= event.time <= trigger.time + window`, both ends included.

    The result keeps both sides under the aliases `e` and `g`; a pair appears exactly once.

    cells      Time is cut into cells as wide as the window. An event lies in one cell and a
               trigger's window touches two, so joining on (key, cell) meets every pair once,
               compares an event with two windows' worth of triggers instead of the key's whole
               history, and spreads a key that holds much of the data over all its cells. What is
               left of skew (a burst inside one cell) is an equi-join partition that adaptive skew
               handling can split, because the join is inner. In a stream the second copy of each
               trigger is the price for the same gains; the copies of events are never needed.
    watermark  Streaming: both sides are watermarked and Spark derives the state bound from the
               time range, which stays part of the condition.
    hot        Keys known to hold a large share of the events. Their events are split by a hash of
               `spread_by` into `hot_parts` parts and only their triggers are copied to each part. Parts follow from
               (key, cell), alike on both sides, so a stream may get further spans with every restart: a
               span begins in a cell of which no state is held yet. A stream's state therefore has the part
               among its keys even while the list is empty.
    """
    if watermark is not None:
        events = events.withWatermark(time, watermark)
        triggers = triggers.withWatermark(time, watermark)

    if seconds(window) == 0:
        raise ValueError("a window of no length")
    span = f"INTERVAL '{seconds(window)}' SECOND"
    keys = [key]
    if cells:
        width = seconds(window) * 1_000_000
        first, last = (f"unix_micros({at}) DIV {width}" for at in (time, f"{time} + {span}"))
        events = events.selectExpr("*", f"{first} AS {CELL}")
        triggers = triggers.selectExpr("*", f"explode(sequence({first}, {last})) AS {CELL}")
        keys.append(CELL)
    spans = [x for x in hot if isinstance(x, HotSpan)]
    if spans and not cells:
        raise ValueError("a span of a hot key needs cells")
    if hot or (watermark is not None and spread_by is not None):
        if spread_by is None:
            raise ValueError("splitting hot keys needs `spread_by`, a column that varies within a key")
        is_hot = _is_hot(key, [x for x in hot if not isinstance(x, HotSpan)], spans, seconds(window) * 1_000_000)
        events = events.withColumn(
            PART, F.when(is_hot, F.pmod(F.xxhash64(spread_by), F.lit(hot_parts))).otherwise(F.lit(0)).cast("bigint"))
        last = F.when(is_hot, F.lit(hot_parts - 1)).otherwise(F.lit(0)).cast("bigint")
        triggers = triggers.withColumn(PART, F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
        keys.append(PART)

    same = [f"e.{name} = g.{name}" for name in keys]
    follows = f"e.{time} BETWEEN g.{time} AND g.{time} + {span}"
    return events.alias("e").join(triggers.alias("g"), F.expr(" AND ".join([*same, follows])), "inner")


def _is_hot(key: str, always: Sequence[str], spans: Sequence[HotSpan], width: int) -> Column:
    """Never null, and never a constant, which Spark would take out of the join's keys and so out of a stream's state.
    Keys are looked up in a literal set before any span is compared."""
    is_hot = F.col(key).isin(*(always or [""]))
    if spans:
        def within(span: HotSpan) -> Column:
            first, after = span.cells(width)
            begun = (F.col(key) == span.key) & (F.col(CELL) >= first)
            return begun if after is None else begun & (F.col(CELL) < after)

        listed = F.col(key).isin(*{span.key for span in spans})
        is_hot = is_hot | (listed & reduce(or_, map(within, spans)))
    return F.coalesce(is_hot, F.lit(False))


def hot_keys(df: DataFrame, key: str, share: float) -> list[str]:
    """Keys that hold at least `share` of the rows.

    At most 1 / share keys can, so the list is bounded whatever the size of the data. Counting is
    pre-aggregated on the map side and reads only the key column.
    """
    least = df.count() * share
    counts = df.where(F.col(key).isNotNull()).groupBy(key).count()
    return sorted(row[0] for row in counts.where(F.col("count") >= F.lit(least)).select(key).collect())
