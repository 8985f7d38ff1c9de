"""From the three decoded feeds to every layer of the lake. Batch and streaming use the same plan."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, functions as F

from riskstream.operators.alerts import activity_then_tx, login_then_tx
from riskstream.operators.interval_join import HotSpan
from riskstream.operators.lateness import mark_on_time
from riskstream.operators.routes import ROUTES, tag_feed, tagged, union_aligned
from riskstream.operators.scoring import score_transactions
from riskstream.schemas import SCORE
from riskstream.settings import Settings
from riskstream.sources.events import Feeds


FEED_TAGS = (
    ("transactions", ("BRONZE_TX", "SILVER_TX"), "LATE_TX"),
    ("logins", ("BRONZE_LOGIN",), "LATE_LOGIN"),
    ("activity", ("BRONZE_ACTIVITY",), "LATE_ACTIVITY"),
)


@dataclass(frozen=True)
class Layers:
    """Feeds with lag columns, `on_time` and (transactions) the score, plus both alert rules.

    `feeds` carry `event_time`, and `frame_error` when they come from raw messages. `proc_time` names a replay clock; the default is the wall clock.
    Every layer is planned when it is first asked for.
    """
    feeds: Feeds
    settings: Settings
    proc_time: Column | str | None = None
    hot: Sequence[str | HotSpan] = ()

    def _marked(self, df: DataFrame) -> DataFrame:
        df = mark_on_time(df, self.settings.late_allowance, self.proc_time, self.settings.future_allowance)
        if "frame_error" in df.columns:
            df = df.withColumns({
                "on_time": F.expr("on_time AND frame_error IS NULL"),
                "dlq_reason": F.coalesce("frame_error", "dlq_reason"),
            })
        return df.drop(self.proc_time) if isinstance(self.proc_time, str) else df

    @cached_property
    def transactions(self) -> DataFrame:
        return score_transactions(
            self._marked(self.feeds.transactions), self.settings.high_risk_threshold)

    @cached_property
    def logins(self) -> DataFrame:
        return self._marked(self.feeds.logins)

    @cached_property
    def activity(self) -> DataFrame:
        return self._marked(self.feeds.activity)

    def _joined(self, rule: Callable[..., DataFrame], triggers: DataFrame, window: str) -> DataFrame:
        streaming = self.feeds.transactions.isStreaming
        return rule(
            self.on_time(self.transactions), self.on_time(triggers), window,
            watermark=self.settings.watermark_delay if streaming else None,
            hot=self.hot, hot_parts=self.settings.hot_salts)

    @cached_property
    def login_alerts(self) -> DataFrame:
        return self._joined(login_then_tx, self.logins, self.settings.login_tx_window)

    @cached_property
    def activity_alerts(self) -> DataFrame:
        return self._joined(activity_then_tx, self.activity, self.settings.activity_tx_window)

    @staticmethod
    def on_time(df: DataFrame) -> DataFrame:
        return df.where("on_time").drop("on_time", "dlq_reason")

    @staticmethod
    def late(df: DataFrame) -> DataFrame:
        return df.where("NOT on_time").drop("on_time")

    @property
    def silver(self) -> DataFrame:
        return self.on_time(self.transactions)

    @property
    def alerts(self) -> DataFrame:
        return self.login_alerts.unionByName(self.activity_alerts, allowMissingColumns=True)


def unify(layers: Layers, only: Iterable[str] = tuple(ROUTES)) -> DataFrame:
    """Tagged union of the routes in `only` (default: all of them).

    Each feed is scanned once for its bronze, silver and dead-letter routes (bad frames included),
    and once more per alert rule that reads it. Leaving routes out leaves out their scans, so that the stateless
    layers and the alerts can run as two queries with a checkpoint each.
    """
    only = set(only)
    branches = []
    for name, on_time, late in FEED_TAGS:
        if only & {"BAD_FRAME", late, *on_time}:
            branch = tag_feed(getattr(layers, name), on_time, late)
            # Only silver is scored.
            branches.append(branch.withColumns({
                c: F.when(F.col("_type") == "SILVER_TX", F.col(c)) for c in SCORE.names if c in branch.columns}))
    if "ALERT" in only:
        for alerts in (layers.login_alerts, layers.activity_alerts):
            if alerts.isStreaming:
                alerts = alerts.withColumn("emitted_at", F.current_timestamp())
            branches.append(tagged(alerts, "ALERT"))
    return union_aligned(branches).where(F.col("_type").isin(*sorted(only)))
