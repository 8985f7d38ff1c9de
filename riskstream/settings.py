"""One frozen settings object; every path follows from the lake root."""

from __future__ import annotations

import re
from dataclasses import dataclass, fields
from datetime import timedelta

DURATIONS = ("watermark_delay", "late_allowance", "future_allowance", "idle_allowance", "login_tx_window", "activity_tx_window")


def seconds(duration: str | timedelta) -> int:
    """Seconds of '10 minutes', '1 hour', timedelta(...), ...; a part of a second is refused, not cut off."""
    if isinstance(duration, str):
        found = re.fullmatch(r"\s*(\d+)\s*(millisecond|second|minute|hour|day|week)s?\s*", duration)
        if not found:
            raise ValueError(f"no duration: {duration!r}")
        duration = timedelta(**{f"{found[2]}s": int(found[1])})
    if duration.microseconds or duration < timedelta(0):
        raise ValueError(f"a duration must be of whole seconds: {duration}")
    return duration // timedelta(seconds=1)


@dataclass(frozen=True)
class Settings:
    root: str
    database: str = "default"

    # Feeds
    bootstrap: str = "localhost:9092"
    topic_tx: str = "banking_transactions"
    topic_logins: str = "user_logins"
    topic_activity: str = "account_activity"
    starting_offsets: str = "latest"
    max_offsets_per_trigger: int = 0          # 0: no cap
    fail_on_data_loss: bool = False           # True: the three-topic job stops when offsets are lost

    # Clocks
    trigger_interval: str = "5 seconds"
    watermark_delay: str = "10 minutes"
    late_allowance: str = "10 minutes"
    future_allowance: str | None = "10 minutes"     # events further ahead of the clock are dead letters; None: no bound
    idle_allowance: str = "1 hour"            # after which an hour counts as complete though no later batch came
    login_tx_window: str = "1 minute"
    activity_tx_window: str = "5 minutes"

    # Scoring
    high_risk_threshold: int = 50

    # Layout and parallelism
    state_partitions: int | None = None       # None: the session's spark.sql.shuffle.partitions
    rows_per_file: int = 2_000_000
    file_bytes: int = 256 * 1024 * 1024
    put_batch: int = 200

    # An account with at least this share of the transactions is joined in `hot_salts` parts.
    # At most 1 / hot_share accounts can qualify, which bounds the list.
    hot_share: float = 0.01
    hot_salts: int = 16
    hot_hours: int = 6                        # of the lake, latest first, in which accounts are measured

    def layer(self, name: str) -> str:
        return f"{self.root}/{name}"

    def checkpoint(self, query: str) -> str:
        return f"{self.root}/_checkpoints/{query}"

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"

    @classmethod
    def parsed(cls, text: str) -> tuple[str, object]:
        """(name, value) of `name=value`, the value of the field's own type; `none` where a field may be None."""
        name, given, value = text.partition("=")
        field = next((f for f in fields(cls) if f.name == name), None)
        if field is None or not given:
            raise ValueError(f"no setting: {text!r}")
        kind, _, optional = str(field.type).partition(" | ")
        if optional and value.lower() == "none":
            return name, None
        if kind == "bool":
            if value.lower() not in ("true", "false"):
                raise ValueError(f"{name}: neither true nor false: {value!r}")
            return name, value.lower() == "true"
        if name in DURATIONS:
            seconds(value)
        return name, {"int": int, "float": float, "str": str}[kind](value)

    @classmethod
    def small_box(cls, root: str, **changes) -> Settings:
        """The throttled profile for a single 3-core worker."""
        return cls(root, **{"max_offsets_per_trigger": 3000, "state_partitions": 12, **changes})
