"""The 5-byte frame in front of every message body: a zero magic byte and a schema id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values of the wire format.
MAGIC = 0
HEADER_BYTES = 5


def usable_frame() -> Column:
    """A known magic byte, a schema id and at least one byte of body."""
    return F.expr(f"coalesce(length(value), 0) > {HEADER_BYTES} AND startswith(value, X'{MAGIC:02X}')")


def frame_columns(raw: DataFrame) -> DataFrame:
    """Adds `magic`, `schema_id` (big endian), `body`, and `frame_error` for unusable frames."""
    def number(start: int, count: int) -> str:
        return (f"CASE WHEN length(value) >= {HEADER_BYTES} "
                f"THEN CAST(conv(hex(substring(value, {start}, {count})), 16, 10) AS BIGINT) END")

    return raw.selectExpr(
        "*", f"{number(1, 1)} AS magic", f"{number(2, 4)} AS schema_id",
        f"substring(value, {HEADER_BYTES + 1}) AS body",
        f"""CASE WHEN coalesce(length(value), 0) <= {HEADER_BYTES} THEN 'frame without body'
                 WHEN NOT startswith(value, X'{MAGIC:02X}') THEN 'unknown magic byte' END AS frame_error""")


def to_frame(body: Column, schema_id: int) -> Column:
    """Frame a body the way the producers do (used to replay history as raw messages)."""
    header = bytes([MAGIC]) + schema_id.to_bytes(HEADER_BYTES - 1, "big")
    return F.concat(F.lit(header), body.cast("binary"))
