"""Account-risk monitoring on event streams: a layered lake built from Spark DataFrames."""

from riskstream.settings import Settings

__all__ = ["Settings"]
