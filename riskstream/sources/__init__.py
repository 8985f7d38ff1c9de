from riskstream.sources.events import Feeds, feeds_from_events
from riskstream.sources.feeds import CONTRACTS, Contract, Version, bad_frames, decode_feed, ingest, ingest_topic
from riskstream.sources.files import read_hours, stream_files
from riskstream.sources.kafka import kafka_options, read_kafka

__all__ = [
    "CONTRACTS", "Contract", "Feeds", "Version", "bad_frames", "decode_feed", "feeds_from_events", "ingest",
    "ingest_topic", "kafka_options", "read_hours", "read_kafka", "stream_files",
]
