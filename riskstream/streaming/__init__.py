from riskstream.streaming.jobs import (
    rows_dropped_by_watermark, run_dual_write_stream, run_stream,
    start_dual_write, start_router, stream_session,
)
from riskstream.streaming.history import replay, stage_slice, topic_streams
from riskstream.streaming.router import dual_write_router, foreach_batch_router

__all__ = [
    "dual_write_router", "foreach_batch_router", "replay",
    "rows_dropped_by_watermark", "run_dual_write_stream", "run_stream", "stage_slice", "start_dual_write", "start_router",
    "stream_session", "topic_streams",
]
