"""The predict jobs (anomalies, segments) applied to each micro-batch of a stream."""

from rarebird.streaming.scoring import (
    file_stream,
    score_stream,
    segment_stream,
    start_scoring,
    start_segment_scoring,
    stream_shares,
)

__all__ = ["file_stream", "score_stream", "segment_stream", "start_scoring", "start_segment_scoring", "stream_shares"]
