"""Structured Streaming forms of the change gate."""

from tidemark.streaming.refresh import (
    RefreshSink, refresh_batch, start_refresh_stream, stateful_changes,
)

__all__ = ["RefreshSink", "refresh_batch", "start_refresh_stream", "stateful_changes"]
