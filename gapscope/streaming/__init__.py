"""Structured Streaming form of the late-data snapshot."""

from gapscope.streaming.snapshot import latest_per_key, read_snapshot, start_snapshot_stream

__all__ = ["latest_per_key", "read_snapshot", "start_snapshot_stream"]
