"""Whole jobs as a stream."""

from vectorferry.streaming.job import migrate_stream, start_stream

__all__ = ["migrate_stream", "start_stream"]
