"""Structured Streaming form of the period-file load (no other stream operators:
the original jobs are batch only)."""

from veloframe.streaming.ingest import append_periods, read_period_stream

__all__ = ["append_periods", "read_period_stream"]
