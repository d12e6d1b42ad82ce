"""Incremental loading with Structured Streaming."""

from tremor.streaming.incremental import landing_stream, load_incremental

__all__ = ["landing_stream", "load_incremental"]
