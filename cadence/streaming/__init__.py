"""Incremental loads of landed payload files with Structured Streaming."""

from cadence.streaming.incremental import start_macro_stream, start_market_stream  # noqa: F401
