"""Incremental Bronze loads with Structured Streaming."""

from starlode.streaming.landing_stream import run_bronze_new_files, stream_bronze

__all__ = ["run_bronze_new_files", "stream_bronze"]
