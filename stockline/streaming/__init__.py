"""Structured Streaming re-aim of the scheduled snapshot cycle."""

from .cycle import start_stream_cycle, stream_cycle

__all__ = ["start_stream_cycle", "stream_cycle"]
