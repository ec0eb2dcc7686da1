"""Incremental jobs on file-source streams."""

from millrace.streaming.incremental import append_increments, read_increments, run_available

__all__ = ["append_increments", "read_increments", "run_available"]
