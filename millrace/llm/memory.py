"""Memory of worker processes that Spark uses again."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa


def release_memory() -> None:
    """Give back what earlier tasks of a reused worker process left behind: objects, Arrow's pool, the allocator's free pages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)
