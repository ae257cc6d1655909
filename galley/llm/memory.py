"""Memory of Python workers, which Spark keeps for later tasks."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa

_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def hand_back() -> None:
    """Return freed memory to the system, so that an idle worker holds little."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def tidied(run: Callable[[Iterable], Iterator]) -> Callable[[Iterable], Iterator]:
    """``run``, with freed memory handed back when its task ends."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            hand_back()

    return wrapped
