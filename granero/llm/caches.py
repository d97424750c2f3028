"""What a Python worker keeps between tasks: one operator's table at a time, so that a chain of them fits in memory.

Memory that tasks have freed stays with the worker's allocators, and idle workers count with their executor while others
work. So task functions of large batches give it back to the machine.
"""

from __future__ import annotations

import ctypes
import functools
import os
from collections.abc import Callable, Hashable, Iterable, Iterator
from typing import Any

import pyarrow as pa

_HELD: dict[Hashable, Any] = {}
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None) if os.name == "posix" else None  # glibc only


def held(key: Hashable, build: Callable[[], Any]) -> Any:
    """The object built for ``key`` in this worker; anything held for another key is let go first."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = build()
    return _HELD[key]


def release() -> None:
    """Let go of whatever another operator has left in this worker."""
    _HELD.clear()
    give_back()


def give_back() -> None:
    """Return what is free inside this worker to the machine: Arrow's pool, and the heap of Python and numpy."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def lean(run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` over a task's batches; when it ends, free memory is given back. What is ``held`` stays."""

    @functools.wraps(run)
    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task
