"""Giving memory back between tasks.

Python workers outlive their tasks, and what the allocators keep for the next one adds up over the stages of a
pipeline. These wrappers return it to the system when a partition or a group is done.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa


@cache
def _trim() -> Callable[[int], int] | None:
    """glibc's malloc_trim, where there is one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    pa.default_memory_pool().release_unused()
    trim = _trim()
    if trim:
        trim(0)


def streaming(rows):
    """For mapInArrow."""

    def run(batches: Iterator[pa.RecordBatch]):
        yield from rows(batches)
        release()

    return run


def grouped(rows):
    """For applyInArrow of a group."""

    def run(table):
        result = rows(table)
        release()
        return result

    return run


def cogrouped(rows):
    """For applyInArrow of two groups."""

    def run(left, right):
        result = rows(left, right)
        release()
        return result

    return run
