"""Bounds on a Python worker's memory: batches cut by their text, and one operator's tables kept at a time."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def by_bytes(batch: pa.RecordBatch, column: str, size: int) -> Iterator[pa.RecordBatch]:
    """Consecutive parts with about ``size`` bytes of text each; one longer text may be a part of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = (np.cumsum(sizes, dtype=np.int64) - sizes) // size  # a text belongs where its first byte lies
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(sizes)]
    for begin, end in zip(cuts, cuts[1:], strict=False):
        if end > begin:
            yield batch.slice(begin, end - begin)


def trim() -> None:
    """Gives freed memory of this Python worker back, at a task's end; workers live on between tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):  # glibc keeps what lies below its newest block
        libc.malloc_trim(0)


def kept(operator: str) -> dict:
    """What this Python worker keeps between tasks for ``operator``; what it kept for another one is let go.

    Workers serve tasks of all operators in turn and would otherwise hold the tables of each that ran before.
    """
    tables = sys.modules.setdefault("_ledgerlens_kept", ModuleType("_ledgerlens_kept")).__dict__.setdefault("tables", {})
    if tables.keys() - {operator}:
        tables.clear()
        trim()
    return tables.setdefault(operator, {})
