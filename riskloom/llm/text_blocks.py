"""Texts of Arrow batches in bounded blocks, and the return of a worker's memory after a task."""

from __future__ import annotations

BLOCK_BYTES = 2_000_000


def text_blocks(batch, column: str, limit: int = BLOCK_BYTES):
    """``(start, texts)`` of consecutive rows (null: empty text); a text beyond ``limit`` bytes is a block of its own."""
    import numpy as np
    import pyarrow.compute as pc

    values = batch.column(column)
    size = pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size, dtype=np.int64)
    at, n, before = 0, len(values), 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield at, [t or "" for t in values.slice(at, end - at).to_pylist()]
        at, before = end, int(ends[end - 1])


def release() -> None:
    """Return what a Python worker no longer uses to the machine; idle workers keep their memory otherwise."""
    import ctypes
    import gc
    import sys

    gc.collect()
    if "pyarrow" in sys.modules:
        sys.modules["pyarrow"].default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def released(run, stores=()):
    """``run`` for mapInArrow; when its task ends, ``stores`` are emptied and memory is returned."""
    def wrapped(batches):
        release()               # what the worker's earlier tasks left
        try:
            yield from run(batches)
        finally:
            for s in stores:
                s.clear()
            release()

    return wrapped
