"""Memory of Python workers."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator
from functools import wraps

import pyarrow as pa

Batches = Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def tidy(work: Batches) -> Batches:
    """The same function over batches, which gives back what it has freed when its task ends.

    Spark keeps workers for later tasks, and the allocators of Python and Arrow keep what was freed for
    the next one; a worker that has counted or compared much would hold that beside all that follows.
    """

    @wraps(work)
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim is not None:
            trim(0)

    return run
