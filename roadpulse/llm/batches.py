"""Arrow batches inside tasks: bounded slices, columns, and an output schema for them."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_CHARS = 4_000_000


def slices(batch: pa.RecordBatch, column: str, chars: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows holding about `chars` bytes of a text column.

    A single longer text makes a slice of its own. Only the work held in memory
    at once depends on the cut, never the result.
    """
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    piece = np.cumsum(sizes + 1) // chars
    cuts = np.flatnonzero(np.diff(piece)) + 1
    for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
        yield batch.slice(start, end - start)


#: What empties the caches that are large and of use to one kind of task only.
CACHES: list[Callable[[], None]] = []


def released(run: Callable, keeps: bool = False) -> Callable:
    """`run` over batches, after which the task gives what it freed back to the system.

    Workers are used by one task after the other, so what they keep adds up with the rest of an executor.
    Before, `CACHES` that earlier tasks filled are emptied, unless the task `keeps` them.
    """
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            for clear in CACHES:
                clear()
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)
    return whole


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column in one buffer, and len + 1 offsets into it; NULL counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    buffer = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buffer[offsets[0]:offsets[-1]], offsets - offsets[0]


def binaries(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary column cut out of one buffer at byte offsets, without a copy per row."""
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [
        None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)),
        pa.py_buffer(np.ascontiguousarray(data).view(np.uint8))]).cast(pa.binary())


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of every run, one run after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
