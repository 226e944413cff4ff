"""Helpers for functions over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def text_runs(batch: pa.RecordBatch, limit: int, text: int = 1) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The batch in runs of rows of at most ``limit`` bytes of text, unless one text alone is longer.

    Yields the first row, the run's bytes (UTF-8, one text after the other; null as empty) and the
    offsets of its texts in them, one more than it has rows.
    """
    col = batch.column(text).cast(pa.large_binary())
    if not len(col):
        return
    col = pa.concat_arrays([col.fill_null(b"")])
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    a = 0
    while a < len(col):
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(max(b, a + 1), len(col))
        yield a, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


def slices(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary array of ``buf[starts[i]:ends[i]]``; the spans are in order and don't overlap."""
    if not len(starts):
        return pa.array([], pa.large_binary())
    # Spans and the gaps between them as one array without copying; every second entry is a span.
    edges = np.empty(2 * len(starts) + 1, np.int64)
    edges[0:-1:2], edges[1::2], edges[-1] = starts, ends, ends[-1]
    whole = pa.Array.from_buffers(pa.large_binary(), 2 * len(starts), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(buf))])
    return whole.take(pa.array(np.arange(0, 2 * len(starts), 2)))
