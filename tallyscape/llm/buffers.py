"""Texts of an Arrow batch as rows of bytes, a bounded number at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

STRIDE = 1 << 21  # bytes worked on at a time, or one text if that is longer


def slices(column: pa.Array, limit: int = STRIDE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, offsets, bytes) of consecutive rows of a string column; null counts as empty.

    The bytes of row ``first + i`` are ``bytes[offsets[i]:offsets[i + 1]]``.
    """
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, places, data = column.buffers()
    n = len(column)
    if not n:
        return
    ends = np.frombuffer(places, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(ends, ends[first] + limit, "right")) - 1
        last = min(n, max(last, first + 1))
        yield first, ends[first : last + 1] - ends[first], held[ends[first] : ends[last]]
        first = last
