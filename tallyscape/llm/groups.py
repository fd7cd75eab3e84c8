"""Runs of equal keys in sorted Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each key, from batches in which equal keys are neighbours."""
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        keys = held.column(key).combine_chunks()
        if len(keys) < 2:
            continue
        steps = np.flatnonzero(pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)) + 1
        start = 0
        for end in steps.tolist():
            yield held.slice(start, end - start)
            start = end
        held = held.slice(start)
    if held is not None and held.num_rows:
        yield held


def lowest(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links the first row it reaches."""
    n = len(linked)
    label = np.arange(n)
    while True:
        near = np.where(linked, label[None, :], n).min(1, initial=n)
        new = np.minimum(label, near)
        new = new[new]
        if (new == label).all():
            return label
        label = new
