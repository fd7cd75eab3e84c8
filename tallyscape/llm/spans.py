"""Sets of intervals."""

from __future__ import annotations

import numpy as np


def covered(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of n places lie in some interval."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, start, 1)
    np.add.at(step, end, -1)
    return np.cumsum(step[:n]) > 0


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the maximal runs of True."""
    step = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)
