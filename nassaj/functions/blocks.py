"""Arrow arrays of lists, some rows at a time: what a task holds beside its batch stays bounded."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Elements that are worked on together.
ELEMENTS = 1 << 17


def list_lengths(lists: pa.Array) -> np.ndarray:
    """Elements of every row, none for null."""
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy()


def blocks(lists: pa.Array, most: int = ELEMENTS) -> Iterator[tuple[int, int]]:
    """Where rows with at most ``most`` elements begin, and how many there are; a row is never cut. One block at least."""
    ends, first = np.cumsum(list_lengths(lists)), 0
    while True:
        done = ends[first - 1] if first else 0
        last = min(len(lists), max(first + 1, int(np.searchsorted(ends, done + most, "right"))))
        yield first, last - first
        first = last
        if first == len(lists):
            return
