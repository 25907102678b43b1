"""Groups of rows from a partition that is sorted by its group column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def sorted_groups(batches: Iterator[pa.RecordBatch], key: int = 0) -> Iterator[pa.Table]:
    """Rows of each key of a sorted stream, one key after the other; only one group is held beyond the current batch."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if b.num_rows == 0:
            continue
        k = b.column(key).to_numpy(zero_copy_only=False)
        edges = np.flatnonzero(k[1:] != k[:-1]) + 1
        if held and held[-1].column(key)[-1].as_py() != k[0]:
            yield pa.Table.from_batches(held)
            held = []
        at = 0
        for e in edges.tolist():
            yield pa.Table.from_batches([*held, b.slice(at, e - at)])
            held, at = [], e
        held.append(b.slice(at))
    if held:
        yield pa.Table.from_batches(held)
