"""Record batches cut to a bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def slices(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes in ``column``, one row at least."""
    lengths = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
    part = (np.cumsum(lengths, dtype=np.int64) - lengths) // most
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield batch.slice(a, b - a)
