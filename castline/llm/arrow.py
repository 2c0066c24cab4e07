"""Small pieces for functions that run over Arrow batches on the executors."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def slices(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches of few rows, so that Python holds few texts at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def sized(batches: Iterable[pa.RecordBatch], column: int, rows: int = 2560, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows, cut where the texts of ``column`` reach about ``size`` bytes."""
    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < b.num_rows:
            full = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right"))
            stop = min(max(full, at + 1), at + rows, b.num_rows)
            yield b.slice(at, stop - at)
            at = stop


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
