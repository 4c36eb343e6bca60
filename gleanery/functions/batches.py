"""Arrow batches in small parts: a batch holds thousands of rows, whose texts as Python objects need not all exist at once."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

ROWS = 256


def values(column: pa.Array, rows: int = ROWS) -> Iterator:
    """A column's values one by one, of which ``rows`` are Python objects at a time."""
    for lo in range(0, len(column), rows):
        yield from column.slice(lo, rows).to_pylist()


def parts(b: pa.RecordBatch, rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    for lo in range(0, b.num_rows, rows):
        yield b.slice(lo, rows)
