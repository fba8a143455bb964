"""Small pieces of Arrow batches, for Python stages whose rows may be large."""

from __future__ import annotations

from typing import Iterator

import pyarrow as pa
import pyarrow.compute as pc

#: rows and bytes of one column that a Python stage holds as objects at once
PIECE_ROWS = 256
PIECE_BYTES = 2 << 20


def pieces(batch: pa.RecordBatch, wide: str, rows: int = PIECE_ROWS, size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in consecutive pieces (views, no copies) of at most ``rows``
    rows and ``size`` bytes of column ``wide``; a larger row stands alone."""
    start = held = 0
    for i, n in enumerate(pc.binary_length(batch.column(wide)).to_pylist()):
        n = n or 0
        if i > start and (i - start >= rows or held + n > size):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)
