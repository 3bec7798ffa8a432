"""Arrow batches cut into runs of rows with a bounded number of characters."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_CHARS = 400_000


def text_chunks(
    batches: Iterable[pa.RecordBatch], column: str, limit: int = CHUNK_CHARS
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches with their texts (null: empty).

    A slice ends before it would pass ``limit`` characters; a single longer text is a slice of
    its own, never cut. Empty batches give nothing.
    """
    for batch in batches:
        column_at = batch.schema.get_field_index(column)
        sizes = pc.fill_null(pc.utf8_length(batch.column(column_at)), 0).to_numpy()
        ends = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] + limit, side="right")) - 1)
            rows = batch.slice(start, stop - start)
            # Only the texts of a slice are Python objects, never those of the whole batch.
            yield rows, [t or "" for t in rows.column(column_at).to_pylist()]
            start = stop
