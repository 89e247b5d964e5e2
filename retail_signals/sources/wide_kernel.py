"""Day lists of series into one column per day; Spark ships it to the Python
workers by value, so executors need no copy of this package."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Rows worked on at once: with some 2,500 days, a block takes about 10 MB.
BLOCK_ROWS = 512


def spread_days(batches: Iterator[pa.RecordBatch], first_day: int, labels: list[str]) -> Iterator[pa.RecordBatch]:
    """Each row's ``cells``, a list of (k, units), as one column for each day from
    ``first_day``; of several cells of a day the first counts."""
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            block = batch.slice(start, BLOCK_ROWS)
            cells = block.column(block.num_columns - 1)
            flat = cells.flatten()
            k, units = flat.field(0), flat.field(1)
            offsets = cells.offsets.to_numpy()
            row = np.repeat(np.arange(block.num_rows), np.diff(offsets))
            day = k.fill_null(first_day - 1).to_numpy(zero_copy_only=False).astype(np.int64) - first_day
            value = units.fill_null(0.0).to_numpy(zero_copy_only=False)
            missing = units.is_null().to_numpy(zero_copy_only=False)
            at = np.flatnonzero((day >= 0) & (day < len(labels)))[::-1]  # the first cell is written last
            dense = np.zeros((len(labels), block.num_rows))
            absent = np.ones((len(labels), block.num_rows), dtype=bool)
            dense[day[at], row[at]] = value[at]
            absent[day[at], row[at]] = missing[at]
            days = [pa.array(v, pa.float64(), mask=m) for v, m in zip(dense, absent)]
            yield pa.RecordBatch.from_arrays([*block.columns[:-1], *days], names=[*block.schema.names[:-1], *labels])
