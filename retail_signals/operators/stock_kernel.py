"""The per-partition kernel of the stock fold.

Self-contained (NumPy and PyArrow only): Spark ships it to the Python workers
by value, so executors need no copy of this package. ``policy`` is the plain
tuple (initial_stock, reorder_point, reorder_qty, lead_rows).
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


class SeriesState:
    """Stock of the series being folded and the reorder flags of its last
    ``lead`` rows (a ring indexed by row number modulo lead)."""

    __slots__ = ("key", "stock", "ring", "pos")

    def __init__(self, key, initial_stock: int, lead_rows: int):
        self.key = key
        self.stock = initial_stock
        self.ring = [False] * lead_rows
        self.pos = 0


def fold_openings(keys: list, demand: list, state: SeriesState | None,
                  policy: tuple[int, int, int, int]
                  ) -> tuple[np.ndarray, np.ndarray, SeriesState | None]:
    """Opening stock and arrivals for consecutive rows sorted by (key, date).

    ``keys[i]`` identifies the series of row ``i``; ``state`` is the series
    left open by the previous batch (or ``None``). Returns the two columns and
    the state to carry into the next batch.
    """
    n = len(keys)
    starts = [True] * n
    for i in range(1, n):
        starts[i] = keys[i] != keys[i - 1]
    if n and state is not None and keys[0] == state.key:
        starts[0] = False
    return fold_runs(starts, demand, keys[-1] if n else None, state, policy)


def fold_runs(starts: list, demand: list, last_key, state: SeriesState | None,
              policy: tuple[int, int, int, int]
              ) -> tuple[np.ndarray, np.ndarray, SeriesState | None]:
    """The fold itself; ``starts[i]`` is True where a new series begins (the
    first row continues ``state`` when False)."""
    initial, rop, qty, lead = policy
    n = len(demand)
    opening = [0] * n
    arrived = [0] * n
    if state is None:
        state = SeriesState(None, initial, lead)
    stock, ring, slot = state.stock, state.ring, state.pos
    for i in range(n):
        if starts[i]:
            stock, ring, slot = initial, [False] * lead, 0
        got = qty if ring[slot] else 0          # order placed ``lead`` rows ago
        stock += got
        ring[slot] = stock <= rop               # reorder check on the opening stock
        slot = slot + 1 if slot + 1 < lead else 0
        opening[i] = stock
        arrived[i] = got
        d = demand[i]
        left = stock - (stock if stock < d else d)
        stock = int(left) if left > 0.0 else 0
    out = SeriesState(last_key, initial, lead)
    out.stock, out.ring, out.pos = stock, ring, slot
    return np.array(opening, dtype=np.int64), np.array(arrived, dtype=np.int64), out


def _series_starts(store: pa.Array, item: pa.Array) -> list:
    """True where the (store, item) key differs from the previous row's,
    compared column-wise by Arrow (nulls count as equal to nulls)."""
    n = len(store)
    if n < 2:
        return [True] * n
    changed = None
    for col in (store, item):
        a, b = col.slice(1), col.slice(0, n - 1)
        diff = pc.fill_null(pc.not_equal(a, b), True)
        both_null = pc.and_(pc.is_null(a), pc.is_null(b))
        diff = pc.and_(diff, pc.invert(both_null))
        changed = diff if changed is None else pc.or_(changed, diff)
    return [True] + changed.to_numpy(zero_copy_only=False).tolist()


def make_kernel(policy: tuple[int, int, int, int]):
    """``mapInArrow`` function: appends opening_stock and replenished_qty to each
    Arrow batch, carrying the open series across batch edges.

    Only the key and demand columns are read into Python; every other column
    is passed through as the same Arrow buffers, so values (NaN and null
    included) come back exactly as they went in.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            names = batch.schema.names
            store = batch.column(names.index("store_id"))
            item = batch.column(names.index("item_id"))
            starts = _series_starts(store, item)
            first = (store[0].as_py(), item[0].as_py())
            if state is not None and state.key == first:
                starts[0] = False
            last = (store[-1].as_py(), item[-1].as_py())
            demand = batch.column(names.index("demand")).to_numpy(zero_copy_only=False).tolist()
            opening, arrived, state = fold_runs(starts, demand, last, state, policy)
            yield pa.RecordBatch.from_arrays(
                list(batch.columns) + [pa.array(opening.astype(np.int32), pa.int32()),
                                       pa.array(arrived.astype(np.int32), pa.int32())],
                names=names + ["opening_stock", "replenished_qty"])
    return run
