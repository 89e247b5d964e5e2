"""Packed token-id matrices by best-fit decreasing.

Each Spark task takes its input split in blocks of about ``block_tokens`` ids.
In a block, documents over the row length are split without loss into whole rows
and a rest; the pieces, longest first, go to the row with the least room that
still holds them, found by a segment tree over the room of open rows. A row
leaves as one record: ids, padded; cumulative segment lengths; positions, which
start at 0 with each segment (``doc_starts`` has a piece's place in its document).

Defined results: null text counts as empty and gives one segment, the end id;
copies and repeated ids are packed as rows of their own; an empty table gives no
rows; other input columns are not read.
"""
from __future__ import annotations

import zlib

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import record_batch, slices, text_of, worker_state
from .units import ByteBpe


class RoomTree:
    """Segment tree over rooms 1..size: which of them some open row has."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: dict[int, list[int]] = {}

    def _change(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, room: int, row: int) -> None:
        self.rows.setdefault(room, []).append(row)
        self._change(room, 1)

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return (room, row) of the least room of at least ``size``."""
        node, count = size + self.leaves, self.count
        while not count[node]:
            while node & 1:  # a right child: nothing further right below its parent
                node >>= 1
                if node <= 1:
                    return None
            node += 1
        while node < self.leaves:
            node = 2 * node if count[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._change(room, -1)
        return room, self.rows[room].pop()


def best_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """Rows of piece numbers; pieces of equal size keep their order."""
    tree, rows = RoomTree(length), []
    for piece in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        found = tree.take(sizes[piece])
        room, row = found or (length, len(rows))
        if not found:
            rows.append([])
        rows[row].append(piece)
        if room > sizes[piece]:
            tree.put(room - sizes[piece], row)
    return rows


BASE = ("sequence_id long, n_tokens int, doc_ids array<long>, doc_starts array<long>, cu_seqlens array<int>, "
        "ids_crc32 long, positions_crc32 long")


def packed_rows(df: DataFrame, ranks_path: str, pattern: str, json: str, end_id: int = 1, pad_id: int = 0,
                length: int = 2048, block_tokens: int = 2_000_000, with_ids: bool = True) -> DataFrame:
    """One record for each packed row: its segments' documents and starts,
    cu_seqlens (from 0 to n_tokens), checksums of the padded row and, if asked
    for, ``input_ids`` and ``position_ids`` (``length`` little-endian 32-bit
    numbers each)."""
    schema = BASE + ", input_ids binary, position_ids binary" * with_ids

    def block(pieces, first):
        cols: dict[str, list] = {f.split(" ")[0]: [] for f in schema.split(", ")}
        sizes = [len(p[2]) // 4 for p in pieces]
        for k, row in enumerate(best_fit_decreasing(sizes, length)):
            own = [pieces[i] for i in row]
            ends = np.cumsum([0] + [sizes[i] for i in row])
            room = length - int(ends[-1])
            ids = b"".join(p[2] for p in own) + np.full(room, pad_id, "<u4").tobytes()
            places = np.concatenate([np.arange(len(p[2]) // 4) for p in own]
                                    + [np.zeros(room, np.int64)]).astype("<u4").tobytes()
            cols["sequence_id"].append(first + k)
            cols["n_tokens"].append(int(ends[-1]))
            cols["doc_ids"].append([p[0] for p in own])
            cols["doc_starts"].append([p[1] for p in own])
            cols["cu_seqlens"].append(ends.tolist())
            cols["ids_crc32"].append(zlib.crc32(ids))
            cols["positions_crc32"].append(zlib.crc32(places))
            if with_ids:
                cols["input_ids"].append(ids)
                cols["position_ids"].append(places)
        return record_batch(schema, cols), first + len(cols["sequence_id"])

    def run(batches):
        bpe = worker_state(f"bpe:{json}", lambda: ByteBpe(ranks_path, pattern, json))
        end = np.array([end_id], "<u4").tobytes()
        pieces, held, seq = [], 0, TaskContext.get().partitionId() << 32
        for part in slices(batches):
            for doc, ids in zip(part.column(0).to_pylist(), bpe.encode(part.column(1).to_pylist())):
                ids += end
                for start in range(0, len(ids) // 4, length):
                    pieces.append((doc, start, ids[4 * start:4 * (start + length)]))
                held += len(ids) // 4
                if held >= block_tokens:
                    out, seq = block(pieces, seq)
                    yield out
                    pieces, held = [], 0
        if pieces:
            yield block(pieces, seq)[0]

    return df.select("doc_id", text_of().alias("text")).mapInArrow(run, schema)


def write_packed(df: DataFrame, path: str, **settings) -> None:
    """Write the packed matrices as Parquet files of fixed-length binary rows."""
    packed_rows(df, **settings).write.mode("overwrite").parquet(path)
