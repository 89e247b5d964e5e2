"""Sum-of-squares online packing of token ids into fixed-length sequences.

Each Spark task packs the stream of its own input split. A document's whole
windows of ``length`` ids become full sequences; its rest goes, as it arrives,
to the fill level where it makes the sum of squared counts of partially filled
sequences least, tracked in an array with one count a level. When a task has
``max_open`` sequences open, or its input ends, the emptiest open sequences are
dissolved: their pieces are placed anew by the same rule, but into the sequences
that are open, not into new ones. A piece that none of these has room for is cut:
it fills up the sequence that the rule would take, and its rest is placed. So
memory is bounded, no id is lost, and a task pads at most its last sequence and
a few ids (``slack``) in others.

Defined results: null text counts as empty and gives one piece, the end id;
copies and repeated ids are packed as rows of their own; an empty table gives no
rows; other input columns are not read.
"""
from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import record_batch, slices, text_of, worker_state
from .units import ByteBpe

PIECE = ("start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


class SumOfSquares:
    """The level array and the open sequences of one stream."""

    def __init__(self, length: int, max_open: int, slack: int, first_id: int):
        self.length, self.max_open, self.slack = length, max_open, slack
        self.count = np.zeros(length + 1, np.int64)  # of partially filled sequences by level
        self.open: dict[int, list[list]] = defaultdict(list)  # level -> sequences, each a list of pieces
        self.n_open, self.next_id = 0, first_id

    def level_for(self, size: int) -> int:
        """The level (0: a new sequence) that makes the sum of squares least; of
        equal ones the fullest."""
        n, top = self.count, self.length - size
        change = 2 * (n[size:] - n[:top + 1]) + 2
        change[n[:top + 1] == 0] = np.iinfo(np.int64).max
        if n[top]:
            change[top] = 1 - 2 * n[top]
        change[0] = 2 * n[size] + 1 if top else 0
        return top - int(np.argmin(change[::-1]))

    def close(self, pieces: list) -> list:
        out, at = [], 0
        for doc, start, ids, total in pieces:
            out.append((doc, start, ids, total, self.next_id, at))
            at += len(ids) // 4
        self.next_id += 1
        return out

    def add(self, doc, ids: bytes) -> list:
        """Place one document; return the pieces of sequences that this closed."""
        total, whole, out = len(ids) // 4, len(ids) // 4 // self.length * self.length, []
        for start in range(0, whole, self.length):
            out += self.close([(doc, start, ids[4 * start:4 * (start + self.length)], total)])
        size = total - whole
        if size:
            level = self.level_for(size)
            if level:
                pieces = self.open[level].pop()
                self.count[level] -= 1
                self.n_open -= 1
            else:
                pieces = []
            pieces.append((doc, whole, ids[4 * whole:], total))
            level += size
            if level == self.length:
                out += self.close(pieces)
            else:
                self.open[level].append(pieces)
                self.count[level] += 1
                self.n_open += 1
                if self.n_open > self.max_open:
                    out += self.drain(self.max_open // 2)
        return out

    def drain(self, keep: int) -> list:
        """Leave at most ``keep`` sequences open: close those full up to ``slack``
        and dissolve the emptiest others."""
        out = []
        for level in range(self.length - self.slack, self.length):
            while self.open[level]:
                out += self.close(self.take(level))
        while self.n_open > max(keep, 1):
            for piece in self.take(int(np.flatnonzero(self.count)[0])):
                out += self.refill(*piece)
        if not keep and self.n_open:
            out += self.close(self.take(int(np.flatnonzero(self.count)[0])))
        return out

    def take(self, level: int) -> list:
        self.count[level] -= 1
        self.n_open -= 1
        return self.open[level].pop()

    def put(self, pieces: list, level: int) -> list:
        """Open a sequence again at its new level, or close it where it is full up
        to ``slack``."""
        if level >= self.length - self.slack:
            return self.close(pieces)
        self.open[level].append(pieces)
        self.count[level] += 1
        self.n_open += 1
        return []

    def refill(self, doc, start: int, ids: bytes, total: int) -> list:
        """Place a piece of a dissolved sequence among the open ones."""
        out = []
        while ids and self.n_open:
            size = len(ids) // 4
            level = self.level_among(size)
            pieces, room = self.take(level), min(size, self.length - level)
            pieces.append((doc, start, ids[:4 * room], total))
            out += self.put(pieces, level + room)
            start, ids = start + room, ids[4 * room:]
        return out + self.put([(doc, start, ids, total)], len(ids) // 4) if ids else out

    def level_among(self, size: int) -> int:
        """The level above 0 that makes the sum of squares least with a piece of
        ``size`` ids; where no open sequence has room, that with the sequence to
        fill up; of equal ones the fullest."""
        n, top = self.count, self.length - size
        change = 1 - 2 * n  # a sequence of the level gets full
        change[:top] = 2 * (n[size:-1] - n[:top]) + 2
        change[n == 0] = np.iinfo(np.int64).max
        if n[:top + 1].any():
            change[top + 1:] = np.iinfo(np.int64).max
        return self.length - int(np.argmin(change[::-1]))


def pack_documents(df: DataFrame, ranks_path: str, pattern: str, json: str, end_id: int = 1,
                   length: int = 2048, max_open: int = 1024, slack: int = 8,
                   with_ids: bool = True) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, and its ids (little-endian unsigned 32-bit) if asked for.

    Sequence ids are unique over all tasks: the task's partition number in the
    upper 32 bits, a running number in the lower."""
    kind = df.schema["doc_id"].dataType.simpleString().replace("bigint", "long")
    schema = f"doc_id {kind}, {PIECE}" + ", ids binary" * with_ids

    def rows(found):
        doc, start, ids, total, seq, at = zip(*found)
        cols = {"doc_id": doc, "start": start, "length": [len(i) // 4 for i in ids],
                "ids_crc32": [zlib.crc32(i) for i in ids], "doc_tokens": total,
                "sequence_id": seq, "offset": at}
        return record_batch(schema, cols | ({"ids": ids} if with_ids else {}))

    def run(batches):
        bpe = worker_state(f"bpe:{json}", lambda: ByteBpe(ranks_path, pattern, json))
        packer = SumOfSquares(length, max_open, slack, TaskContext.get().partitionId() << 32)
        end = np.array([end_id], "<u4").tobytes()
        for part in slices(batches):
            found = []
            for doc, ids in zip(part.column(0).to_pylist(), bpe.encode(part.column(1).to_pylist())):
                found += packer.add(doc, ids + end)
            if found:
                yield rows(found)
        if found := packer.drain(0):
            yield rows(found)

    return df.select("doc_id", text_of().alias("text")).mapInArrow(run, schema)
