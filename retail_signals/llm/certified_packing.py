"""Best-fit packing whose sequence counts are certified by lower bounds.

Each Spark task tokenizes its input split and packs it in partitions of about
``block_tokens`` ids by best-fit decreasing. Dual feasible functions give a lower
bound on the sequences of a partition. One that meets its bound is certified: only
its emptiest sequence, whose room the bound's rounding hides, is open for exchange.
One with a gap opens all its sequences that are not full. The documents of open
sequences are dealt by hash into new partitions, packed by best-fit decreasing and
certified again, round after round, until the bound of the whole table is met,
one partition is left, or a round frees no sequence. A new partition that would
need more sequences than it got keeps those that it got.

Only documents over ``length`` ids are cut, into a first piece with the rest and
whole pieces after it. Partitions are bounded by ``block_tokens`` in every round,
and what is exchanged falls from round to round.

Defined results: null text counts as empty and gives one piece, the end id;
copies, repeated and null ids are packed as rows of their own; an empty table
gives no rows; other input columns are not read.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .binary_output import best_fit_decreasing
from .common import drop_stage, record_batch, slices, stage, text_of, worker_state
from .units import ByteBpe

PIECE = ("piece int, start long, length long, sequence_id long, offset long, certified boolean, open boolean, "
         "ids binary")


def lower_bound(sizes: np.ndarray, counts: np.ndarray, length: int) -> int:
    """Sequences that pieces of these sizes need at least: the greatest bound of
    two families of dual feasible functions.

    For each threshold k: pieces over ``length - k`` count whole, those under k
    nothing. For each k up to 100: x counts as floor((k + 1) x / length) / k, or
    as itself where that product is whole.
    """
    if not len(sizes):
        return 0
    order = np.argsort(sizes)
    sizes, counts = sizes[order].astype(np.int64), counts[order].astype(np.int64)
    number = np.concatenate([[0], np.cumsum(counts)])
    volume = np.concatenate([[0], np.cumsum(counts * sizes)])
    k = np.arange(0, length // 2 + 1)
    small, large = np.searchsorted(sizes, k, "left"), np.searchsorted(sizes, length - k, "right")
    weight = volume[large] - volume[small] + (number[-1] - number[large]) * length
    best = -(-int(weight.max()) // length)
    for k in range(1, 101):
        whole = (k + 1) * sizes % length == 0
        # in units of 1 / (k * length)
        value = int((counts * np.where(whole, k * sizes, (k + 1) * sizes // length * length)).sum())
        best = max(best, -(-value // (k * length)))
    return best


def pack(sizes: list[int], length: int) -> tuple[list[list[int]], bool]:
    """Rows of piece numbers, and whether their count is proven least."""
    rows = best_fit_decreasing(sizes, length)
    return rows, len(rows) == lower_bound(*np.unique(np.array(sizes, np.int64), return_counts=True), length)


def opened(fill: list[int], certified: bool, length: int) -> set[int]:
    """Numbers of the sequences whose documents go on to the exchange."""
    if not certified:
        return {r for r, used in enumerate(fill) if used < length}
    least = min(range(len(fill)), key=fill.__getitem__, default=None)
    return set() if least is None or fill[least] == length else {least}


def _batch(kind: str, columns: dict[str, list]) -> pa.RecordBatch:
    return record_batch(f"doc_id {kind}, {PIECE}", columns)


def _packed(pieces: list[tuple], rows: list[list[int]], certified: bool, length: int, first: int, kind: str):
    """Pieces (doc, piece, start, ids) with their places in ``rows``."""
    fill = [sum(len(pieces[i][3]) // 4 for i in row) for row in rows]
    free = opened(fill, certified, length)
    cols: dict[str, list] = {f.split(" ")[0]: [] for f in f"doc_id {kind}, {PIECE}".split(", ")}
    for r, row in enumerate(rows):
        at = 0
        for i in row:
            doc, piece, start, ids = pieces[i]
            size = len(ids) // 4
            for name, value in zip(cols, (doc, piece, start, size, first + r, at, certified, r in free, ids)):
                cols[name].append(value)
            at += size
    return _batch(kind, cols)


def _first_round(df: DataFrame, kind: str, ranks_path: str, pattern: str, json: str, end_id: int, length: int,
                 block_tokens: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker_state(f"bpe:{json}", lambda: ByteBpe(ranks_path, pattern, json))
        end = np.array([end_id], "<u4").tobytes()
        pieces, held, seq = [], 0, TaskContext.get().partitionId() << 28

        def block():
            nonlocal pieces, held, seq
            rows, certified = pack([len(p[3]) // 4 for p in pieces], length)
            out = _packed(pieces, rows, certified, length, seq, kind)
            seq += len(rows)
            pieces, held = [], 0
            return out

        for part in slices(batches):
            for doc, ids in zip(part.column(0).to_pylist(), bpe.encode(part.column(1).to_pylist())):
                ids += end
                total = len(ids) // 4
                cuts = [0, *range(total % length or length, total, length), total]
                pieces += [(doc, n, at, ids[4 * at:4 * to]) for n, (at, to) in enumerate(zip(cuts, cuts[1:]))]
                held += total
                if held >= block_tokens:
                    yield block()
        if pieces:
            yield block()

    return df.select("doc_id", text_of().alias("text")).mapInArrow(run, f"doc_id {kind}, {PIECE}")


def _next_round(free: DataFrame, kind: str, length: int, number: int, partitions: int) -> DataFrame:
    def repack(table: pa.Table) -> pa.Table:
        names = ("doc_id", "piece", "start", "ids")
        order = pc.sort_indices(table, sort_keys=[("sequence_id", "ascending"), ("offset", "ascending")])
        table = table.take(order)
        pieces = list(zip(*(table.column(c).to_pylist() for c in names)))
        before = len(pc.unique(table.column("sequence_id")))
        rows, certified = pack([len(p[3]) // 4 for p in pieces], length)
        if len(rows) >= before:  # nothing won: the sequences stay as they came
            sizes = np.unique([len(p[3]) // 4 for p in pieces], return_counts=True)
            certified = lower_bound(*sizes, length) == before
            fill = table.group_by("sequence_id", use_threads=False).aggregate([("length", "sum")])
            ids = fill.column("sequence_id").to_pylist()
            free = {ids[r] for r in opened(fill.column("length_sum").to_pylist(), certified, length)}
            for name, values in (("certified", [certified] * len(pieces)),
                                 ("open", [s in free for s in table.column("sequence_id").to_pylist()])):
                table = table.set_column(table.column_names.index(name), name, pa.array(values, pa.bool_()))
            return table.drop_columns(["dealt"])
        first = (number << 56) + (table.column("dealt")[0].as_py() << 28)
        return pa.Table.from_batches([_packed(pieces, rows, certified, length, first, kind)])

    dealt = F.pmod(F.xxhash64("sequence_id", F.lit(number)), F.lit(partitions)).cast("long")
    return free.withColumn("dealt", dealt).groupBy("dealt").applyInArrow(repack, f"doc_id {kind}, {PIECE}")


def table_bound(pieces: DataFrame, length: int = 2048) -> int:
    """Lower bound of the whole table, from one count for each piece length."""
    counts = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most ``length`` rows
    return lower_bound(np.array([r["length"] for r in counts]), np.array([r["n"] for r in counts]), length)


def pack_certified(df: DataFrame, ranks_path: str, pattern: str, json: str, end_id: int = 0, length: int = 2048,
                   block_tokens: int = 2_000_000) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, sequence_id, offset,
    ids (little-endian unsigned 32-bit) and ``certified``: whether the partition
    that made its sequence has the least possible count."""
    spark = df.sparkSession
    kind = df.schema["doc_id"].dataType.simpleString().replace("bigint", "long")
    settled, number, bound, freed = [], 0, None, 0
    now, path = stage(_first_round(df, kind, ranks_path, pattern, json, end_id, length, block_tokens))
    bound = table_bound(now, length)
    total = now.agg(F.count_if(F.col("offset") == 0)).first()[0]
    while True:
        free = now.filter("open")
        size = free.agg(F.count_if(F.col("offset") == 0).alias("sequences"), F.sum("length").alias("tokens")).first()
        if total <= bound or size["sequences"] < 2 or number and not freed:
            settled.append(now)
            break
        settled.append(now.filter(~F.col("open")))
        number += 1
        partitions = -(-size["tokens"] // block_tokens)
        now, path = stage(_next_round(free, kind, length, number, partitions))
        after = now.agg(F.count_if(F.col("offset") == 0)).first()[0]
        freed = size["sequences"] - after
        total -= freed
        if partitions == 1:
            settled.append(now)
            break
    result = settled[0]
    for part in settled[1:]:
        result = result.unionByName(part)
    return result.drop("open")
