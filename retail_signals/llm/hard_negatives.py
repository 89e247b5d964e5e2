"""Hard negatives from embeddings by residue-number-system matrix products.

Components are ``floor(scale * x)``. Each tile of anchors by rows is multiplied
modulo several primes below 256 in float32: symmetric residues are at most 125,
so sums over 1024 components stay under 2^24 and are exact. Chinese remaindering
puts the signed integer scores together; the number of primes follows from a
bound on the scores (greatest component, greatest length) that one aggregate
takes from the data.

Rows and anchors are dealt by hash into blocks of bounded size; a pair of blocks
is one group. A first pass finds each anchor's positives, a second the best rows
of another label in each positive's score window (a contiguous run of the
anchor's sorted scores). Blocks give at most ``positives`` or ``negatives`` rows
an anchor and positive, and a window picks the best of them. All rows are scored
against all anchors; no label or vector is treated apart.

Defined results: rows with a null label or vector, or with a null or non-finite
component, take no part. Vectors of different lengths are compared as if padded
with zeros; an empty vector scores 0. Repeated rows are rows of their own, also
as anchors (an anchor row is only not its own positive). A null ``id`` is no
anchor; as a positive or negative it comes after all ids of equal score. An
anchor without positives, or a positive without negatives in its window, gives
no rows, and so does an empty table. A score beyond 64 bits is returned as null
but ordered by its exact value. Other input columns are not read.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_stage, record_batch, stage

#: Odd primes below 256, greatest first.
PRIMES = [p for p in range(255, 2, -2) if all(p % q for q in range(3, 16, 2) if q < p)]
#: Components whose products of residues sum exactly in float32.
EXACT_TERMS = 2**24 // 125**2 // 16 * 16

FOUND = "anchor_row long, score long, big string, id long, row long"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def primes_for(bound: int) -> list[int]:
    """The fewest primes whose product exceeds every signed score's range."""
    product, chosen = 1, []
    for p in PRIMES:
        if product > 2 * bound:
            break
        product *= p
        chosen.append(p)
    if product <= 2 * bound:
        raise ValueError("components are too large for the product of all primes below 256")
    return chosen


def residues(matrix: np.ndarray, p: int) -> np.ndarray:
    """Symmetric residues as float32; ``fmod`` of integral doubles is exact."""
    r = np.fmod(matrix, p)
    r -= p * (r > p / 2)
    r += p * (r < -p / 2)
    return r.astype(np.float32)


def residue_product(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact signed scores of residue matrices (one for each prime): int64 where
    the primes' product allows it, else Python integers."""
    total, product = None, 1
    wide = math.prod(primes) >= 2**62
    for x, y, p in zip(a, b, primes):
        r = np.zeros((len(x), len(y)), np.float32)
        for k in range(0, x.shape[1], EXACT_TERMS):
            r = np.fmod(r + np.fmod(x[:, k:k + EXACT_TERMS] @ y[:, k:k + EXACT_TERMS].T, p), p)
        digit = r.astype(np.int64)
        if wide:
            digit = digit.astype(object)
        if total is None:
            total = digit % p
        else:
            total += (digit - total % p) * pow(product, -1, p) % p * product
        product *= p
    total[total > product // 2] -= product
    return total


def _matrix(column: pa.Array, scale: float, width: int) -> np.ndarray:
    """``floor(scale * x)`` of list values as integral doubles, padded with zeros."""
    lengths = np.asarray(column.value_lengths())
    out = np.zeros((len(column), width))
    values = np.floor(scale * np.asarray(column.flatten(), np.float64))
    out[np.arange(width) < lengths[:, None]] = values
    return out


class Block:
    """One group's rows in order of (id, row), nulls last."""

    def __init__(self, table: pa.Table, scale: float, width: int, primes: list[int]):
        ids = table.column("id").combine_chunks()
        null = np.asarray(ids.is_null())
        ids = np.asarray(ids.fill_null(0))
        rows = table.column("row").to_numpy()
        order = np.lexsort((rows, ids, null))
        self.ids, self.null, self.rows = ids[order], null[order], rows[order]
        self.labels = table.column("label").to_numpy()[order]
        vectors = table.column("vector").combine_chunks().take(pa.array(order))
        matrix = _matrix(vectors, scale, width)
        self.parts = [residues(matrix, p) for p in primes]

    def picked(self, at: list[int], scores: list) -> dict[str, list]:
        return {"score": [int(s) if -2**63 <= s < 2**63 else None for s in scores],
                "big": [None if -2**63 <= s < 2**63 else str(s) for s in scores],
                "id": [None if self.null[i] else int(self.ids[i]) for i in at],
                "row": [int(self.rows[i]) for i in at]}


def _cells(rows: DataFrame, anchors: DataFrame, row_blocks: int, anchor_blocks: int):
    """Rows and anchors grouped by pairs of blocks; each block meets each other once."""
    of_row, of_anchor = (F.pmod(F.xxhash64("row"), F.lit(n)).cast("int") for n in (row_blocks, anchor_blocks))
    rows = rows.select("*", of_row.alias("rb"), F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1))).alias("ab"))
    anchors = anchors.select("*", of_anchor.alias("ab"),
                             F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))).alias("rb"))
    return anchors.groupBy("ab", "rb").cogroup(rows.groupBy("ab", "rb"))


def _tiles(left: pa.Table, right: pa.Table, scale: float, width: int, primes: list[int], tile: int) -> Iterator:
    """(anchor row number in ``left``, its label and row, scores against the block)."""
    block = Block(right, scale, width, primes)
    labels, rows = left.column("label").to_pylist(), left.column("row").to_pylist()
    vectors = left.column("vector").combine_chunks()
    for at in range(0, left.num_rows, tile):
        part = _matrix(vectors.slice(at, tile), scale, width)
        scores = residue_product([residues(part, p) for p in primes], block.parts, primes)
        for k, line in enumerate(scores):
            yield at + k, labels[at + k], rows[at + k], line, block


def mine(df: DataFrame, is_anchor: Column, id_col: str = "vec_id", label_col: str = "label",
         vector_col: str = "embedding", scale: float = 256.0, positives: int = 5, negatives: int = 10,
         low: int = 30, high: int = 90, block_values: int = 524288, tile: int = 128) -> DataFrame:
    """For each anchor and each of its ``positives`` best rows of the same label,
    the ``negatives`` best rows of another label whose score is from ``low`` to
    ``high`` percent of the positive's. A block holds about ``block_values``
    components, half as many of anchors."""
    spark = df.sparkSession
    vector = F.col(vector_col).cast("array<double>")
    sound = (F.col(label_col).isNotNull() & vector.isNotNull()
             & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf))))
    rows, path = stage(df.filter(sound).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
        F.col(vector_col).alias("vector"), (F.coalesce(is_anchor, F.lit(False)) & F.col(id_col).isNotNull())
        .alias("anchor"), F.monotonically_increasing_id().alias("row")))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("anchors"),
                    F.max(F.size("vector")).alias("width"),
                    F.max(F.array_max(F.transform("vector", F.abs))).alias("top")).first()
    if not size["anchors"]:
        drop_stage(spark, path)
        return spark.createDataFrame([], RESULT)
    width = size["width"]
    primes = primes_for(width * (math.floor(scale * (size["top"] or 0.0)) + 1) ** 2)
    block = max(tile, block_values // max(width, 1))
    blocks = -(-size["n"] // block), -(-size["anchors"] // -(-block // 2))
    columns = ("id", "label", "vector", "row")
    # Read again: a cogroup needs columns of its own on each side.
    anchors = spark.read.schema(rows.schema).parquet(path).filter("anchor").select(*columns)
    rows = rows.select(*columns)

    def find_positives(left, right):
        cols: dict[str, list] = {c: [] for c in ("anchor_row", "score", "big", "id", "row")}
        if left.num_rows and right.num_rows:
            for _, label, row, line, block in _tiles(left, right, scale, width, primes, tile):
                at = np.flatnonzero((block.labels == label) & (block.rows != row))
                at = at[np.argsort(-line[at], kind="stable")[:positives]]
                found = block.picked(at, line[at])
                cols["anchor_row"] += [row] * len(at)
                for c, values in found.items():
                    cols[c] += values
        return pa.Table.from_batches([record_batch(FOUND, cols)])

    exact = F.coalesce(F.col("score").cast("decimal(38,0)"), F.col("big").cast("decimal(38,0)"))
    best = (F.desc(F.col("exact")), F.asc_nulls_last("id"), F.asc("row"))
    placed = (_cells(rows, anchors, *blocks).applyInArrow(find_positives, FOUND).withColumn("exact", exact)
              .withColumn("place", F.row_number().over(Window.partitionBy("anchor_row").orderBy(*best)))
              .filter(F.col("place") <= positives))
    chosen, chosen_path = stage(placed.groupBy("anchor_row").agg(F.sort_array(F.collect_list(F.struct(
        "place", "id", "score", F.col("exact").cast("string").alias("exact")))).alias("positives"))
        .join(anchors, F.col("anchor_row") == F.col("row")).select("positives", *columns))
    pair = "anchor_id long, place int, positive_id long, positive_score long, " + FOUND

    def find_negatives(left, right):
        cols: dict[str, list] = {f.split(" ")[0]: [] for f in pair.split(", ")}
        if left.num_rows and right.num_rows:
            ids, lists = left.column("id").to_pylist(), left.column("positives").to_pylist()
            for k, label, row, line, block in _tiles(left, right, scale, width, primes, tile):
                at = np.flatnonzero(block.labels != label)
                at = at[np.argsort(-line[at], kind="stable")]
                falling = -line[at]
                for positive in lists[k]:
                    score = int(positive["exact"])
                    # low * score <= 100 * s <= high * score, for an integer s
                    least, most = -(-low * score // 100), high * score // 100
                    first = int(np.searchsorted(falling, -most))
                    end = int(np.searchsorted(falling[first:first + negatives], -least, "right"))
                    own = at[first:first + end]
                    for c, values in block.picked(own, line[own]).items():
                        cols[c] += values
                    for c, value in (("anchor_id", ids[k]), ("place", positive["place"]), ("anchor_row", row),
                                     ("positive_id", positive["id"]), ("positive_score", positive["score"])):
                        cols[c] += [value] * len(own)
        return pa.Table.from_batches([record_batch(pair, cols)])

    hard = (_cells(rows, chosen, *blocks).applyInArrow(find_negatives, pair).withColumn("exact", exact)
            .withColumn("rank", F.row_number().over(Window.partitionBy("anchor_row", "place").orderBy(*best)))
            .filter(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))
    result, _ = stage(hard)
    drop_stage(spark, path, chosen_path)
    return result
