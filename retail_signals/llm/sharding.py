"""Uniform shuffle into shards of exact sizes by a hypergeometric matrix.

1. Each input partition permutes its rows locally (a sort by random numbers) and
   the rows, with their partition and local rank, become a staged table.
2. The matrix of how many rows each partition sends to each shard is drawn
   exactly, with the partition sizes and the shard sizes as margins: a binary tree
   over the partitions splits the shards' rows between the halves, each split a
   chain of hypergeometric draws.
3. The first rows of a partition's permuted order go to the first shard, the next
   to the second, and so on. The matrix is bounded (``max_parts`` by the shards)
   and broadcast, so looking a row's shard up moves no row.
4. Each shard permutes its rows again, by a second random number: its range is cut
   into equal cells, rows are exchanged by shard and cell (the only exchange of
   whole rows) and ordered there. A cell starts at the number of rows in the cells
   before it, which a pass over the random numbers alone counts. So a shard of any
   size is ordered by many tasks.

Only DataFrame and SQL functions run on the data. Defined results: any column
may be null; copies and repeated ids are rows of their own; an empty table gives
no rows; input columns named as result columns are replaced.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, stage, stage_bytes

#: Half the width, in standard deviations, of the support that a draw looks at
#: (beyond, the probability is below 1e-20).
REACH = 10
#: Largest matrix, in bytes of its numbers, that is broadcast.
BROADCAST_BYTES = 8 << 20


def _uniform(*parts: str) -> str:
    """A number in [0, 1) that depends on its parts only."""
    return f"(shiftrightunsigned(xxhash64({', '.join(parts)}), 11) / 9007199254740992D)"


def _hypergeometric(u: str) -> str:
    """SQL for lambdas over ``d``, a struct of doubles n (rows in all), k (marked)
    and m (drawn): the number of marked rows among those drawn.

    Weights relative to the mode follow from the ratio of neighbouring
    probabilities; the draw inverts their sum at ``u``."""
    up = "w * (d.k - x) * (d.m - x) / ((x + 1D) * (d.n - d.k - d.m + x + 1D))"
    down = "w * x * (d.n - d.k - d.m + x) / ((d.k - x + 1D) * (d.m - x + 1D))"
    first = "greatest(0D, d.m - (d.n - d.k))"
    last = "least(d.k, d.m)"
    mode = f"least({last}, greatest({first}, floor((d.m + 1D) * (d.k + 1D) / (d.n + 2D))))"
    spread = (f"ceil({REACH} * sqrt(d.m * (d.k / d.n) * (1D - d.k / d.n) * (d.n - d.m) / greatest(1D, d.n - 1D))"
              " + 30)")

    def walk(steps: str, ratio: str, by: str, target: str | None) -> str:
        """Sum of weights from the mode's neighbour on, or where it passes the target."""
        step = ratio.replace("w *", "s.w *").replace("x", "s.x")
        if target is None:
            return (f"aggregate(sequence(0, {steps}), named_struct('x', p.mode, 'w', 1D, 'sum', 0D),"
                    f" (s, i) -> IF(i = 0, s, named_struct('x', s.x {by}, 'w', {step}, 'sum', s.sum + {step})),"
                    f" s -> s.sum)")
        return (f"aggregate(sequence(0, {steps}), named_struct('x', p.mode, 'w', 1D, 'sum', 0D, 'hit', p.mode, 'on', true),"
                f" (s, i) -> CASE WHEN i = 0 OR NOT s.on THEN s ELSE named_struct('x', s.x {by}, 'w', {step},"
                f" 'sum', s.sum + {step}, 'hit', s.x {by}, 'on', s.sum + {step} < {target}) END, s -> s.hit)")

    ups, downs = "int(least(p.last - p.mode, p.spread))", "int(least(p.mode - p.first, p.spread))"
    total_up, total_down = walk(ups, up, "+ 1D", None), walk(downs, down, "- 1D", None)
    # target counts from the mode's own weight 1: below 1 the mode, then upwards, then downwards
    pick = (f"element_at(transform(array(named_struct('t', {u} * (1D + q.up + q.down), 'up', q.up)), r -> CASE"
            f" WHEN r.t < 1D THEN p.mode"
            f" WHEN r.t < 1D + r.up THEN {walk(ups, up, '+ 1D', 'r.t - 1D')}"
            f" ELSE {walk(downs, down, '- 1D', 'r.t - 1D - r.up')} END), 1)")
    return (f"IF({first} = {last}, {first}, element_at(transform(array(named_struct('first', {first}, 'last', {last},"
            f" 'mode', {mode}, 'spread', {spread})), p -> element_at(transform(array(named_struct("
            f"'up', {total_up}, 'down', {total_down})), q -> {pick}), 1)), 1))")


def _left_half(seed: int) -> str:
    """SQL for how a node's left half shares in each cell: for cell after cell a
    draw from the rows that are left."""
    draw = _hypergeometric(_uniform(str(seed), "lo", "hi", "c.i"))
    return f"""aggregate(
        transform(cells, (v, i) -> named_struct('i', i, 'v', v)),
        named_struct('n', cast(total AS DOUBLE), 'm', cast(half AS DOUBLE), 'out', cast(array() AS array<bigint>)),
        (a, c) -> element_at(transform(array(named_struct('n', a.n, 'k', cast(c.v AS DOUBLE), 'm', a.m)),
            d -> element_at(transform(array({draw}),
                g -> named_struct('n', a.n - d.k, 'm', a.m - g, 'out', array_append(a.out, cast(g AS BIGINT)))), 1)), 1),
        a -> a.out)"""


def _sum(array: str) -> str:
    return f"aggregate({array}, 0L, (a, x) -> a + x)"


def communication_matrix(counts: DataFrame, cell_sizes: list[int], seed: int) -> DataFrame:
    """Rows (part, cells) for ``counts`` (part, rows): an exact draw of how many
    rows each partition sends to each cell (here: shard). A tree over the partitions, one level
    at a time; below its top levels nodes are spread over tasks."""
    sizes = f"array({', '.join(f'{c}L' for c in cell_sizes)})"
    nodes = (counts.groupBy().agg(F.expr("array_sort(collect_list(struct(part, rows)))").alias("parts"))
             .filter("size(parts) > 0")
             .select("parts", F.lit(0).alias("lo"), F.expr("size(parts)").alias("hi"),
                     F.expr(sizes).alias("cells")))
    levels = max(0, (counts.count() - 1).bit_length())
    for level in range(levels):
        if level and level % 6 == 0:
            nodes = nodes.repartition("lo")
        nodes = (nodes.withColumn("mid", F.expr("int(size(parts) div 2)"))
                 .withColumn("total", F.expr(_sum("transform(parts, p -> p.rows)")))
                 .withColumn("half", F.expr(_sum("transform(slice(parts, 1, mid), p -> p.rows)")))
                 .withColumn("left", F.expr(f"IF(mid = 0, cells, {_left_half(seed)})"))
                 .withColumn("node", F.expr("""explode(IF(mid = 0,
                     array(named_struct('parts', parts, 'lo', lo, 'hi', hi, 'cells', cells)),
                     array(named_struct('parts', slice(parts, 1, mid), 'lo', lo, 'hi', lo + mid, 'cells', left),
                           named_struct('parts', slice(parts, mid + 1, size(parts)), 'lo', lo + mid, 'hi', hi,
                                        'cells', zip_with(cells, left, (a, b) -> a - b)))))"""))
                 .select("node.*"))
    return nodes.select(F.expr("parts[0].part").alias("part"), "cells")


def _find(array: str, value: str) -> str:
    """How many of an ascending array's numbers are at most the value (binary search)."""
    return f"""aggregate(sequence(1, 32), named_struct('lo', 0, 'hi', size({array})),
        (s, i) -> CASE WHEN s.lo >= s.hi THEN s
                       WHEN {array}[int((s.lo + s.hi) div 2)] <= {value}
                       THEN named_struct('lo', int((s.lo + s.hi) div 2) + 1, 'hi', s.hi)
                       ELSE named_struct('lo', s.lo, 'hi', int((s.lo + s.hi) div 2)) END, s -> s.lo)"""


def shuffle_to_shards(df: DataFrame, shards: int = 16, seed: int = 11, cell_rows: int = 50_000,
                      cell_bytes: int = 64 << 20, max_parts: int = 32_768) -> DataFrame:
    """``df`` with ``shard`` (int) and ``slot`` (long, gapless from 0): a uniform
    random permutation cut into shards of equal sizes, at most one row apart.

    A cell, the rows that one task orders, has some ``cell_rows`` rows or
    ``cell_bytes`` of staged Parquet, whichever are fewer. Input splits are read by
    at most ``max_parts`` tasks, so that the matrix can be broadcast; only with so
    many shards that it passes ``BROADCAST_BYTES`` Spark chooses the join."""
    df = df.drop("shard", "slot")
    part, rank, again, cell, where, ends, rows, at_shard, at_cell, first = (fresh(df, n) for n in (
        "part_", "rank_", "again_", "cell_", "cell_of_", "ends_", "rows_", "at_shard_", "at_cell_", "first_"))
    permuted = (df.coalesce(max_parts).withColumn(rank, F.rand(seed)).withColumn(again, F.rand(seed + 1))
                .sortWithinPartitions(rank)
                .withColumn(rank, F.monotonically_increasing_id())
                .withColumn(part, F.shiftright(rank, 33))
                .withColumn(rank, F.col(rank).bitwiseAND(F.lit((1 << 33) - 1))))
    staged, path = stage(permuted)
    counts, _ = stage(staged.groupBy(F.col(part).alias("part")).agg(F.count(F.lit(1)).alias("rows")))
    parts, total = counts.agg(F.count("part"), F.coalesce(F.sum("rows"), F.lit(0))).first()
    sizes = [total // shards + (k < total % shards) for k in range(shards)]
    matrix, _ = stage(communication_matrix(counts, sizes, seed)
                      .select(F.col("part").alias(where), F.expr("""aggregate(cells, cast(array() AS array<bigint>),
                          (a, x) -> array_append(a, coalesce(try_element_at(a, -1), 0L) + x))""").alias(ends)))
    if 8 * parts * shards <= BROADCAST_BYTES:
        matrix = F.broadcast(matrix)
    cells = max(1, -(-total // (shards * cell_rows)), -(-stage_bytes(df.sparkSession, path) // (shards * cell_bytes)))
    sent = (staged.join(matrix, F.col(part) == F.col(where))
            .withColumn("shard", F.expr(_find(f"`{ends}`", f"`{rank}`"))).drop(where, ends)
            .withColumn(cell, F.least(F.lit(cells - 1), F.floor(F.col(again) * cells).cast("int"))))
    firsts = (sent.groupBy(F.col("shard").alias(at_shard), F.col(cell).alias(at_cell)).agg(F.count(F.lit(1)).alias(rows))
              .withColumn(first, F.expr(f"sum(`{rows}`) OVER (PARTITION BY `{at_shard}` ORDER BY `{at_cell}`) - `{rows}`"))
              .drop(rows))
    order = f"row_number() OVER (PARTITION BY shard, `{cell}` ORDER BY `{again}`, `{part}`, `{rank}`)"
    return (sent.withColumn("slot", F.expr(order))
            .join(firsts, (F.col("shard") == F.col(at_shard)) & (F.col(cell) == F.col(at_cell)))
            .withColumn("slot", F.col("slot") - 1 + F.col(first))
            .select(*[F.col(f"`{c}`") for c in df.columns], "shard", "slot"))


def document_size(text: Column) -> Column:
    return (F.octet_length(F.coalesce(text, F.lit(""))) + 1).cast("long")
