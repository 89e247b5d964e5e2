"""N-gram Jaccard self-join by multiple-global-order filtering.

Two documents link when the Jaccard similarity of their sets of 5-word shingles
is at least ``PERCENT`` / 100. Shingles are 64-bit hashes; equal sets are one class.

1. ``_pack``: every whole text becomes its set; runs of 4096 documents (more, where
   there are over 65,536 buckets) send the upper 48 bits of their hashes, packed, to the buckets of the hash range.
2. ``_count``: each bucket finds the shingles that more than one document holds,
   and how many, and replies to the runs. Shingles that hold over a 100,000th of
   all (at most 100,000, so a bounded list) are known from sums by run and skip
   the buckets: they count as most frequent of all, for every document alike.
3. ``_prefixes``: a class needs 80 % of its set shared with others. Of all token
   orders those with unshared shingles first are used: then by rarity, by hash
   upwards, by hash downwards. Partners share a token of the prefix (the first
   n - ceil(0.8 n) + 1) under each of them.
4. Pairs that meet in a list of the rarity order, and pass the bounds by size and
   position, are verified: the prefixes of the other two orders must meet, then
   the sets are intersected (an intersection only holds shared shingles).
   Lists aren't expanded at once: first each class meets the least class it
   shares a list with, then, in lists that still hold several components, every
   member meets a few that a hash chooses, and last, members outside the list's
   largest component meet all of other ones (in parts of bounded size, each with a
   copy of the list, so that no list is one task's). Parity maps of the sets rule most
   pairs without a link out. Links within a component need no proof.

Every class pair that could link across components is verified, so components
are exact (up to 64-bit and, within a pair, 48-bit hash collisions).

Defined results: null text and text without words give an empty set, linked with
nothing; copies and repeated ids are rows of their own; a null id stays null and
counts for no component's name; an empty table gives no rows.
"""
from __future__ import annotations

from hashlib import blake2b, md5

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import (byte_words, drop_stage, forget_state, fresh, record_batch, shingle_hashes, slices,
                     stage, text_of)
from .components import components

PERCENT = 80
RUN = 4096
RUN_TOKENS = 500_000
#: Bits of a bucket's number: up to RUN_BITS runs have the size above, beyond it they
#: grow with the buckets, so that a run still sends several tokens to each.
RUN_BITS, MAX_BITS = 16, 20
TOKEN_BITS = 48
HOT_SHARE = 100_000
HOT_IN_RUN = 8
HOT_COUNT = 2 ** 31 - 1
#: Tokens of a bucket that are counted at once, and bytes of replies sent at once.
SETTLE_TOKENS = 4_000_000
REPLY_BYTES = 1 << 20

PACKED = "kind int, bucket int, base long, idx int, doc_id long, n long, sig binary, tokens binary, docs binary, key string"
REPLY = "base long, idx int, n long, tokens binary, docs binary, counts binary"
CLASS = "uid long, n long, unshared long, tokens binary, prefix array<long>, bits array<long>"
#: Words of 64 bits in a class's parity map: each shared token flips one bit, so
#: two maps differ in no more bits than the sets do in tokens.
MAP_WORDS = 8
#: Members of a list that all others meet in the second round.
CHOSEN = 8
#: Members outside a list's largest component that one key of the third round holds.
PART = 1024
DOC, TOKENS, HOT = 0, 1, 2


def _squeeze(values: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _widen(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.reshape(-1).view("<u8")


def _columns(schema: str) -> list[str]:
    return [f.split(" ")[0] for f in schema.split(", ")]


def _rows(schema: str, rows: list[dict]):
    return record_batch(schema, {c: [r.get(c) for r in rows] for c in _columns(schema)})


def _cuts(batches, rows: int = 512):
    """Short runs of rows, so that Python copies of them stay small; what a batch
    leaves behind goes back to the system before the next one."""
    for batch in batches:
        yield from slices([batch], rows)
        pa.default_memory_pool().release_unused()


def _bucket_bits(df: DataFrame) -> int:
    """Four buckets or more for each shuffle partition, so that what meets in
    one bucket shrinks as partitions are added."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(MAX_BITS, max(8, (4 * parts - 1).bit_length()))


def _run_size(bits: int) -> tuple[int, int]:
    """Most documents (numbered with 16 bits) and tokens of a run, but for its last document."""
    grow = 1 << max(0, bits - RUN_BITS)
    return min(RUN * grow, 1 << 16), RUN_TOKENS * grow


def row_key(doc_id, text: str) -> str:
    """What a row is known by outside this module; equal rows have equal keys."""
    return md5(f"{'null' if doc_id is None else doc_id}:{text}".encode()).hexdigest()


def _pack(df: DataFrame, bits: int) -> DataFrame:
    """Rows of a document (id, set size, digest of the set), of a run's tokens in a
    bucket, and of tokens that are frequent in a run."""
    low = TOKEN_BITS - bits
    width = -(-low // 8)
    most_docs, most_tokens = _run_size(bits)

    def flush(base, docs, sets):
        rows = [{"kind": DOC, "base": base, "idx": i, "doc_id": d, "key": k, "n": len(s),
                 "sig": blake2b(s.tobytes(), digest_size=16).digest()} for i, ((d, k), s) in enumerate(zip(docs, sets))]
        tokens = np.concatenate(sets) >> np.uint64(64 - TOKEN_BITS)
        owner = np.repeat(np.arange(len(sets), dtype=np.int64), [len(s) for s in sets])
        bucket = (tokens >> np.uint64(low)).astype(np.int64)
        order = np.argsort(bucket << 16 | owner, kind="stable")
        tokens, owner, bucket = tokens[order], owner[order], bucket[order]
        edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=1 << bits))
        payload = tokens & np.uint64((1 << low) - 1)
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            rows.append({"kind": TOKENS, "bucket": int(bucket[a]), "base": base,
                         "tokens": _squeeze(payload[a:b], width),
                         "docs": np.diff(owner[a:b], prepend=0).astype("<u2").tobytes()})
        found, times = np.unique(tokens, return_counts=True)
        often = times >= HOT_IN_RUN
        if often.any():
            rows.append({"kind": HOT, "base": base, "tokens": found[often].astype("<u8").tobytes(),
                         "docs": times[often].astype("<u4").tobytes()})
        return _rows(PACKED, rows)

    def run(batches):
        forget_state()
        part, runs = TaskContext.get().partitionId(), 0
        docs, sets, held = [], [], 0
        for cut in _cuts(batches, 64):
            for doc, text in zip(cut.column(0).to_pylist(), cut.column(1).to_pylist()):
                docs.append((doc, row_key(doc, text)))
                sets.append(shingle_hashes(byte_words(text)))
                held += len(sets[-1])
                if len(docs) == most_docs or held >= most_tokens:
                    yield flush((part << 24) + runs, docs, sets)
                    docs, sets, held, runs = [], [], 0, runs + 1
        if docs:
            yield flush((part << 24) + runs, docs, sets)

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(run, PACKED)


def _hot_tokens(packed: DataFrame, total: int) -> np.ndarray:
    """Tokens whose sums by run reach a 100,000th of all tokens: at most 100,000."""
    def unpack(batches):
        for batch in batches:
            for tokens, times in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield record_batch("token long, times long", {
                    "token": np.frombuffer(tokens, "<u8").astype(np.int64),
                    "times": np.frombuffer(times, "<u4").astype(np.int64)})

    hot = (packed.filter(F.col("kind") == HOT).select("tokens", "docs")
           .mapInArrow(unpack, "token long, times long")
           .groupBy("token").agg(F.sum("times").alias("times"))
           .filter(F.col("times") >= max(HOT_IN_RUN, total // HOT_SHARE)).select("token"))
    return np.sort(np.array([r[0] for r in hot.collect()], np.uint64))


def _count(packed: DataFrame, bits: int, hot: np.ndarray) -> DataFrame:
    """For each run and bucket the tokens that more than one document holds."""
    low = TOKEN_BITS - bits
    width = -(-low // 8)
    sent = "bucket int, base long, tokens binary, docs binary"

    def route(batches):
        """Split hot tokens off; their rows need no counting and go anywhere."""
        for batch in _cuts(batches):
            rows = []
            for bucket, base, data, docs in zip(*(c.to_pylist() for c in batch.columns)):
                tokens = _widen(data, width)
                full = tokens | np.uint64(bucket << low)
                at = np.minimum(np.searchsorted(hot, full), len(hot) - 1)
                is_hot = hot[at] == full
                if not is_hot.any():
                    rows.append({"bucket": bucket, "base": base, "tokens": data, "docs": docs})
                    continue
                owner = np.cumsum(np.frombuffer(docs, "<u2").astype(np.int64))
                for own, to in ((~is_hot, bucket), (is_hot, ~bucket)):
                    if own.any():
                        rows.append({"bucket": to, "base": base, "tokens": _squeeze(tokens[own], width),
                                     "docs": np.diff(owner[own], prepend=0).astype("<u2").tobytes()})
            yield _rows(sent, rows)

    def reply(base, tokens, owner, counts):
        return {"base": base, "tokens": _squeeze(tokens, 6), "docs": owner.astype("<u2").tobytes(),
                "counts": counts.astype("<u4").tobytes()}

    def settle(bucket, held):
        """Replies to the runs that sent tokens to one bucket, one range of tokens
        after another: only the packed tokens are held whole."""
        ranges = -(-sum(len(data) for _, data, _ in held) // (width * SETTLE_TOKENS))
        step = np.uint64(-(-(1 << low) // ranges))
        for k in range(ranges):
            parts = []
            for _, data, _ in held:
                part = _widen(data, width)
                own = part // step == k if ranges > 1 else slice(None)
                parts.append((part[own], own))
            found, place, times = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True, return_counts=True)
            counts, at = times[place], 0
            for (base, _, docs), (part, own) in zip(held, parts):
                mine = counts[at:at + len(part)]
                at += len(part)
                keep = mine >= 2
                if keep.any():
                    owner = np.cumsum(np.frombuffer(docs, "<u2").astype(np.int64))[own]
                    yield reply(base, part[keep] | np.uint64(bucket << low), owner[keep], mine[keep])

    def replies(batches):
        current, held = None, []
        for batch in _cuts(batches):
            for bucket, base, data, docs in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket < 0:
                    tokens = _widen(data, width) | np.uint64(~bucket << low)
                    owner = np.cumsum(np.frombuffer(docs, "<u2").astype(np.int64))
                    yield reply(base, tokens, owner, np.full(len(tokens), HOT_COUNT))
                    continue
                if bucket != current and held:
                    yield from settle(current, held)
                    held = []
                current = bucket
                held.append((base, data, docs))
        if held:
            yield from settle(current, held)

    def run(batches):
        out, size = [], 0
        for row in replies(batches):
            out.append(row)
            size += len(row["tokens"])
            if size >= REPLY_BYTES:
                yield _rows(REPLY, out)
                out, size = [], 0
        if out:
            yield _rows(REPLY, out)

    tokens = packed.filter(F.col("kind") == TOKENS).select("bucket", "base", "tokens", "docs")
    if len(hot):
        tokens = tokens.mapInArrow(route, sent)
    salt = F.when(F.col("bucket") < 0, F.col("base")).otherwise(F.lit(0))
    return tokens.repartition("bucket", salt).sortWithinPartitions("bucket").mapInArrow(run, REPLY)


def _needed(n: np.ndarray | int):
    return -(-n * PERCENT // 100)


def _parity_map(tokens: np.ndarray) -> list[int]:
    """The low bits of a token's lower half choose the bit that it flips."""
    flips = np.bincount((tokens % np.uint64(64 * MAP_WORDS)).astype(np.int64), minlength=64 * MAP_WORDS) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").view("<i8").tolist()


def _prefixes(replies: DataFrame, classes: DataFrame) -> DataFrame:
    """Classes with enough shared tokens: the sorted tokens and the rarity prefix."""
    def settle(sizes, tokens, owner, counts):
        order = np.lexsort((tokens, owner))
        tokens, owner, counts = tokens[order], owner[order], counts[order]
        at = np.array([idx for _, idx, _ in sizes], np.int64)
        starts, ends = np.searchsorted(owner, at).tolist(), np.searchsorted(owner, at, "right").tolist()
        rows = []
        for (base, idx, n), a, b in zip(sizes, starts, ends):
            shared = b - a
            if not shared or shared < _needed(n):
                continue
            own, times = tokens[a:b], counts[a:b]
            length = n - _needed(n) + 1 - (n - shared)
            rare = own[np.lexsort((own, times))[:length]]
            rows.append({"uid": (base << 16) + idx, "n": n, "unshared": n - shared, "tokens": _squeeze(own, 6),
                         "prefix": rare.astype(np.int64).tolist(), "bits": _parity_map(own)})
        return rows

    def run(batches):
        current, sizes, tokens, owner, counts = None, [], [], [], []

        def close():
            return settle(sizes, *map(np.concatenate, (tokens, owner, counts))) if sizes and tokens else []

        for batch in _cuts(batches):
            for base, idx, n, data, docs, times in zip(*(c.to_pylist() for c in batch.columns)):
                if base != current:
                    if rows := close():
                        yield _rows(CLASS, rows)
                    current, sizes, tokens, owner, counts = base, [], [], [], []
                if data is None:
                    sizes.append((base, idx, n))
                else:
                    tokens.append(_widen(data, 6))
                    owner.append(np.frombuffer(docs, "<u2").astype(np.int64))
                    counts.append(np.frombuffer(times, "<u4").astype(np.int64))
        if rows := close():
            yield _rows(CLASS, rows)

    sizes = classes.select(F.shiftright("rep", 16).alias("base"), (F.col("rep").bitwiseAND(65535)).cast("int").alias("idx"),
                           "n", *(F.lit(None).cast("binary").alias(c) for c in ("tokens", "docs", "counts")))
    return (sizes.unionByName(replies).repartition("base").sortWithinPartitions("base")
            .mapInArrow(run, CLASS))


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (x, y) that link: prefixes under both hash orders meet, and the
    sets' intersection is large enough."""
    schema = "x long, y long"

    def meets(a, b):
        return len(np.intersect1d(a, b, assume_unique=True)) > 0

    def run(batches):
        for batch in _cuts(batches):
            rows = []
            for x, y, nx, ny, ux, uy, tx, ty in zip(*(c.to_pylist() for c in batch.columns)):
                a, b = _widen(tx, 6), _widen(ty, 6)
                p, q = nx - _needed(nx) + 1 - ux, ny - _needed(ny) + 1 - uy
                if meets(a[:p], b[:q]) and meets(a[-p:], b[-q:]):
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    if 100 * both >= PERCENT * (nx + ny - both):
                        rows.append({"x": x, "y": y})
            if rows:
                yield _rows(schema, rows)

    def side(s):
        return sets.select(F.col("uid").alias(s), F.col("n").alias(f"n{s}"), F.col("unshared").alias(f"u{s}"),
                           F.col("tokens").alias(f"t{s}"))

    return (pairs.join(side("x"), "x").join(side("y"), "y")
            .select("x", "y", "nx", "ny", "ux", "uy", "tx", "ty").mapInArrow(run, schema))


def _may_link(a: str, b: str) -> str:
    """Bounds by size and by position of a common token (``n``, ``pos`` of each)."""
    return (f"100 * least({a}.n, {b}.n) >= {PERCENT} * greatest({a}.n, {b}.n) AND "
            f"{100 + PERCENT} * least({a}.n - {a}.pos, {b}.n - {b}.pos) >= {PERCENT} * ({a}.n + {b}.n)")


def _maps_allow(a: str, b: str) -> str:
    """Bound by parity maps: the sets differ by both their unshared tokens and by
    as many shared ones as bits differ (``unshared``, ``bits`` of each)."""
    differ = " + ".join(f"bit_count({a}.bits[{k}] ^ {b}.bits[{k}])" for k in range(MAP_WORDS))
    return (f"{100 + PERCENT} * ({a}.n + {b}.n - {a}.unshared - {b}.unshared - ({differ})) "
            f">= {2 * PERCENT} * ({a}.n + {b}.n)")


def _merge(labels: DataFrame | None, edges: DataFrame) -> DataFrame:
    """(uid, comp) of classes in components of two or more, after new edges."""
    if labels is None:
        found = components(edges)
        return found.select(F.col("node").alias("uid"), F.col("component").alias("comp"))
    at = {s: labels.select(F.col("uid").alias(s), F.col("comp").alias(f"c{s}")) for s in "xy"}
    joined = (edges.join(at["x"], "x", "left").join(at["y"], "y", "left")
              .select(F.coalesce("cx", "x").alias("x"), F.coalesce("cy", "y").alias("y")))
    moved = components(joined)
    changed = labels.join(moved, labels["comp"] == moved["node"], "left").select(
        "uid", F.coalesce("component", "comp").alias("comp"))
    fresh = moved.join(labels, moved["node"] == labels["uid"], "left_anti").select(
        F.col("node").alias("uid"), F.col("component").alias("comp"))
    return changed.unionByName(fresh)


def _mixed(lists: DataFrame, labels: DataFrame, sets: DataFrame) -> tuple[DataFrame, str]:
    """The lists that hold several components: members ``m``, a size class (partners
    are at most one apart), whether they stand outside the list's largest one, and
    in how many parts those outside are dealt."""
    marked = lists.join(labels, "uid", "left").withColumn("comp", F.coalesce("comp", "uid"))
    largest = (marked.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("k"))
               .groupBy("token").agg(F.max_by("comp", "k").alias("top"), F.count(F.lit(1)).alias("comps"),
                                     (F.sum("k") - F.max("k")).alias("outside"))
               .filter("comps > 1").select("token", "top", F.ceil(F.col("outside") / PART).alias("parts")))
    size = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / PERCENT))).cast("int")
    return stage(marked.join(largest, "token").join(sets.select("uid", "unshared", "bits"), "uid")
                 .select("token", size.alias("size"), (F.col("comp") != F.col("top")).alias("minor"), "parts",
                         F.struct("uid", "n", "pos", "comp", "unshared", "bits").alias("m")))


def _pairs(joined: DataFrame) -> DataFrame:
    """Distinct (x, y) of members ``a`` and ``b`` in different components that
    may link by all bounds."""
    return (joined.filter("a.comp <> b.comp").filter(_may_link("a", "b")).filter(_maps_allow("a", "b"))
            .select(F.least("a.uid", "b.uid").alias("x"), F.greatest("a.uid", "b.uid").alias("y")).distinct())


def _link(sets: DataFrame) -> DataFrame:
    """(uid, comp) of classes that link with another one, least uid left out."""
    spark = sets.sparkSession
    lists, lists_path = stage(sets.select("uid", "n", "unshared", F.posexplode("prefix").alias("i", "token"))
                              .select("token", "uid", "n", (F.col("unshared") + F.col("i")).alias("pos")))

    # 1: each class and the least class that shares a list with it
    least = (lists.groupBy("token").agg(F.min(F.struct("uid", "n", "pos")).alias("b"), F.count(F.lit(1)).alias("k"))
             .filter("k > 1").select("token", "b"))
    stars = (lists.join(least, "token").select(F.struct("uid", "n", "pos").alias("a"), "b")
             .filter("a.uid <> b.uid").filter(_may_link("a", "b"))
             .groupBy(F.col("a.uid").alias("y")).agg(F.min("b.uid").alias("x")))
    labels, first_path = stage(_merge(None, _verify(stars, sets)))

    # 2: all members of a list and a few chosen by hash; joins what a large group
    # of near copies leaves apart, by as many pairs as there are members
    mixed, mixed_path = _mixed(lists, labels, sets)
    chosen = mixed.groupBy("token").agg(F.array(*(
        F.min_by("m", F.xxhash64("m.uid", F.lit(k))) for k in range(CHOSEN))).alias("chosen"))
    met, met_path = stage(_pairs(mixed.select("token", F.col("m").alias("a")).join(chosen, "token")
                                 .select("a", F.explode(F.array_distinct("chosen")).alias("b"))))
    labels, second_path = stage(_merge(labels, _verify(met, sets)))
    drop_stage(spark, first_path, mixed_path, met_path)

    # 3: whatever may still link across components
    mixed, mixed_path = _mixed(lists, labels, sets)
    outside = (mixed.filter("minor")
               .select("token", F.col("m").alias("a"), F.pmod(F.xxhash64("m.uid"), F.col("parts")).alias("part"),
                       F.explode(F.array(*(F.col("size") + d for d in (-1, 0, 1)))).alias("size")))
    others = mixed.select("token", "size", "minor", F.col("m").alias("b"),
                          F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    rest, rest_path = stage(_pairs(outside.join(others, ["token", "size", "part"]).filter("NOT minor OR a.uid < b.uid")))
    labels, _ = stage(_merge(labels, _verify(rest, sets)))
    drop_stage(spark, lists_path, mixed_path, rest_path, second_path)
    return labels


def link_documents(df: DataFrame) -> DataFrame:
    """One row for each document: doc_id, n_shingles, component_id (the smallest
    doc_id reachable by links, itself included), ``row`` (a number of its own),
    ``key`` (see ``row_key``) and ``keep`` (one row of each component, the one with the least number, ids of
    the least doc_id first; rows without words are all kept)."""
    spark = df.sparkSession
    bits = _bucket_bits(df)
    packed, packed_path = stage(_pack(df, bits))
    docs, _ = stage(packed.filter(F.col("kind") == DOC).select(
        (F.shiftleft("base", 16) + F.col("idx")).alias("row"), "doc_id", "key", "n", "sig"))
    total = docs.agg(F.sum("n")).first()[0] or 0
    classes, _ = stage(docs.filter("n > 0").groupBy("sig").agg(
        F.min("row").alias("rep"), F.first("n").alias("n"),
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")))
    hot = _hot_tokens(packed, total)
    sets, sets_path = stage(_prefixes(_count(packed, bits, hot), classes))
    drop_stage(spark, packed_path)
    labels = _link(sets)
    drop_stage(spark, sets_path)
    named = (classes.join(labels, classes["rep"] == labels["uid"], "left")
             .select("sig", "first", F.coalesce("comp", "rep").alias("comp")))
    names = named.groupBy("comp").agg(F.min("first").alias("name"))
    by_class = named.join(names, "comp").select("sig", "name")
    linked = docs.filter("n > 0").join(by_class, "sig").select(
        "row", "key", "doc_id", F.col("n").alias("n_shingles"), F.col("name.doc_id").alias("component_id"),
        (F.col("row") == F.col("name.row")).alias("keep"))
    alone = docs.filter("n = 0").select(
        "row", "key", "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(True).alias("keep"))
    return linked.unionByName(alone)


def deduplicate(df: DataFrame) -> DataFrame:
    """The rows of ``df``, with all their columns, that ``link_documents`` keeps;
    of rows with equal id and text one stays."""
    key, nth = fresh(df, "key_"), fresh(df, "nth_")
    kept = link_documents(df).filter("keep").select(F.col("key").alias(key))
    keyed = df.withColumn(key, F.md5(F.concat(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), text_of())))
    first = F.row_number().over(Window.partitionBy(key).orderBy(key))
    return (keyed.join(kept, key, "left_semi").withColumn(nth, first).filter(F.col(nth) == 1)
            .select(*[F.col(f"`{c}`") for c in df.columns]))
