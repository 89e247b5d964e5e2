"""Certified packing, spelling variants and hard negatives against brute force."""
import collections
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from retail_signals.llm import certified_packing, hard_negatives, spelling
from retail_signals.llm.queries import JSON, PATTERN, QUERIES, RANKS
from retail_signals.llm.sql import ORACLE_SQL


# packing
def fewest(sizes, length):
    """The least number of sequences, by trying all ways (few pieces)."""
    best = len(sizes)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for r in {room: k for k, room in enumerate(rooms) if room >= sizes[i]}.values():
            place(i + 1, rooms[:r] + [rooms[r] - sizes[i]] + rooms[r + 1:])
        place(i + 1, rooms + [length - sizes[i]])

    sizes = sorted(sizes, reverse=True)
    place(0, [])
    return best


def test_bounds_never_pass_the_least_count():
    rnd = random.Random(1)
    tight = 0
    for _ in range(300):
        length = rnd.choice([12, 30, 100])
        sizes = [rnd.randint(1, rnd.choice([length, length // 2])) for _ in range(rnd.randint(0, 9))]
        least = fewest(sizes, length)
        bound = certified_packing.lower_bound(*np.unique(np.array(sizes, int), return_counts=True), length)
        rows, certified = certified_packing.pack(sizes, length)
        assert bound <= least <= len(rows)
        assert not certified or len(rows) == least
        assert sorted(i for r in rows for i in r) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in r) <= length for r in rows)
        tight += certified
    assert tight > 200


@pytest.mark.parametrize("size, each", [(683, 2), (1025, 1), (513, 3), (1024, 2)])
def test_dual_feasible_functions_beat_the_volume_bound(size, each):
    assert certified_packing.lower_bound(np.array([size]), np.array([60]), 2048) == 60 // each


def documents(spark, rows, partitions=4):
    return spark.createDataFrame(rows, "doc_id long, text string, `a.b` string, piece string, open string",
                                 ).repartition(partitions)


def check_pieces(out, rows, length):
    """Every id once, cut only where a document is too long, sequences gapless."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(JSON)
    want = collections.Counter()
    for doc, text, *_ in rows:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        first = len(ids) % length or length
        cuts = [0, *range(first, len(ids), length), len(ids)]
        want.update((doc, n, a, b - a, ids[a:b].tobytes()) for n, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, bytes(r.ids)) for r in out) == want
    sequences = collections.defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, size in sorted(places):
            assert offset == at
            at += size
        assert at <= length
    return len(sequences)


def test_partitions_exchange_documents_until_the_bound(spark):
    rnd = random.Random(4)
    rows = [(i, " ".join(rnd.choice(["one", "twelve", "naïve", "x9"]) for _ in range(rnd.choice([3, 20, 70, 300]))),
             "", "p", "o") for i in range(400)]
    rows += [(None, None, None, None, None), (7, "", "", "", ""), (7, "same", "", "", ""), (7, "same", "", "", "")]
    df = documents(spark, rows)
    settings = dict(length=128, block_tokens=2000)
    out = certified_packing.pack_certified(df, RANKS, PATTERN, JSON, **settings)
    n = check_pieces(out.collect(), rows, 128)
    first = certified_packing._first_round(df, "long", RANKS, PATTERN, JSON, 0, 128, 2000)
    bound = certified_packing.table_bound(out, 128)
    alone = first.filter("offset = 0").count()
    assert bound <= n < alone and n <= bound + 2


def test_packing_of_no_rows_and_of_one(spark):
    empty = documents(spark, [(1, "x", "", "", "")]).filter("doc_id > 1")
    assert certified_packing.pack_certified(empty, RANKS, PATTERN, JSON).count() == 0
    one = certified_packing.pack_certified(documents(spark, [(1, None, "", "", "")], 1), RANKS, PATTERN, JSON)
    assert [(r.doc_id, r.length, r.offset, r.certified) for r in one.collect()] == [(1, 1, 0, True)]


def test_one_very_long_document(spark):
    rows = [(5, "word " * 30000, "", "", ""), (6, "é" * 9000, "", "", "")]
    out = certified_packing.pack_certified(documents(spark, rows, 2), RANKS, PATTERN, JSON).collect()
    assert check_pieces(out, rows, 2048) == math.ceil(sum(r.length for r in out) / 2048)


# spelling
def near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)):] == b[k + 1:]


def brute_words(rows):
    count = collections.Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += len(run) >= 7
    return {w: n for w, n in count.items() if n >= 2}


def brute_forms(words, factor=10):
    forms, degree = {}, {}
    for w, n in words.items():
        others = [v for v in words if near(w, v)]
        degree[w] = len(others)
        best = min(others, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= factor * n else None
    out = set()
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.add((w, forms[w], root, n, degree[w], words[forms[w]] if forms[w] else None))
    return out


def texts(seed, docs=120):
    """Texts over few stems with edits, so that chains and ties of forms occur."""
    rnd = random.Random(seed)
    stems = ["Receive", "occurrence", "Àllelujah", "separate", "aaaaaaaa", "abababab", "straßenbau", "definitely"]
    rows = []
    for i in range(docs):
        words = []
        for _ in range(rnd.choice([0, 5, 60])):
            w = rnd.choice(stems if rnd.random() < .9 else stems[:2])
            for _ in range(rnd.choice([0, 0, 0, 0, 0, 0, 1, 1, 2])):
                k = rnd.randrange(len(w) + 1)
                w = w[:k] + rnd.choice(["", "a", "E", "ß"]) + w[k + rnd.choice([0, 1]):]
            words.append(w)
        rows.append((rnd.choice([i, i, 3]), rnd.choice([" ", ", ", "1", "—", "\n"]).join(words)))
    return rows + [(None, None), (None, "receive receive Receive"), (4, ""), (9, "a" * 40000 + " " + "a" * 40001),
                   (10, "a" * 40000 + " " + "a" * 40001), (11, "×÷×÷×÷×÷ ×÷×÷×÷×÷")]


@pytest.mark.parametrize("key_pairs", [4096, 1])
def test_variants_against_brute_force(spark, key_pairs):
    rows = texts(8)
    df = spark.createDataFrame([(i, t, "w", 5) for i, t in rows], "doc_id long, text string, word string, n int")
    out = spelling.group_variants(df.repartition(3), key_pairs=key_pairs).collect()
    want = brute_forms(brute_words(rows))
    got = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in out]
    assert len(got) == len(set(got)) and set(got) == want
    assert sum(f is not None for _, f, *_ in want) > 10 and max(w[4] for w in want) > 10


def test_a_hot_chunk_is_cut_again(spark):
    """All words share their first half; every link is still found once."""
    words = ["prefixes" + "".join(p) for p in itertools.product("abcd", repeat=4)]
    frame = spark.createDataFrame([(i, w, 2) for i, w in enumerate(words)], "id long, word string, n long")
    pairs = spelling.near_pairs(frame, key_pairs=50)[0].select("a", "b").collect()
    want = {(a, b) for a in words for b in words if a < b and near(a, b)}
    assert len(pairs) == len(want) and {tuple(sorted(p)) for p in pairs} == want


def test_forms_are_followed_to_the_last(spark):
    chain = ["w%d" % i for i in range(14)]
    forms = spark.createDataFrame(list(zip(chain, chain[1:])), "word string, form string")
    assert {tuple(r) for r in spelling._roots(forms)[0].collect()} == {(w, "w13") for w in chain[:-1]}


def test_variants_of_no_words(spark):
    for rows in ([(1, "short words only")], [(1, None)]):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        assert spelling.group_variants(df).count() == 0
    assert spelling.group_variants(df.filter("doc_id > 1")).count() == 0


# negatives
def test_products_are_exact_for_any_size():
    rnd = np.random.default_rng(3)
    for top, width in ((3, 5), (146, 64), (10**6, 3000), (2**40, 70)):
        a, b = (rnd.integers(-top, top + 1, (7, width)).astype(float) for _ in range(2))
        a[0], b[0], b[1] = top, top, -top
        primes = hard_negatives.primes_for(width * top * top)
        got = hard_negatives.residue_product([hard_negatives.residues(a, p) for p in primes],
                                             [hard_negatives.residues(b, p) for p in primes], primes)
        want = a.astype(int).astype(object) @ b.astype(int).astype(object).T
        assert [list(map(int, r)) for r in got] == [list(map(int, r)) for r in want]


def brute_negatives(rows, positives=5, negatives=10):
    def sound(label, vector):
        return label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector)

    rows = [(i, label, [math.floor(256 * x) for x in vector]) for i, label, vector in rows if sound(label, vector)]
    order = lambda f: (-f[0], f[1] is None, f[1] or 0)
    out = []
    for a, (i, label, vector) in enumerate(rows):
        if i is None or i % 100:
            continue
        scored = [(sum(x * y for x, y in zip(vector, v)), j, m == label) for b, (j, m, v) in enumerate(rows) if b != a]
        for score, j, _ in sorted((s for s in scored if s[2]), key=order)[:positives]:
            hard = [s for s in scored if not s[2] and 30 * score <= 100 * s[0] <= 90 * score]
            out += [(i, j, k, n, score, s) for k, (s, n, _) in enumerate(sorted(hard, key=order)[:negatives], 1)]
    return collections.Counter(out)


def vectors(n, seed, width=6):
    rnd = random.Random(seed)
    rows = [(i * 10, rnd.randrange(3), [round(rnd.gauss(.2, .5), 1) for _ in range(width)]) for i in range(n)]
    rows += [(i, 1, [.5] * width) for i in range(1, 40)]  # one common vector: ties
    odd = [(100, None, [.1] * width), (200, 1, None), (300, 2, [.1, None, .3]), (400, 0, [math.nan] * width),
           (401, 0, [math.inf] + [.5] * 5), (None, 1, [.4] * width), (500, 1, []), (600, 2, [.5, .5]),
           (600, 2, [.5, .5]), (700, 7, [.5] * width), (-100, 1, [-.5] * width)]
    return rows + odd


@pytest.mark.parametrize("block_values", [524288, 120])
def test_negatives_against_brute_force(spark, block_values):
    rows = vectors(150, 2)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows],
                               "vec_id long, label int, embedding array<double>, row int, anchor string").repartition(3)
    out = hard_negatives.mine(df, F.col("vec_id") % 100 == 0, block_values=block_values, tile=4).collect()
    want = brute_negatives(rows)
    assert collections.Counter(map(tuple, out)) == want and len(want) > 300


def test_scores_beyond_64_bits_keep_their_order(spark):
    rows = [(0, 1, [2.0**40, 1.0]), (1, 1, [2.0**40, 0.0]), (2, 2, [2.0**39, 0.0]), (3, 2, [2.0**39, 2.0**30]),
            (4, 2, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    out = hard_negatives.mine(df, F.col("vec_id") % 100 == 0).orderBy("rank").collect()
    assert [(r.positive_id, r.rank, r.negative_id, r.positive_score) for r in out] == [(1, 1, 3, None), (1, 2, 2, None)]


def test_negatives_of_no_rows_or_anchors(spark):
    df = spark.createDataFrame([(1, 1, [.5])], "vec_id long, label int, embedding array<float>")
    assert hard_negatives.mine(df, F.col("vec_id") % 100 == 0).count() == 0
    assert hard_negatives.mine(df.filter("vec_id > 1"), F.col("vec_id") % 100 == 0).count() == 0


def test_negatives_sql_gives_the_same_rows(spark, tmp_path):
    rows = [r for r in vectors(150, 5) if r[0] is not None and (r[2] is None or len(r[2]) == 6)]
    schema = "vec_id long, label int, embedding array<float>"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = QUERIES["op13_residue_negatives"](spark, str(tmp_path))
    db = duckdb.connect()
    db.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = db.sql(ORACLE_SQL["op13_residue_negatives"])
    assert want.columns == got.columns
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(want.fetchall())
    assert got.count() > 100


def test_large_components_round_down():
    assert list(hard_negatives._matrix(pa.array([[-.001, .999]]), 256.0, 3)[0]) == [-1, 255, 0]
