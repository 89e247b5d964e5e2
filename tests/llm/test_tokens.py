"""Token operators against the tokenizer libraries and exact round trips."""
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest

from retail_signals.llm import binary_output, bpe, packing, token_count
from retail_signals.llm.queries import JSON, PATTERN, PIECES, QUERIES, RANKS
from retail_signals.llm.units import ByteBpe

PARTS = [" ", "  ", "\n", "\n\n", " \n", "a", "cd", "é", "日本", "\t", "\xa0", "\x1c", "'s", "'", "'r", "e",
         "1", "23", ".", "--", "▁", "<s>", "<|endoftext|>", "\r", "\x85", "😀", "the", "\0", "ſ"]


def fuzz(n, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.choice([0, 1, 2, 5, 10, 60, 300]))) for _ in range(n)]


@pytest.fixture(scope="module")
def ranks():
    return ByteBpe(RANKS, PATTERN)


def test_units_and_tree_equal_the_library(ranks):
    texts = fuzz(800)
    expected = [np.array(ranks.library.encode_ordinary(t), "<u4").tobytes() for t in texts]
    assert ranks.encode(texts) == expected
    for leaf, window in ((2048, 16), (5, 1), (20, 2)):
        tree = bpe.TreeBpe(ranks, leaf, window)
        assert [tree.encode(t) for t in texts] == expected
        assert [tree.decode(np.frombuffer(e, "<u4")) for e in expected] == [t.encode() for t in texts]


def test_long_text_without_spaces(ranks):
    text = "ab" * 30_000 + "é" * 5_000
    assert bpe.TreeBpe(ranks).encode(text) == np.array(ranks.library.encode_ordinary(text), "<u4").tobytes()


def test_special_strings_follow_the_json_tokenizer():
    both = ByteBpe(RANKS, PATTERN, JSON)
    texts = fuzz(400, 2)
    full = [np.array(both.full.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert both.encode(texts) == full


def test_cache_that_overflows():
    small = ByteBpe(RANKS, PATTERN, room=5)
    for t in fuzz(60, 3):
        assert small.encode([t])[0] == np.array(small.library.encode_ordinary(t), "<u4").tobytes()


def test_counts_equal_the_library_for_any_chunk_size():
    counter = token_count.PieceCounter(PIECES)
    assert counter.splits
    texts = fuzz(600, 4)
    expected = [len(i) for i in counter.library.encode(texts, num_threads=1)]
    for size, overlap in ((16_384, 256), (7, 1), (30, 3)):
        assert counter.count(texts, size, overlap) == expected


def test_chunks_resynchronise_or_widen(monkeypatch):
    """Texts with the marker, without spaces, of one letter; overlaps that hold no
    common token are widened, at last to the whole text."""
    counter = token_count.PieceCounter(PIECES)
    rnd = random.Random(9)
    texts = ["a" * n for n in (50, 99, 500)] + ["ab" * 300, "▁" * 400, " " * 401, "\n" * 333, "\0" * 200, "日本語" * 200,
                                               "Ａ" * 150, "😀é" * 200]
    texts += ["".join(rnd.choice("aab▁ ") for _ in range(900)) for _ in range(40)]
    texts += ["".join(rnd.choice(["in", "ter", "nation", "al", "ization", "s"]) for _ in range(400)) for _ in range(40)]
    chunks, wholes = [], []
    chunk, whole = counter.chunk, counter.whole
    monkeypatch.setattr(counter, "chunk", lambda t, base: chunks.append(len(t)) or chunk(t, base))
    monkeypatch.setattr(counter, "whole", lambda t: wholes.append(len(t)) or whole(t))
    plain = 0
    for size, overlap in ((16, 2), (60, 8), (200, 40)):
        for t in texts:
            if len(t) > size:
                assert counter.huge(t, size, overlap) == len(counter.library.encode(t)), (t[:50], size)
                plain += -(-len(t) // size)
    assert len(chunks) > plain          # some chunks were encoded again with a wider overlap
    assert 0 < len(wholes) < 100        # few texts never met
    assert max(chunks) <= 200 + 200 + 40


def test_a_huge_text_is_encoded_in_overlapping_chunks(monkeypatch):
    counter = token_count.PieceCounter(PIECES)
    text = "".join(fuzz(4000, 8))
    assert len(text) > 150_000 and "▁" in text and "\0" in text
    sizes, chunk = [], counter.chunk
    monkeypatch.setattr(counter, "chunk", lambda t, base: sizes.append(len(t)) or chunk(t, base))
    monkeypatch.setattr(counter, "whole", None)
    assert counter.huge(text, 16_384, 256) == len(counter.library.encode(text))
    assert sum(sizes) > len(text) and max(sizes) == 16_384 + 256


DOCS = [(1, "the cat sat " * 900), (2, None), (3, ""), (4, "x"), (4, "x"), (None, "null id"), (5, "word " * 3000),
        *((100 + i, "some words here " * (i % 40)) for i in range(80))]


def frame(spark, rows=DOCS):
    """Documents with further columns whose names clash with results."""
    return spark.createDataFrame([(i, t, 7, "z") for i, t in rows], "doc_id long, text string, start long, ids string") \
        .repartition(3)


def ids_of(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(JSON).encode(text or "", add_special_tokens=False).ids + [1]


def test_packing_is_lossless_and_tight(spark):
    rows = packing.pack_documents(frame(spark), RANKS, PATTERN, JSON, length=64, max_open=8).collect()
    by_seq, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"]
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"]].append((r["start"], ids.tolist()))
    for pieces in by_seq.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64
    unique = [i for i, _ in DOCS if i != 4]
    for i, text in DOCS:
        if i in unique:
            assert [x for _, p in sorted(by_doc[i]) for x in p] == ids_of(text)
    assert sorted(p for _, p in by_doc[4]) == [ids_of("x")] * 2
    total = sum(r["length"] for r in rows)
    assert len(by_seq) * 64 - total <= 64 * 3 + 8 * len(by_seq)
    assert packing.pack_documents(frame(spark, DOCS[:0]), RANKS, PATTERN, JSON).count() == 0


def test_sum_of_squares_takes_the_least_level():
    rnd = random.Random(9)
    packer = packing.SumOfSquares(12, 1000, 0, 0)
    for k in range(300):
        size = rnd.randint(1, 11)
        n = packer.count.copy()

        def cost(level):
            after = n.copy()
            if level:
                after[level] -= 1
            if level + size < 12:
                after[level + size] += 1
            return int((after[1:12] ** 2).sum())

        allowed = [h for h in range(12) if (h == 0 or n[h]) and h + size <= 12]
        assert cost(packer.level_for(size)) == min(map(cost, allowed))
        packer.add(k, bytes(4 * size))


def test_dissolved_sequences_are_placed_by_the_same_rule():
    rnd = random.Random(3)
    for slack in (0, 2):
        packer = packing.SumOfSquares(12, 40, slack, 0)
        sizes = [rnd.randint(0, 40) for _ in range(400)]
        closed = [p for k, size in enumerate(sizes) for p in packer.add(k, bytes(4 * size))]
        assert packer.n_open <= 40 and packer.n_open == packer.count.sum()
        for size in range(1, 12):
            n, level = packer.count.copy(), packer.level_among(size)

            def cost(h):
                after = n.copy()
                after[h] -= 1
                after[min(12, h + size)] += 1
                return int((after[1:12] ** 2).sum())

            fits = [h for h in range(1, 12) if n[h] and h + size <= 12] or [h for h in range(1, 12) if n[h]]
            assert level == max(fits, key=lambda h: (-cost(h), h))
        closed += packer.drain(5)
        assert packer.n_open <= 5
        closed += packer.drain(0)
        assert not packer.n_open and not packer.count.any()
        full, parts = defaultdict(int), defaultdict(list)
        for doc, start, ids, total, seq, at in closed:
            assert at == full[seq] and total == sizes[doc]
            full[seq] += len(ids) // 4
            parts[doc].append((start, len(ids) // 4))
        assert max(full.values()) <= 12 and sum(full.values()) == sum(sizes)
        assert sum(x < 12 - slack for x in full.values()) <= 1
        for doc, own in parts.items():
            at = 0
            for start, size in sorted(own):
                assert start == at and size
                at += size
            assert at == sizes[doc]


def test_best_fit_rows_against_brute_force(spark):
    rnd = random.Random(5)
    for _ in range(100):
        length = rnd.randint(1, 20)
        sizes = [rnd.randint(1, length) for _ in range(rnd.randint(0, 40))]
        room = []
        for s in sorted(sizes, reverse=True):
            fit = [r for r in room if r >= s]
            if fit:
                room[room.index(min(fit))] -= s
            else:
                room.append(length - s)
        got = binary_output.best_fit_decreasing(sizes, length)
        assert sorted(length - sum(sizes[i] for i in row) for row in got) == sorted(room)
    rows = binary_output.packed_rows(frame(spark), RANKS, PATTERN, JSON, length=64, block_tokens=2000).collect()
    pieces = defaultdict(list)
    for r in rows:
        ids, places = np.frombuffer(r["input_ids"], "<u4"), np.frombuffer(r["position_ids"], "<u4")
        assert len(ids) == len(places) == 64 and r["cu_seqlens"][-1] == r["n_tokens"]
        for doc, start, a, b in zip(r["doc_ids"], r["doc_starts"], r["cu_seqlens"], r["cu_seqlens"][1:]):
            assert places[a:b].tolist() == list(range(b - a))
            pieces[doc].append((start, ids[a:b].tolist()))
    for i, text in DOCS:
        if i != 4:
            assert [x for _, p in sorted(pieces[i]) for x in p] == ids_of(text)


def check_matrices(rows, texts, length, pad):
    """Padded matrices, their checksums and, by document, the ids laid end to end."""
    pieces = defaultdict(list)
    for r in rows:
        ids, places = (np.frombuffer(r[c], "<u4") for c in ("input_ids", "position_ids"))
        assert len(ids) == len(places) == length
        assert (ids[r["n_tokens"]:] == pad).all() and not places[r["n_tokens"]:].any()
        assert (zlib.crc32(r["input_ids"]), zlib.crc32(r["position_ids"])) == (r["ids_crc32"], r["positions_crc32"])
        for doc, start, a, b in zip(r["doc_ids"], r["doc_starts"], r["cu_seqlens"], r["cu_seqlens"][1:]):
            pieces[doc].append((start, ids[a:b].tolist()))
    assert pieces.keys() == texts.keys()
    for doc, text in texts.items():
        assert [x for _, p in sorted(pieces[doc]) for x in p] == ids_of(text)


def test_best_fit_query_returns_its_matrices(spark):
    small = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    check_matrices(QUERIES["op8_best_fit_rows"](spark, small).collect(), docs, 2048, 0)


def test_written_matrices_read_back(spark, tmp_path):
    docs = {i: t for i, t in DOCS if i != 4}
    path = f"{tmp_path}/packed"
    for _ in range(2):  # the second write replaces the first
        binary_output.write_packed(frame(spark, list(docs.items())), path, ranks_path=RANKS, pattern=PATTERN, json=JSON,
                                   length=64, pad_id=9, block_tokens=2000)
    check_matrices(spark.read.parquet(path).collect(), docs, 64, 9)


def test_digest_queries_on_edge_rows(spark):
    out = {r["doc_id"]: r for r in bpe.round_trip_digests(frame(spark), RANKS, PATTERN).collect()}
    assert len(out) == len({i for i, _ in DOCS})
    for i, text in DOCS:
        assert out[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    full = bpe.encode_documents(frame(spark), RANKS, PATTERN).filter("doc_id = 1").first()
    assert hashlib.sha256(full["ids"]).hexdigest() == out[1]["ids_sha256"] and bytes(full["decoded"]) == b"the cat sat " * 900
    counts = {r["doc_id"]: r for r in token_count.count_tokens(frame(spark), PIECES).collect()}
    assert counts[2]["n_tokens"] == counts[3]["n_tokens"] == 0 and counts[None]["n_bytes"] == 7
    assert P.path("piece_bpe_32k.model") == PIECES
