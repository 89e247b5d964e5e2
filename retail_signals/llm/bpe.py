"""Byte-level BPE encoding and decoding by monoid tree reduction.

A text is cut into halves until a leaf is short; leaves are encoded, and two
neighbours are joined by encoding a window around their common edge anew. The
window grows until both its ends are positions where the pre-tokenizer pattern
must end a match whatever stands around them; there the ids left and right of
the window are proven to be those of the joined text. Decoding concatenates the
bytes of the leaves up the same tree.

Defined results: null text counts as empty (no ids); a null id stays null; rows
are independent, so copies and repeated ids each give their row; an empty table
gives no rows; other input columns are not read.
"""
from __future__ import annotations

import hashlib
import unicodedata

import numpy as np
from pyspark.sql import DataFrame

from .common import map_texts, worker_state
from .units import ByteBpe

SCHEMA = "n_tokens long, ids binary, decoded binary"


def char_class(c: str) -> str:
    """W space, tab or line end; L letter, N number, O other; "" where Unicode
    versions could disagree or for rarer white space."""
    if c in " \t\n\r":
        return "W"
    if c.isspace() or not c.isprintable():
        return ""
    kind = unicodedata.category(c)[0]
    if unicodedata.ucd_3_2_0.category(c)[0] != kind:
        return ""
    return kind if kind in "LN" else "" if kind == "Z" else "O"


#: Between these classes every match ends: only a space may precede another
#: class inside a match, and only a contraction joins other to letter.
STABLE = frozenset(("LW", "NW", "OW", "LN", "NL", "LO", "NO", "ON"))


def stable(text: str, at: int) -> bool:
    return char_class(text[at - 1]) + char_class(text[at]) in STABLE


class TreeBpe:
    """Encode by halves and join; ``base`` encodes short texts to id bytes."""

    def __init__(self, base: ByteBpe, leaf: int = 2048, window: int = 16):
        self.base, self.leaf, self.window = base, leaf, window

    def one(self, text: str) -> bytes:
        return self.base.encode([text])[0]

    def join(self, text: str, lo: int, mid: int, hi: int, left: bytes, right: bytes) -> bytes:
        """Ids of text[lo:hi] from those of text[lo:mid] and text[mid:hi]."""
        reach, a, b = self.window, None, None
        while a is None or b is None:
            if a is None:
                a = next((p for p in range(mid - 1, max(lo, mid - reach), -1) if stable(text, p)), None)
                if a is None and mid - reach <= lo:
                    a = lo
            if b is None:
                b = next((p for p in range(mid + 1, min(hi, mid + reach)) if stable(text, p)), None)
                if b is None and mid + reach >= hi:
                    b = hi
            reach *= 2
        tail, head, joined = self.base.encode([text[a:mid], text[mid:b], text[a:b]])
        return left[:len(left) - len(tail)] + joined + right[len(head):]

    def encode(self, text: str, lo: int = 0, hi: int | None = None) -> bytes:
        hi = len(text) if hi is None else hi
        if hi - lo <= self.leaf:
            return self.one(text[lo:hi])
        mid = (lo + hi) // 2
        return self.join(text, lo, mid, hi, self.encode(text, lo, mid), self.encode(text, mid, hi))

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) <= self.leaf:
            return self.base.library.decode_bytes(ids.tolist())
        mid = len(ids) // 2
        return self.decode(ids[:mid]) + self.decode(ids[mid:])


def _tree(ranks_path: str, pattern: str, leaf: int) -> TreeBpe:
    return worker_state(f"tree:{ranks_path}:{leaf}", lambda: TreeBpe(ByteBpe(ranks_path, pattern), leaf))


def encode_documents(df: DataFrame, ranks_path: str, pattern: str, leaf: int = 2048) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) and the bytes that
    they decode to, for every whole text."""
    def kernel(texts):
        bpe = _tree(ranks_path, pattern, leaf)
        ids = [bpe.encode(t) for t in texts]
        return {"n_tokens": [len(i) // 4 for i in ids], "ids": ids,
                "decoded": [bpe.decode(np.frombuffer(i, "<u4")) for i in ids]}

    return map_texts(df, kernel, SCHEMA)


def round_trip_digests(df: DataFrame, ranks_path: str, pattern: str, leaf: int = 2048) -> DataFrame:
    """The same as digests taken in the worker: SHA-256 of ids and of decoded bytes."""
    def kernel(texts):
        bpe = _tree(ranks_path, pattern, leaf)
        ids = [bpe.encode(t) for t in texts]
        return {"n_tokens": [len(i) // 4 for i in ids],
                "ids_sha256": [hashlib.sha256(i).hexdigest() for i in ids],
                "decoded_sha256": [hashlib.sha256(bpe.decode(np.frombuffer(i, "<u4"))).hexdigest() for i in ids]}

    return map_texts(df, kernel, "n_tokens long, ids_sha256 string, decoded_sha256 string")
