"""Token counts of whole texts; huge ones in overlapping chunks that resynchronise.

A huge text is encoded in chunks of ``size`` characters, each beginning
``overlap`` characters before the end of the one before it, with the byte offsets
of all tokens. Neighbours are spliced at a token that both have at the same
offsets. Such a boundary is proven stable: tokens are those of the whole text
when each two that follow each other are left apart by the encoder (a merge over
a boundary would happen between these two alone as well), every two up to the
common token follow each other in the first chunk, and every two from it on in
the second. The space that the library puts before a chunk can change the first
tokens of the second chunk, but these lie before the common one. Where an overlap
has no common token, it is doubled and the second chunk encoded again; where it
would reach the first chunk's start, the whole text goes to the library.

Shorter texts are counted by units (a space or line end and what follows it) with
a bounded cache: no piece of the vocabulary holds a space after another character
or a line end (checked when it is loaded), so no merge crosses their edges.

Defined results: null text counts as empty (0 tokens); a null id stays null;
copies and repeated ids each give their row; an empty table gives no rows; other
input columns are not read.
"""
from __future__ import annotations

import re
from bisect import bisect_left
from itertools import chain

from pyspark.sql import DataFrame

from .common import map_texts, worker_state

SCHEMA = "n_bytes long, n_tokens long"
_UNIT = re.compile(r" *[^ \n]+|\n[^ \n]*| +")


class PieceCounter:
    """Counts tokens of a sentencepiece model unit by unit, with a bounded cache."""

    def __init__(self, model: str, room: int = 400_000):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        #: Units prove nothing if a piece could span their edges.
        self.splits = not any("▁" in p.lstrip("▁") or "\n" in p for p in pieces) and \
            self.library.encode("\nb", out_type=str)[:2] == ["▁", "<0x0A>"]
        self.cache: dict[str, int] = {}
        self.room = room

    def units(self, text: str) -> list[str] | None:
        if not self.splits or "\0" in text or "▁" in text:
            return None
        if "  " in text or text[:1] == " ":
            return _UNIT.findall(text)
        return text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")

    def learn(self, wanted: set[str]) -> None:
        """Counts of units as they stand inside a text. The library puts one
        space before what it gets: it stands for the unit's own, or is left out."""
        missing = [u for u in wanted if u not in self.cache]
        if not missing:
            return
        if len(self.cache) + len(missing) > self.room:
            self.cache.clear()
            missing = list(wanted)
        given = [u[1:] if u[:1] == " " else u if u[:1] == "\n" else "\n" + u for u in missing]
        for unit, ids in zip(missing, self.library.encode(given, num_threads=1)):
            self.cache[unit] = len(ids) - (0 if unit[:1] == " " else 1 if unit[:1] == "\n" else 2)
        self.cache[" "] = 1
        self.cache[""] = 0

    def whole(self, text: str) -> int:
        return len(self.library.encode(text))

    def of_units(self, units: list[str]) -> int:
        """Tokens of a text from its start: its first unit goes as it is."""
        return self.whole(units[0]) + sum(map(self.cache.__getitem__, units[1:])) if units else 0

    def short(self, texts: list[str]) -> list[int]:
        split = [self.units(t) for t in texts]
        self.learn(set(chain.from_iterable(u[1:] for u in split if u)))
        return [self.whole(t) if u is None or not u[0] else self.of_units(u) for t, u in zip(texts, split)]

    def chunk(self, text: str, base: int) -> list[tuple[int, int, int]]:
        """(begin, end, id) of a chunk's tokens, in bytes of the whole text."""
        found = self.library.encode(text, return_type="proto").pieces
        return [(base + p.begin, base + p.end, p.id) for p in found]

    @staticmethod
    def common(tokens: list, first: int, after: list) -> tuple[int, int] | None:
        """Places of the first token, from ``first`` on, that both chunks have."""
        place = {t: j for j, t in enumerate(after) if t[1] > t[0]}
        start = after[0][0] if after else 0
        for i in range(max(first, bisect_left(tokens, (start,))), len(tokens)):
            if tokens[i] in place:
                return i, place[tokens[i]]
        return None

    def huge(self, text: str, size: int, overlap: int) -> int:
        n, lo, hi, base, first, total = len(text), 0, min(len(text), size), 0, 0, 0
        tokens = self.chunk(text[:hi], 0)
        while hi < n:
            wide, to = overlap, min(n, hi + size)
            while True:
                at = hi - wide
                if at <= lo:
                    return self.whole(text)
                after_base = base + len(text[lo:at].encode())
                after = self.chunk(text[at:to], after_base)
                met = self.common(tokens, first, after)
                if met:
                    break
                wide *= 2
            total += met[0] + 1 - first
            tokens, first, lo, hi, base = after, met[1] + 1, at, to, after_base
        return total + len(tokens) - first

    def count(self, texts: list[str], size: int, overlap: int) -> list[int]:
        brief = iter(self.short([t for t in texts if len(t) <= size]))
        return [next(brief) if len(t) <= size else self.huge(t, size, overlap) for t in texts]


def count_tokens(df: DataFrame, model: str, size: int = 16_384, overlap: int = 256) -> DataFrame:
    """doc_id, n_bytes, n_tokens of every whole text for a sentencepiece model."""
    def kernel(texts):
        counter = worker_state(f"pieces:{model}", lambda: PieceCounter(model))
        return {"n_bytes": [len(t.encode()) for t in texts], "n_tokens": counter.count(texts, size, overlap)}

    return map_texts(df, kernel, SCHEMA)
