"""Texts as units that tokenize independently, with a bounded cache per worker.

A unit is a run of spaces and line ends followed by other characters. Between a
non-space character and a space or line end every match of the pre-tokenizer
pattern ends (only its whitespace alternatives hold a space after their first
character), so the ids of a text are the ids of its units, one after another.
"""
from __future__ import annotations

import base64
import re
from functools import cached_property
from itertools import chain
from json import load

import numpy as np

_UNIT = re.compile(r"[ \n]*[^ \n]+|[ \n]+")


def split_units(text: str) -> list[str] | None:
    """The units of a text; None where it has white space that libraries may
    class differently, or the marker itself, so that units prove nothing."""
    if "\0" in text or "᠎" in text:
        return None
    units = text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")
    words = text.split()
    if len(text) - len("".join(words)) != len(units) - 1:
        return None
    if len(words) != len(units):
        return _UNIT.findall(text)
    return units


class ByteBpe:
    """Ids of the byte-level BPE as little-endian unsigned 32-bit bytes.

    ``json`` names the tokenizers file whose special strings are honoured (the
    library's default); without it every string is ordinary text.
    """

    def __init__(self, ranks_path: str, pattern: str, json: str | None = None, room: int = 300_000):
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.library = tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)
        self.json, self.special = json, ()
        if json:
            with open(json, encoding="utf-8") as f:
                self.special = tuple(t["content"] for t in load(f)["added_tokens"])
        self.cache: dict[str, bytes] = {}
        self.room = room

    @cached_property
    def full(self):
        """The tokenizers library's own object; most texts never need it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.json)

    def plain(self, text: str) -> bytes:
        """One text by the library itself."""
        if self.json:
            return np.array(self.full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return np.array(self.library.encode_ordinary(text), "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [None if any(s in t for s in self.special) else split_units(t) for t in texts]
        cache = self.cache
        missing = [u for u in set(chain.from_iterable(u for u in split if u)) if u not in cache]
        if missing:
            if len(cache) + len(missing) > self.room:
                cache.clear()
                missing = list(set(chain.from_iterable(u for u in split if u)))
            # Units that start with white space and end with another character
            # can follow one another in one call; the few others go alone.
            joined = [u for u in missing if u[:1] in (" ", "\n") and u[-1] not in " \n"]
            ids = np.array(self.library.encode_ordinary("".join(joined)), "<u4")
            ends = np.cumsum([len(u.encode()) for u in joined])
            cuts = (np.searchsorted(np.cumsum(self.lengths[ids]), ends) + 1) * 4
            flat, at = ids.tobytes(), 0
            for unit, cut in zip(joined, cuts.tolist()):
                cache[unit] = flat[at:cut]
                at = cut
            for unit in missing:
                if unit not in cache:
                    cache[unit] = np.array(self.library.encode_ordinary(unit), "<u4").tobytes()
        get = cache.__getitem__
        return [self.plain(t) if u is None else b"".join(map(get, u)) for t, u in zip(texts, split)]
