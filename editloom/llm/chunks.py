"""Cut texts where every byte-level BPE pre-tokenizer also cuts, so that encodings can be kept by chunk.

No pre-token that holds a letter, digit or sign contains white space but for one space before it. A space between two
characters that are not white space therefore always starts a pre-token, and encoding the chunks between such spaces
one by one gives the ids of the whole text. White space is Python's ``\\s``, a superset of Unicode's White_Space.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from itertools import islice

DOUBLE = re.compile(r"\s\s")
INNER = re.compile(r"(?<=\S) (?=\S)")


def cut(text: str) -> list[str]:
    """Chunks whose concatenation, each but the first behind one space, is the text; the space stays out of them."""
    if DOUBLE.search(text) or text[:1].isspace() or text[-1:].isspace():
        return INNER.split(text)
    return text.split(" ")


class ChunkEncoder:
    """ids of texts as bytes, by a function that encodes a list of distinct chunks. The memory is bounded by `most` kept chunks."""

    def __init__(self, encode: Callable[[list[str]], Iterable[bytes]], most: int = 400_000, longest: int = 64):
        self.encode, self.most, self.longest = encode, most, longest
        self.first: dict[str, bytes] = {}
        self.inner: dict[str, bytes] = {}

    def _learn(self, kept: dict[str, bytes], missing: set[str], space: str) -> dict[str, bytes]:
        """ids of the missing chunks; those that are short enough are kept as long as there is room."""
        if not missing:
            return {}
        chunks = list(missing)
        new = dict(zip(chunks, self.encode([space + x for x in chunks]), strict=True))
        room = self.most - len(kept)
        if room > 0:
            kept.update(islice(((x, ids) for x, ids in new.items() if len(x) <= self.longest), room))
        return new

    def block(self, texts: list[str]) -> list[bytes]:
        chunks = [cut(x) for x in texts]
        get, rows, short = self.inner.get, [], []
        heads, rest = set(), set()
        for c in chunks:
            ids = list(map(get, c))
            ids[0] = self.first.get(c[0])
            if None in ids:
                short.append(len(rows))
                if ids[0] is None:
                    heads.add(c[0])
                rest.update([x for x, i in zip(islice(c, 1, None), islice(ids, 1, None), strict=True) if i is None])
            rows.append(ids)
        first, inner = self._learn(self.first, heads, ""), self._learn(self.inner, rest, " ")
        for k in short:
            c, ids = chunks[k], rows[k]
            if ids[0] is None:
                ids[0] = first[c[0]]
            rows[k] = ids[:1] + [inner[x] if i is None else i for x, i in zip(islice(c, 1, None), islice(ids, 1, None), strict=True)]
        return [b"".join(ids) for ids in rows]
