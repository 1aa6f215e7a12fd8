"""Pre-tokenisation by a tokenizer's pattern, and bounded memos from piece to ids, for work inside a task."""

from __future__ import annotations

import re
from functools import cache
from itertools import compress, repeat
from operator import is_

import public_tokenizers
import regex

#: Pieces of one of a memo's two generations; bounds a worker's memory to some 150 MB.
MEMO = 350_000


@cache
def _split() -> re.Pattern:
    """public_tokenizers.PATTERN for the standard library's faster engine, its classes written out from the full engine's. It holds
    characters up to U+FFFF, which the engine looks up in one table; texts with others are split by the full engine."""
    every = "".join(chr(i) for i in range(0x10000) if not 0xD800 <= i < 0xE000)

    def written(kind: str) -> str:
        runs: list[list[int]] = []
        for i in map(ord, regex.findall(kind, every)):
            if runs and runs[-1][1] == i - 1:
                runs[-1][1] = i
            else:
                runs.append([i, i])
        return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in runs)

    letters, numbers, spaces = written(r"\p{L}"), written(r"\p{N}"), written(r"\s")
    return re.compile(rf" ?[{letters}]+|'(?:s|t|re|ve|m|ll|d)| ?[{numbers}]+| ?[^{spaces}{letters}{numbers}]+|[{spaces}]+(?![^{spaces}])|[{spaces}]+")


class Pieces:
    """Maps texts to packed little-endian ids; encode_new(list of pieces) gives the packed ids of pieces not in the memo.

    A full memo becomes the older generation and the one before it goes; what is met again moves to the new one.
    """

    def __init__(self, encode_new, pattern: str = public_tokenizers.PATTERN, memo: int = MEMO):
        self.encode_new, self.memo, self.older, self.limit = encode_new, {}, {}, memo
        self.full = regex.compile(pattern)
        self.fast = _split() if pattern == public_tokenizers.PATTERN else None
        self.beyond = re.compile("[\U00010000-\U0010ffff]")

    def split(self, text: str) -> list[str]:
        if self.fast is None or (not text.isascii() and self.beyond.search(text)):
            return self.full.findall(text)
        return self.fast.findall(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text. New pieces of all texts are encoded together."""
        if len(self.memo) > self.limit:
            self.memo, self.older = {}, self.memo
        get = self.memo.get
        pieces = [self.split(t) for t in texts]
        found = [list(map(get, own)) for own in pieces]
        gaps: list[tuple[int, int]] = []
        for i, x in enumerate(found):
            if None in x:
                gaps += zip(repeat(i), compress(range(len(x)), map(is_, x, repeat(None))))
        if gaps:
            met = {pieces[i][k] for i, k in gaps}
            again = met & self.older.keys()
            self.memo.update(zip(again, map(self.older.__getitem__, again), strict=True))
            new = list(met - again)
            self.memo.update(zip(new, self.encode_new(new), strict=True))
            for i, k in gaps:
                found[i][k] = self.memo[pieces[i][k]]
        return [b"".join(x) for x in found]
