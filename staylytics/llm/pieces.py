"""Encoding whole texts by pieces that a worker keeps.

A text is cut where the tokenizer's own rules never join what stands on
both sides; a piece then has the same token ids wherever it stands, so ids
are looked up in a bounded table of the worker and only pieces it does not
know go to the library. Every id is the library's own.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Hashable, Sequence
from itertools import chain, filterfalse

#: Entries in a worker's Pieces and in its Table, about, and the longest piece that is kept (in Pieces: for long).
KEPT_PIECES, KEPT_PARTS, KEPT_LENGTH = 3 << 17, 1 << 19, 64
#: Characters of longer pieces that Pieces hold before these are dropped.
KEPT_LONG = 1 << 19
#: Pieces that the library is given at a time.
TOGETHER = 512

#: The letter that byte-level tokenizers write for a byte (given as the code point of that number): printable bytes stand for
#: themselves, the others are the letters from U+0100 on.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_LETTERS = {b: chr(b) for b in _SHOWN} | {b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)) - set(_SHOWN)))}

_LOADED: dict[tuple[str, bool], object] = {}


def load_tokenizer(path: str, special_as_text: bool = False):
    """The tokenizers library's model of a file, once for each worker, on one thread."""
    key = path, special_as_text
    if key not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        model.no_truncation()
        model.no_padding()
        model.encode_special_tokens = special_as_text
        _LOADED[key] = model
    return _LOADED[key]


class Pieces:
    """What ``encode`` (a list of pieces to a list of values) gives for a piece.

    There are two tables. A piece found in the older one moves on to the newer one; when that
    holds KEPT_PIECES the older one is dropped, so frequent pieces stay. Long pieces go at KEPT_LONG characters.
    """

    def __init__(self, encode: Callable[[list], list]):
        self.encode, self.new, self.old, self.long = encode, {}, {}, 0

    def fill(self, pieces: Sequence[Sequence[Hashable]]) -> dict:
        """A table that has all pieces of these lists; it is good until the next call."""
        missing = set(filterfalse(self.new.__contains__, chain.from_iterable(pieces)))
        if missing:
            if len(self.new) > KEPT_PIECES or self.long > KEPT_LONG:
                short = {p: v for p, v in self.new.items() if len(p) <= KEPT_LENGTH}
                self.new, self.old, self.long = ({}, short, 0) if len(self.new) > KEPT_PIECES else (short, self.old, 0)
                missing = set(filterfalse(self.new.__contains__, chain.from_iterable(pieces)))
            again = list(filter(self.old.__contains__, missing))
            self.new.update(zip(again, map(self.old.__getitem__, again)))
            missing = list(filterfalse(self.new.__contains__, missing))
            self.new.update(zip(missing, self.encode(missing)))
            self.long += sum(n for n in map(len, missing) if n > KEPT_LENGTH)
        return self.new


class Table(dict):
    """As Pieces, for pieces that are encoded one by one: looking a piece up is enough. Long pieces are not kept."""

    def __init__(self, encode: Callable[[Hashable], object]):
        super().__init__()
        self.encode, self.old = encode, {}

    def __missing__(self, piece):
        value = self.old.get(piece)
        if value is None:
            value = self.encode(piece)
        if len(piece) <= KEPT_LENGTH:
            self[piece] = value
        return value

    def trim(self) -> None:
        if len(self) > KEPT_PARTS:
            self.old.clear()
            self.old = dict(self)
            self.clear()


_KEPT: dict[Hashable, Pieces | Table] = {}


def kept(key: Hashable, make: Callable[[], Pieces | Table]):
    """The worker's table of this key, from one task to the next."""
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]
