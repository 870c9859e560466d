"""A table-driven byte transducer over UTF-8 texts, and a verified hash table of word spans, in numpy.

The transducer has two states, BETWEEN words and in a WORD, and reads one
byte class after another. What it says of a byte is a set of bits: a word
starts, a word has ended before it, a capital, a symbol, or a byte inside a
code point. The next state follows from the byte class alone, so all bytes
of a piece are looked up at once: the state before a byte is the one that
the class of the byte before it leads to.

The hash table keeps one span for each different word of a document.
A span is put into its slot by a 64-bit hash and compared byte by byte with
the one it finds there; spans that differ go on to the next slot, so
colliding hashes never merge words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from .common import chunks, raw_text
from .rolling import mix

SPACE, CAPITAL, SYMBOL, PLAIN, LEAD, INNER = range(6)
BETWEEN, WORD = range(2)
SAYS_START, SAYS_END, SAYS_CAPITAL, SAYS_SYMBOL, SAYS_INNER = (1 << k for k in range(5))

#: Bytes that one round of table lookups covers (a cache holds its arrays), and the longest word that is hashed and compared in numpy.
PIECE, LONG_WORD = 1 << 18, 64


def _tables(symbols: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class of each byte, next state by state and class, what is said by state and class)."""
    kind = np.full(256, PLAIN, np.uint8)
    kind[[0x20, *range(0x09, 0x0E)]] = SPACE
    kind[0x41:0x5B] = CAPITAL
    kind[list(symbols)] = SYMBOL
    kind[0x80:0xC0] = INNER
    kind[0xC0:] = LEAD
    nxt = np.full((2, 6), WORD, np.uint8)
    nxt[:, SPACE] = BETWEEN
    says = np.zeros((2, 6), np.uint8)
    says[BETWEEN, CAPITAL:] |= SAYS_START
    says[WORD, SPACE] |= SAYS_END
    for c, bit in ((CAPITAL, SAYS_CAPITAL), (SYMBOL, SAYS_SYMBOL), (INNER, SAYS_INNER)):
        says[:, c] |= bit
    return kind, nxt, says


class Transducer:
    """Counts of texts in one pass: words, different words, capitals, code points, symbols."""

    def __init__(self, symbols: bytes):
        self.kind, nxt, says = _tables(symbols)
        if (nxt[BETWEEN] != nxt[WORD]).any():
            raise ValueError("the next state must follow from the byte class alone")
        # by the class before and the class of a byte
        self.says = says[nxt[BETWEEN]].ravel()

    def counts(self, texts: pa.Array) -> np.ndarray:
        """One row for each text (null: empty): words, different words, capitals, code points, symbols."""
        closed = pc.binary_join_element_wise(texts.fill_null(""), "", " ")  # a blank ends each text, and so its last word
        raw, offsets = raw_text(closed)
        out = np.zeros((len(texts), 5), np.int64)
        for i, j in chunks(offsets, PIECE):
            self._chunk(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], out[i:j])
        return out

    def _chunk(self, raw: np.ndarray, offsets: np.ndarray, out: np.ndarray) -> None:
        n = len(offsets) - 1
        table = SpanTable(raw)
        of = lambda at: np.searchsorted(offsets, at, side="right") - 1
        count = lambda at: np.bincount(of(at), minlength=n)
        open_ = np.zeros(0, np.int64)  # the start of a word that runs on into the next piece
        out[:, 3] = np.diff(offsets) - 1
        last = SPACE
        for a in range(0, len(raw), PIECE):
            kind = self.kind[raw[a:a + PIECE]]
            before = np.empty_like(kind)
            before[0], before[1:] = last, kind[:-1]
            last = kind[-1]
            said = self.says[before * np.uint8(6) + kind]
            at = lambda bit: np.flatnonzero(said & np.uint8(bit)) + a  # noqa: E731, B023
            starts, ends = np.concatenate([open_, at(SAYS_START)]), at(SAYS_END)
            starts, open_ = starts[:len(ends)], starts[len(ends):]
            doc = of(starts)
            out[:, 0] += np.bincount(doc, minlength=n)
            out[:, 1] += np.bincount(doc[table.insert(starts, ends - starts, doc)], minlength=n)
            out[:, 2] += count(at(SAYS_CAPITAL))
            out[:, 3] -= count(at(SAYS_INNER))
            out[:, 4] += count(at(SAYS_SYMBOL))


#: The low bytes of a 64-bit word.
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


class SpanTable:
    """Different (document, word) spans of ``raw``, open addressing; it grows with the spans it keeps."""

    def __init__(self, raw: np.ndarray):
        self.raw = np.concatenate([raw, np.zeros(8, np.uint8)])
        self.eight = np.ndarray((len(raw) + 1,), "<u8", self.raw, strides=(1,))  # the eight bytes from each place
        self._room(32)

    def _room(self, spans: int) -> None:
        n = 1 << int(2 * spans - 1).bit_length()
        self.start, self.length, self.doc = np.full(n, -1, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.kept = 0

    def _hash(self, start: np.ndarray, length: np.ndarray, doc: np.ndarray) -> np.ndarray:
        h = mix((length.astype(np.uint64) << np.uint64(32)) ^ doc.astype(np.uint64))
        left, at = np.minimum(length, LONG_WORD), np.arange(len(start))
        for k in range(0, LONG_WORD, 8):
            at = at[left[at] > k] if k else at
            if not len(at):
                break
            h[at] = mix(h[at] ^ (self.eight[start[at] + k] & _LOW[np.minimum(left[at] - k, 8)]))
        for i in np.flatnonzero(length > LONG_WORD):
            h[i] ^= np.uint64(xxhash.xxh3_64_intdigest(self.raw[start[i]:start[i] + length[i]]))
        return h

    def _same(self, x: np.ndarray, y: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the spans of this length from x and y have equal bytes."""
        same = np.ones(len(x), bool)
        left, at = np.minimum(length, LONG_WORD), np.arange(len(x))
        for k in range(0, LONG_WORD, 8):
            at = at[(left[at] > k) & same[at]]
            if not len(at):
                break
            same[at] = (self.eight[x[at] + k] ^ self.eight[y[at] + k]) & _LOW[np.minimum(left[at] - k, 8)] == 0
        for i in np.flatnonzero(same & (length > LONG_WORD)):
            same[i] = np.array_equal(self.raw[x[i]:x[i] + length[i]], self.raw[y[i]:y[i] + length[i]])
        return same

    def insert(self, start: np.ndarray, length: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Puts the spans in; True where the word was not there before."""
        if 2 * (self.kept + len(start)) > len(self.start):
            full = self.start >= 0
            old = self.start[full], self.length[full], self.doc[full]
            self._room(len(old[0]) + len(start))
            self._put(*old)
        return self._put(start, length, doc)

    def _put(self, start: np.ndarray, length: np.ndarray, doc: np.ndarray) -> np.ndarray:
        new = np.zeros(len(start), bool)
        last = len(self.start) - 1
        slot = (self._hash(start, length, doc) & np.uint64(last)).astype(np.int64)
        todo = np.arange(len(start))
        while len(todo):
            s = slot[todo]
            free = todo[self.start[s] < 0][::-1]  # of several spans for one slot the first is written last, and stays
            f = slot[free]
            self.start[f], self.length[f], self.doc[f] = start[free], length[free], doc[free]
            mine = self.start[s] == start[todo]
            new[todo[mine]] = True
            rest, r = todo[~mine], s[~mine]
            equal = (self.length[r] == length[rest]) & (self.doc[r] == doc[rest])
            equal[equal] = self._same(self.start[r[equal]], start[rest[equal]], length[rest[equal]])
            todo = rest[~equal]
            slot[todo] = (slot[todo] + 1) & last
        self.kept += int(new.sum())
        return new
