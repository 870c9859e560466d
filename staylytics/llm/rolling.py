"""Words of many texts at once, and rolling hashes over them, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_B, _D = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass(frozen=True)
class WordClass:
    """Which bytes stand in words, and what each byte is read as."""

    read: np.ndarray
    inside: np.ndarray


def _word_class(read: np.ndarray, spans: list[tuple[int, int]]) -> WordClass:
    inside = np.zeros(256, bool)
    for a, b in spans:
        inside[a:b] = True
    return WordClass(read, inside)


#: ASCII letters in lower case, digits and all characters beyond ASCII.
ALNUM = _word_class(_LOWER, [(48, 58), (97, 123), (128, 256)])
#: All but blank and 0x09 to 0x0D, as it is.
SPACED = _word_class(np.arange(256, dtype=np.uint8), [(0, 9), (14, 32), (33, 256)])
_BYTE = np.random.default_rng(7).integers(1, 2 ** 63, 256).astype(np.uint64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and its inverse modulo 2^64 for i < n; kept for the next batch unless one text needed far more."""
    have = _POWERS.get(int(base))
    if have is None or len(have[0]) < n:
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        have = tuple(np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, b, np.uint64))]) if n > 1
                     else np.ones(1, np.uint64) for b in (base, inverse))
        if n <= 1 << 22:
            _POWERS[int(base)] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: close inputs get unrelated outputs."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def find_words(raw: np.ndarray, offsets: np.ndarray, kind: WordClass):
    """(bytes as read, word starts, word ends, text number of each word)."""
    low = kind.read[raw]
    w = np.zeros(len(low) + 2, bool)
    w[1:-1] = kind.inside[low]
    first, last = w[1:-1] & ~w[:-2], w[1:-1] & ~w[2:]
    cut = offsets[(offsets > 0) & (offsets < len(low))]  # a word does not run on into the next text
    first[cut] = w[cut + 1]
    last[cut - 1] = w[cut]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return low, starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def word_hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    power, inverse = _powers(_B, len(low) + 1)
    total = np.zeros(len(low) + 1, np.uint64)
    np.cumsum(_BYTE[low] * power[:len(low)], out=total[1:])
    h = (total[ends] - total[starts]) * inverse[starts]
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def window_hashes(words: np.ndarray, lengths) -> dict[int, np.ndarray]:
    """The hash of the window of each length that begins at each word."""
    power, inverse = _powers(_D, len(words) + 1)
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * power[:len(words)], out=total[1:])
    return {n: (total[n:] - total[:-n]) * inverse[:max(0, len(words) + 1 - n)] for n in lengths if n <= len(words)}
