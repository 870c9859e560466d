"""ProbMinHash signatures of weighted word shingles, and the exact probability Jaccard, in numpy."""

from __future__ import annotations

import hashlib

import numpy as np

from .rolling import SPACED, find_words, window_hashes, word_hashes

WORDS = 5
BANDS, ROWS = 40, 8
SLOTS = BANDS * ROWS
#: Arrivals after which all slots of a set are taken, as expected: SLOTS times a harmonic number.
_FULL = SLOTS * (np.log(SLOTS) + 0.58)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: close inputs get unrelated outputs."""
    x = x.copy()
    _mix_in_place(x, np.empty_like(x))
    return x


def _mix_in_place(x: np.ndarray, scratch: np.ndarray) -> None:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        np.right_shift(x, np.uint64(shift), out=scratch)
        x ^= scratch
        if factor > 1:
            x *= np.uint64(factor)


def shingles(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, 48-bit shingle hash, count) of the distinct shingles, sorted; at most 2^15 texts.

    A text of fewer than five words is one shingle.
    """
    low, starts, ends, of = find_words(raw, offsets, SPACED)
    words = word_hashes(low, starts, ends)
    n_words = np.bincount(of, minlength=len(offsets) - 1)
    first = np.searchsorted(of, np.arange(len(offsets) - 1))
    d, h = [], []
    for n, hashes in window_hashes(words, range(1, WORDS + 1)).items():
        if n == WORDS:
            at = np.flatnonzero(of[:len(of) - n + 1] == of[n - 1:])
        else:
            at = first[n_words == n]
        d.append(of[at])
        h.append(hashes[at])
    if not d:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    key = np.sort((np.concatenate(d).astype(np.uint64) << np.uint64(48)) | (mix(np.concatenate(h)) >> np.uint64(16)))
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    counts = np.diff(np.append(new, len(key)))
    key = key[new]
    return (key >> np.uint64(48)).astype(np.int64), key & np.uint64((1 << 48) - 1), counts


def signatures(of: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """n x SLOTS: in each slot of each set the element that arrives there first.

    An element of weight w arrives by a Poisson process of rate w, each
    time at a random slot. It stops once its next arrival would come
    after every slot of its set is taken (early termination). Two sets
    agree in a slot with the probability Jaccard of their weights.
    """
    best = np.full(n * SLOTS, np.inf)
    owner = np.zeros(n * SLOTS, np.uint64)
    clock, arrived = np.zeros(len(of)), np.zeros(len(of), np.int64)
    seed, place, negative = element * np.uint64(0xD6E8FEB86659FD93), of * SLOTS, -weight
    active = np.arange(len(of))
    share = _FULL
    while len(active):
        each = np.maximum(1, np.ceil(share / np.bincount(of[active], minlength=n)[of[active]])).astype(np.int64)
        start = np.cumsum(each) - each
        spread = lambda values: np.repeat(values, each)  # noqa: B023, E731
        nth = spread(arrived[active] + 1 - start)
        nth += np.arange(len(nth))
        r = nth.view(np.uint64)
        r *= _STEP
        r += spread(seed[active])
        scratch = np.empty_like(r)
        _mix_in_place(r, scratch)
        wait = np.right_shift(r, np.uint64(11), out=scratch).astype(np.float64)
        wait += 1
        wait *= 2.0 ** -53
        np.log(wait, out=wait)
        wait /= spread(negative[active])
        when = np.cumsum(wait)
        when -= spread(when[start] - wait[start] - clock[active])
        r += _STEP
        _mix_in_place(r, scratch)
        r >>= np.uint64(32)
        r *= np.uint64(SLOTS)
        r >>= np.uint64(32)
        slot = r.view(np.int64)
        slot += spread(place[active])
        np.minimum.at(best, slot, when)
        won = np.flatnonzero(when == best[slot])
        owner[slot[won]] = element[active[np.searchsorted(start, won, side="right") - 1]]
        clock[active] = when[start + each - 1]
        arrived[active] += each
        last = best.reshape(n, SLOTS).max(axis=1)
        active = active[clock[active] < last[of[active]]]
        share = _FULL / 16
    return owner.reshape(n, SLOTS)


def bands_and_bits(owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each band, one bit of each slot packed in longs) of signatures."""
    n = len(owner)
    acc = np.broadcast_to(mix(np.arange(1, BANDS + 1, dtype=np.uint64) * _STEP), (n, BANDS)).copy()
    for r in range(ROWS):
        acc = mix(acc ^ owner[:, r::ROWS])
    bits = np.packbits((mix(owner + _STEP) >> np.uint64(63)).astype(np.uint8), axis=1)
    return acc.view(np.int64), bits.view(np.int64)


def fingerprint(body: bytes) -> tuple[int, int]:
    """128 bits of a text's words; texts that differ in white space only have the same."""
    d = hashlib.blake2b(b" ".join(body.split()), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum over common elements i of 1 / sum over all j of max(x_j / x_i, y_j / y_i); a and b are (sorted elements, weights)."""
    both = np.union1d(a[0], b[0])
    if not len(both):
        return 0.0
    x, y = np.zeros(len(both)), np.zeros(len(both))
    x[np.searchsorted(both, a[0])] = a[1]
    y[np.searchsorted(both, b[0])] = b[1]
    with np.errstate(divide="ignore"):
        ratio = x / y
    order = np.argsort(-ratio, kind="stable")  # x_j / x_i is the greater for ratios not below that of i
    x, y, ratio = x[order], y[order], ratio[order]
    end = np.searchsorted(-ratio, -ratio, side="right")
    from_x = np.concatenate([[0.0], np.cumsum(x)])[end]
    after_y = y.sum() - np.concatenate([[0.0], np.cumsum(y)])[end]
    common = (x > 0) & (y > 0)
    return float((1 / (from_x[common] / x[common] + after_y[common] / y[common])).sum())
