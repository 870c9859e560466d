"""Language identification by rank-order profiles (operator 4).

A profile is the list of the most frequent character n-grams (1 to 3
characters inside a word, with a blank at each word's ends), most
frequent first. A document gets the language whose profile its own
profile is nearest to by out-of-place distance: the sum over its n-grams
of the difference between the two ranks, or of the profile length where
the language lacks the n-gram. Ties go to the n-gram of lower code and
to the language first in order.

The language profiles come from counts over all training documents, a
partial sum for each task and one sum for each language and n-gram in Spark. Only the
profiles (PROFILE n-grams for each language) reach the driver and go to
all tasks. Whole texts are used on both sides.

score = 1 - distance / (greatest possible distance), 0 to 1.

Defined cases: a null text, or one without a letter, is ``und`` with
score 0, as is every text if no language was learned; rows with equal
ids are judged one by one; a null language teaches nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import CHUNK_BYTES, prepare_workers, fresh, held_out, map_texts

PROFILE = 300
UNKNOWN = "und"
#: A score below which a text is in none of the learned languages: its n-grams are nearly all foreign to every profile.
MIN_SCORE = 0.15
#: n-grams a task holds before it adds up equal ones.
HELD = 1 << 21
#: Texts counted at once; with every letter there is, text and n-gram still fit in 63 bits.
TEXTS = 2048
#: Places of a table of counts for each n-gram that is added to it, at most; else they are sorted.
DENSE = 16

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.array([chr(i).isalpha() for i in range(0x110000)]))
    return _LETTERS[0]


def _added_up(keys: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys (below ``size``, in order) and the sums of their counts."""
    if size <= DENSE * len(keys):
        total = np.bincount(keys, counts, size)  # whole numbers far below 2^53
        keys = np.flatnonzero(total)
        return keys, total[keys].astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first].astype(np.int64), np.add.reduceat(counts[order], first)


def grams(texts: list[str], group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, n-gram code, count), sorted by group and code, of the texts of each group (numbers from 0).

    A code holds the three characters in 21 bits each; a blank is 1 and a missing character 0.
    Only the three characters around each letter are counted one by one: the letters, their
    pairs with the next character and the pairs of a blank and a letter follow from those counts.
    """
    none = np.zeros(0, np.int64)
    low = [t.lower() for t in texts]
    chars = np.frombuffer((" ".join(low) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    seen = np.zeros(int(chars.max()) + 1, bool)
    seen[chars] = True
    alphabet = np.flatnonzero(seen & _letters()[:len(seen)])
    if not len(alphabet):
        return none, none, none
    base = len(alphabet) + 2
    group = np.asarray(group, np.int64)
    groups = int(group.max()) + 1
    size = groups * base ** 3
    kind = np.uint32 if size < 1 << 32 else np.int64
    number = np.ones(len(seen), kind)
    number[alphabet] = np.arange(2, len(alphabet) + 2)  # 0: no character, 1: blank
    c = np.concatenate([np.ones(1, kind), number[chars]])  # a blank in front; there is one behind each text
    letter = np.flatnonzero(c > 1)
    a = c[letter]
    keys = np.repeat(group.astype(kind), [len(x) + 1 for x in low])[letter - 1]
    for x in (c[letter - 1], a, c[letter + 1]):
        keys *= kind(base)
        keys += x
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    three, counts = keys[first].astype(np.int64), np.diff(np.append(first, len(keys)))
    rest, z = np.divmod(three, base)
    rest, y = np.divmod(rest, base)
    g, x = np.divmod(rest, base)
    edge = x == 1
    one, n_one = _added_up(g * base + y, counts, groups * base)
    two, n_two = _added_up((g * base + y) * base + z, counts, groups * base ** 2)
    front, n_front = _added_up((g[edge] * base + 1) * base + y[edge], counts[edge], groups * base ** 2)
    keys, counts = np.concatenate([three, one * base ** 2, two * base, front * base]), np.concatenate([counts, n_one, n_two, n_front])
    bits = int(counts.max()).bit_length()
    if size << bits < 1 << 63:
        keys = np.sort((keys << bits) | counts)
        keys, counts = keys >> bits, keys & ((1 << bits) - 1)
    else:
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
    real = np.concatenate([[0, 1], alphabet]).astype(np.int64)
    rest, z = np.divmod(keys, base)
    rest, y = np.divmod(rest, base)
    g, x = np.divmod(rest, base)
    return g, (real[x] << 42) | (real[y] << 21) | real[z], counts


def ranked(group: np.ndarray, codes: np.ndarray, counts: np.ndarray, size: int):
    """The ``size`` most frequent n-grams of each group, most frequent first: (group, code, rank); the rows are sorted as grams() gives them."""
    n = len(group)
    if not n:
        return group, codes, counts
    most, bits = int(counts.max()), n.bit_length()
    if (int(group[-1]) + 1) * (most + 1) << bits < 1 << 63:  # the place breaks ties, as rows are sorted by code
        order = np.sort(((group * (most + 1) + (most - counts)) << bits) | np.arange(n)) & ((1 << bits) - 1)
    else:
        order = np.lexsort((codes, -counts, group))
    start = np.searchsorted(group, group)  # the order keeps the groups where they are
    rank = np.arange(n) - start
    keep = rank < size
    return group[keep], codes[order][keep], rank[keep]


def _parts(texts: list[str | None], limit: int = CHUNK_BYTES):
    """Ranges of at most TEXTS texts of about ``limit`` characters in all."""
    i, n = 0, 0
    for j, t in enumerate(texts):
        if j - i == TEXTS or n and n + len(t or "") > limit:
            yield i, j
            i, n = j, 0
        n += len(t or "")
    if i < len(texts):
        yield i, len(texts)


def profiles(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", size: int = PROFILE) -> dict[str, list[int]]:
    """Language -> its n-gram codes, most frequent first, from all rows with a text and a language."""
    prepare_workers(docs.sparkSession)
    src = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text is not null and lang is not null")

    def count(batches):
        names: dict[str, int] = {}
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def add_up():
            g, c, n = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((c, g))
            g, c, n = g[order], c[order], n[order]
            first = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (c[1:] != c[:-1])]))
            return [(g[first], c[first], np.add.reduceat(n, first))]

        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, j in _parts(texts):
                group = np.array([names.setdefault(x, len(names)) for x in langs[i:j]])
                order = np.argsort(group, kind="stable")
                got = grams([texts[i + k] for k in order], group[order])
                if len(got[0]):
                    held.append(got)
                if sum(len(x[0]) for x in held) > HELD:
                    held = add_up()
        if held:
            g, c, n = add_up()[0]
            known = np.array(list(names), object)
            for k in range(0, len(g), 1 << 16):
                at = slice(k, k + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(known[g[at]], pa.string()), pa.array(c[at]), pa.array(n[at])],
                                                 names=["lang", "code", "n"])

    total = src.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    top = total.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))).where(F.col("rank") <= size)
    out: dict[str, list[int]] = {}
    for row in sorted(top.collect(), key=lambda r: (r["lang"], r["rank"])):
        out.setdefault(row["lang"], []).append(row["code"])
    return out


class Judge:
    """Nearest profile of texts."""

    def __init__(self, known: dict[str, list[int]], size: int = PROFILE):
        self.langs, self.size = sorted(known), size
        self.codes = np.unique(np.concatenate([np.asarray(known[x], np.int64) for x in self.langs])) if known else np.zeros(0, np.int64)
        self.ranks = np.full((len(self.codes) + 1, len(self.langs)), -1, np.int64)  # the last row: in no profile
        for k, x in enumerate(self.langs):
            self.ranks[np.searchsorted(self.codes, known[x]), k] = np.arange(len(known[x]))

    def __call__(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        pred, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.langs:
            return pred, score
        for i, j in _parts(texts, CHUNK_BYTES // 2):
            g, codes, rank = ranked(*grams([t or "" for t in texts[i:j]], np.arange(j - i)), self.size)
            if not len(g):
                continue
            at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
            there = self.ranks[np.where(self.codes[at] == codes, at, len(self.codes))]
            apart = np.where(there < 0, self.size, np.abs(there - rank[:, None]))
            first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
            distance = np.add.reduceat(apart, first, axis=0)
            m = np.diff(np.append(first, len(g)))
            best = distance.argmin(axis=1)
            for d, k, s in zip(g[first].tolist(), best.tolist(), (1 - distance.min(axis=1) / (self.size * m)).tolist()):
                pred[i + d], score[i + d] = self.langs[k], s
        return pred, score


def predict(docs: DataFrame, known: dict[str, list[int]], *, text_col: str = "text", keep: list[str],
            pred: str = "lang_pred", score: str = "score", size: int = PROFILE) -> DataFrame:
    """``keep`` columns of every row and two more: the language and the score."""
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def make():
        judge = Judge(sent.value, size)

        def run(texts: pa.Array) -> list[pa.Array]:
            langs, scores = judge(texts.to_pylist())
            return [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]

        return run

    return map_texts(docs, text_col, keep, [T.StructField(pred, T.StringType()), T.StructField(score, T.DoubleType())], make)


def learned(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, list[int]]:
    """Profiles from the documents outside the held-out fold."""
    return profiles(docs.where(~held_out(F.col(id_col))), text_col=text_col, lang_col=lang_col)


def identify(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    known = learned(docs, id_col=id_col, text_col=text_col, lang_col=lang_col)
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    got = predict(src, known, keep=["doc_id"])
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def is_rejected(pred: Column, score: Column, min_score: float = MIN_SCORE) -> Column:
    return (pred == UNKNOWN) | (score < min_score)


def keep_identified(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    min_score: float = MIN_SCORE) -> DataFrame:
    """The rows whose text is in one of the learned languages, with all their columns as they were."""
    known = learned(docs, id_col=id_col, text_col=text_col, lang_col=lang_col)
    names = [fresh(docs.columns, "lang_pred"), fresh(docs.columns, "lang_score")]
    got = predict(docs, known, text_col=text_col, keep=docs.columns, pred=names[0], score=names[1])
    return got.where(~is_rejected(F.col(names[0]), F.col(names[1]), min_score)).select(*[F.col(f"`{c}`") for c in docs.columns])
