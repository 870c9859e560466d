"""Quality classifier on supervised subword embeddings (operator 9).

Each word, each of its character n-grams (with ``<`` and ``>`` at the
word's ends) and each pair of a word with itself is hashed to one of
BUCKETS vectors. A text is the average
of the vectors of all its features, softmax over two outputs gives the
score. Vectors and outputs are learned together by numpy stochastic
gradient descent.

Training uses at most TRAIN_DOCS labelled documents (those with the
lowest hash of their id, of the training fold): Spark tasks hash them
into sparse counts and only these come to the driver. Scoring covers
all rows and whole texts, in tasks: softmax of an average is linear up
to the last step, so each bucket's vector is reduced to one number and a
word to the sum of its features.

Defined cases: a text without words has only the outputs' bias and so
the share of good documents in training as a score; a document with
contradicting or several labels takes part once for each; labels other
than 0 and 1 and null ids teach nothing; with no labels the score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, held_out, map_texts, prepare_workers, raw_text
from .rolling import SPACED, find_words, mix, word_hashes

#: Bound of the labelled sample that the model is fitted on.
TRAIN_DOCS = 4000
BUCKETS, WIDTH = 1 << 15, 16
GRAMS = (3, 4)
#: Batches of the descent, and the rate of the first; the rate falls to nothing.
STEPS, BATCH, RATE = 1000, 32, 0.5
GOOD = 0.7

#: Bucket of a word that follows itself, one feature for whatever word it is; the pair has its own bucket besides.
ECHO = 1
_BITS = np.uint64(64 - (BUCKETS.bit_length() - 1))
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def features(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For ranges i to j of the texts: (i, j, text number from i, bucket) of every feature."""
    raw, offsets = raw_text(texts)
    for i, j in chunks(offsets):
        low, starts, ends, word_of = find_words(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], SPACED)
        if not len(starts):
            yield i, j, np.zeros(0, np.int64), np.zeros(0, np.int64)
            continue
        words = word_hashes(low, starts, ends)
        pair = np.flatnonzero(word_of[1:] == word_of[:-1])
        same = pair[words[pair] == words[pair + 1]]
        of = [word_of, word_of[pair], word_of[same]]
        bucket = [(mix(words) >> _BITS).astype(np.int64), (mix(words[pair] * _FACTORS[1] + words[pair + 1]) >> _BITS).astype(np.int64), np.full(len(same), ECHO)]
        # the characters of the words, a mark (0) in front of each word and behind the last
        size = ends - starts
        first = np.cumsum(size) - size
        body = low[np.arange(size.sum()) + np.repeat(starts - first, size)]
        n_letters = np.add.reduceat(((body & 0xC0) != 0x80).astype(np.int64), first)
        letters = np.frombuffer(body.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).astype(np.uint64)
        place = np.arange(len(letters)) + np.repeat(np.arange(1, len(size) + 1), n_letters)
        c, inside, owner = np.zeros(len(letters) + len(size) + 1, np.uint64), np.zeros(len(letters) + len(size) + 1, bool), np.zeros(
            len(letters) + len(size) + 1, np.int64)
        c[place], inside[place], owner[place] = letters, True, np.repeat(word_of, n_letters)
        for n in GRAMS:
            m = max(0, len(c) - n + 1)
            ok = np.ones(m, bool)  # marks stand at the ends only
            for k in range(1, n - 1):
                ok &= inside[k:k + m]
            at = np.flatnonzero(ok)
            h = np.full(len(at), n, np.uint64)
            for k in range(n):
                h = mix(h ^ (c[at + k] * _FACTORS[k]))
            of.append(owner[at + 1])
            bucket.append((h >> _BITS).astype(np.int64))
        yield i, j, np.concatenate(of), np.concatenate(bucket)


@dataclass
class Model:
    vectors: np.ndarray   # BUCKETS x WIDTH
    outputs: np.ndarray   # WIDTH x 2
    bias: np.ndarray      # 2

    def weights(self) -> tuple[np.ndarray, float]:
        """One number for each bucket and the bias, of the difference between the two outputs."""
        diff = self.outputs[:, 1] - self.outputs[:, 0]
        return (self.vectors @ diff).astype(np.float64), float(self.bias[1] - self.bias[0])


def fit(ids: list[np.ndarray], counts: list[np.ndarray], labels: np.ndarray, seed: int = 1) -> Model:
    """SGD over documents given as bucket ids and counts."""
    rng = np.random.default_rng(seed)
    m = Model(((rng.random((BUCKETS, WIDTH)) - 0.5) / WIDTH).astype(np.float32), np.zeros((WIDTH, 2), np.float32), np.zeros(2, np.float32))
    n = len(labels)
    if not n:
        return m
    share = np.bincount(labels, minlength=2)
    m.bias[:] = np.log((share + 1) / (n + 2))
    order = np.concatenate([rng.permutation(n) for _ in range(-(-STEPS * BATCH // n))])[:STEPS * BATCH]
    for step in range(STEPS):
        rate = RATE * (1 - step / STEPS)
        docs = [d for d in order[step * BATCH:(step + 1) * BATCH] if len(ids[d])]
        if not docs:
            continue
        which = np.concatenate([ids[d] for d in docs])
        first = np.cumsum([0, *[len(ids[d]) for d in docs[:-1]]])
        weight = np.concatenate([counts[d] / counts[d].sum() for d in docs]).astype(np.float32)[:, None]
        mean = np.add.reduceat(m.vectors[which] * weight, first, axis=0)
        z = mean @ m.outputs + m.bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(docs)), labels[docs]] -= 1  # the gradient of the loss by the outputs
        back = p @ m.outputs.T
        m.outputs -= rate * (mean.T @ p) / len(docs)
        change = np.repeat(back, np.diff(np.append(first, len(which))), axis=0) * weight
        np.add.at(m.vectors, which, -rate * len(GRAMS) * WIDTH * change)
    return m


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id",
          label_col: str = "quality", max_docs: int = TRAIN_DOCS) -> Model:
    """The model learned from labelled documents outside the held-out fold."""
    prepare_workers(docs.sparkSession)
    known = labels.select(F.col(label_id_col).alias("label_id"), F.col(label_col).alias("label")).where("label in (0, 1) and label_id is not null")
    some = known.where(~held_out(F.col("label_id"))).orderBy(F.xxhash64("label_id"), "label_id", "label").limit(max_docs)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # at most max_docs ids and labels, and one text for each: of several rows of an id the one with the least hash
    rows = texts.join(F.broadcast(some.distinct()), F.col("doc_id") == F.col("label_id"))
    rows = rows.groupBy("label_id", F.col("label").cast("int").alias("label")).agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("label_id", "text", "label")

    def run(batches):
        for batch in batches:
            ids, counts = [], []
            for i, j, of, bucket in features(batch.column(1)):
                key, n = np.unique(of * BUCKETS + bucket, return_counts=True)
                cut = np.searchsorted(key, np.arange(j - i + 1) * BUCKETS)
                ids += [(key[a:b] % BUCKETS).astype(np.int32) for a, b in zip(cut[:-1], cut[1:])]
                counts += [n[a:b].astype(np.int32) for a, b in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), batch.column(2), pa.array(ids, pa.list_(pa.int32())),
                                              pa.array(counts, pa.list_(pa.int32()))], names=["label_id", "label", "ids", "counts"])

    got = rows.mapInArrow(run, "label_id string, label int, ids array<int>, counts array<int>").toArrow()
    if not got.num_rows:
        return fit([], [], np.zeros(0, np.int64))
    got = got.combine_chunks()
    order = np.lexsort((got["label"].to_numpy(), got["label_id"].to_numpy(zero_copy_only=False).astype(str)))
    parts = {c: got[c].chunk(0) for c in ("ids", "counts")}
    take = lambda c: [parts[c][int(i)].values.to_numpy() for i in order]
    return fit(take("ids"), take("counts"), got["label"].to_numpy()[order])


def scores(texts: pa.Array, weights: np.ndarray, bias: float) -> np.ndarray:
    """Softmax of the average of the features' vectors: the mean of their numbers and the bias, squashed."""
    z = np.full(len(texts), bias)
    for i, j, of, bucket in features(texts):
        n = np.bincount(of, minlength=j - i)
        z[i:j] += np.bincount(of, weights[bucket], minlength=j - i) / np.maximum(n, 1)
    return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def score(docs: DataFrame, model: Model, *, text_col: str = "text", keep: list[str], name: str = "score") -> DataFrame:
    """``keep`` columns of every row and its score."""
    weights, bias = model.weights()
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    return map_texts(docs, text_col, keep, [T.StructField(name, T.DoubleType())], lambda: lambda texts: [pa.array(scores(texts, sent.value, bias))])


def classify(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    model = train(docs, labels, id_col=id_col, text_col=text_col)
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    got = score(src, model, keep=["doc_id"])
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))
