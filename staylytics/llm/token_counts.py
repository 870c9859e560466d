"""Token counts by a two-tier lookup on the map side (operator 5).

A text is cut into pre-tokens (a run of blanks with the letters behind
it; a line feed stands alone) that the tokenizer's merges never cross,
so a text has as many tokens as its pre-tokens have. Lengths come from

1. a compact table of frequent pre-tokens, broadcast to all tasks, and
2. for the rest a cache in each Python worker, filled by the library.

No pre-token is shuffled. The table only saves time: it is filled from
at most ``SAMPLE_DOCS`` documents with at most ``SAMPLE_WORDS``
pre-tokens each, and every count is the library's own. Where a model
does not have the properties that make the cut exact (``can_split``
tests them on the vocabulary), whole texts go to the library.

Defined cases: a null text is empty and has 0 bytes and 0 tokens; rows
with equal ids are counted one by one.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_texts, prepare_workers, raw_text

#: Bound of the sample that fills the broadcast table, and of the table.
SAMPLE_DOCS, SAMPLE_WORDS, TABLE_WORDS = 2048, 256, 1 << 16
#: Pre-tokens in a worker's cache before it starts anew, and the longest it keeps.
CACHE_WORDS, CACHE_LENGTH = 1 << 19, 64
LIMIT = 4096

_RUNS = re.compile("▁+[^▁\n]*|[^▁\n]+")
_LOADED: dict[str, object] = {}


def load(path: str):
    """The library's model, once for each worker."""
    if path not in _LOADED:
        import sentencepiece

        _LOADED[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _LOADED[path]


def can_split(model) -> bool:
    """No piece holds a blank behind another character or a line feed; blanks are kept and one is put in front."""
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    if any(re.search("[^▁]▁|\n", p) for p in pieces):
        return False
    shown = lambda s: "".join(model.encode(s, out_type=str))
    return (shown("  a  b ") == "▁▁▁a▁▁b▁" and shown("\n") == "▁<0x0A>"
            and shown(" ﬁ　") == "▁▁ﬁ　" and model.encode("") == [])


def pretokens(text: str) -> list[str]:
    """The pre-tokens of a text without its line feeds; blanks are written as the library writes them."""
    if not text:
        return []
    if "  " in text or "▁" in text or text[0] == " ":
        return _RUNS.findall("▁" + text.replace(" ", "▁"))
    return [x for x in ("▁" + text.replace(" ", " ▁")).replace("\n", " ").split(" ") if x]


def encode_lengths(model, words: list[str]) -> list[int]:
    """Number of tokens of each pre-token, by the library."""
    # the library puts a blank in front, but not behind a line feed; the tokens of added line feeds are taken off
    given = [w[1:].replace("▁", " ") + "\n" if w[0] == "▁" else "\n" + w for w in words]
    return [len(t) - (1 if w[0] == "▁" else 2) for w, t in zip(words, model.encode(given, num_threads=1))]


class Lengths(dict):
    """The worker's cache behind the broadcast table."""

    def __init__(self, path: str, table: dict[str, int]):
        super().__init__(table)
        self.path, self.table = path, table

    def count(self, text: str) -> int:
        words = pretokens(text)
        missing = [w for w in set(words) if w not in self] if words else []
        if missing:
            if len(self) + len(missing) > CACHE_WORDS + len(self.table):
                self.clear()
                self.update(self.table)
                missing = [w for w in set(words) if w not in self]
            long = {}
            for w, n in zip(missing, encode_lengths(load(self.path), missing)):
                (self if len(w) <= CACHE_LENGTH else long)[w] = n
            if long:
                return sum(self[w] if w in self else long[w] for w in words) + text.count("\n")
        return sum(map(self.__getitem__, words)) + text.count("\n")


#: By model; lengths do not depend on the documents.
_CACHES: dict[str, Lengths] = {}


def frequent_lengths(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> dict[str, int]:
    """The broadcast table: lengths of pre-tokens that are frequent in a bounded sample."""
    prepare_workers(docs.sparkSession)
    n = docs.count()
    step = max(1, -(-n // SAMPLE_DOCS))
    some = docs.where(F.col(text_col).isNotNull() & (F.pmod(F.xxhash64(id_col, text_col), F.lit(step)) == 0))

    def tops(batches):
        for batch in batches:
            words, counts = [], []
            for text in batch.column(0).to_pylist():
                top = Counter(pretokens(text)).most_common(SAMPLE_WORDS)
                words += [w for w, _ in top if len(w) <= CACHE_LENGTH]
                counts += [c for w, c in top if len(w) <= CACHE_LENGTH]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts, pa.int64())], names=["w", "n"])

    got = some.select(F.col(text_col)).limit(2 * SAMPLE_DOCS).mapInArrow(tops, "w string, n long").toArrow()
    total: Counter = Counter()
    for w, c in zip(got["w"].to_pylist(), got["n"].to_pylist()):
        total[w] += c
    words = [w for w, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:TABLE_WORDS]]
    return dict(zip(words, encode_lengths(load(model_path), words))) if words else {}


def token_counts(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row.

    ``model_path`` is the place of a sentencepiece model on every machine.
    """
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    split = can_split(load(model_path))
    sent = docs.sparkSession.sparkContext.broadcast(frequent_lengths(src, model_path) if split else {})

    def make():
        cache = _CACHES.setdefault(model_path, Lengths(model_path, sent.value))

        def count(texts: pa.Array) -> list[pa.Array]:
            _, offsets = raw_text(texts)
            whole = load(model_path)
            n = [(cache.count(t) if split else len(whole.encode(t))) if t else 0 for t in texts.to_pylist()]
            return [pa.array(np.diff(offsets)), pa.array(n, pa.int64())]

        return count

    fields = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]
    return map_texts(src, "text", ["doc_id"], fields, make).withColumn("over_limit", F.col("n_tokens") > limit)
