"""Benchmark decontamination (operator 10).

The windows of the benchmark items (13 consecutive words, or a whole
shorter item) become a hash set that every task holds. A task reads a
batch of documents as bytes, finds the words with numpy, rolls a hash
over them, looks the hashes up, verifies each hit by the words
themselves and keeps merged word spans and the items hit. Documents are
never shuffled.

The set is sent in blocks of at most ``MAX_BLOCK_WORDS`` words (about
60 bytes each in a worker). A benchmark of one block, the usual case,
needs one scan. A larger one needs a scan for each block; the hits of the blocks are
then joined by document.

Defined cases: a null text has no words; an item without words has no
window; a null item id is written ``null``; rows with equal ids are
judged one by one; an empty benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, fresh, map_texts, raw_text
from .rolling import ALNUM, find_words, window_hashes, word_hashes

WINDOW = 13
MAX_BLOCK_WORDS = 1 << 20

@dataclass
class Block:
    """Windows of some items: by length, the sorted hashes, and the words of each window with its item ids."""

    windows: dict[int, dict[bytes, set[str]]] = field(default_factory=dict)
    hashes: dict[int, np.ndarray] = field(default_factory=dict)
    n_words: int = 0

    def add(self, item_id: str, text: str) -> None:
        raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        low, starts, ends, _ = find_words(raw, np.array([0, len(raw)]), ALNUM)
        if not len(starts):
            return
        n = min(WINDOW, len(starts))
        body = low.tobytes()
        words = [body[a:b] for a, b in zip(starts, ends)]
        into = self.windows.setdefault(n, {})
        for i in range(len(words) - n + 1):
            into.setdefault(b" ".join(words[i:i + n]), set()).add(item_id)
        h = window_hashes(word_hashes(low, starts, ends), [n])[n]
        self.hashes[n] = np.union1d(self.hashes.get(n, np.zeros(0, np.uint64)), h)
        self.n_words += len(words)


def blocks(benchmark: DataFrame, id_col: str, text_col: str, max_words: int = MAX_BLOCK_WORDS) -> Iterator[Block]:
    """The benchmark read row by row; a block is full at ``max_words`` words."""
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.col(text_col))
    now = Block()
    for item_id, text in rows.toLocalIterator():
        if text:
            now.add(item_id, text)
        if now.n_words >= max_words:
            yield now
            now = Block()
    if now.n_words:
        yield now


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())]))
_PA_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))


def _scanner(block_b):
    """A function from texts to (number of words, merged spans of hit words, items hit)."""
    block: Block = block_b.value
    maps = {n: np.zeros(1 << 20, bool) for n in block.hashes}
    for n, h in block.hashes.items():
        maps[n][h >> np.uint64(44)] = True

    def scan(texts: pa.Array) -> list[pa.Array]:
        raw, offsets = raw_text(texts)
        n_words, spans, items = np.zeros(len(texts), np.int64), [[] for _ in range(len(texts))], [[] for _ in range(len(texts))]
        for i, j in chunks(offsets):
            at = offsets[i:j + 1] - offsets[i]
            low, starts, ends, of = find_words(raw[offsets[i]:offsets[j]], at, ALNUM)
            n_words[i:j] = np.bincount(of, minlength=j - i)
            if not len(starts):
                continue
            found: dict[int, list[tuple[int, int]]] = {}
            base = np.searchsorted(of, np.arange(j - i))
            for n, h in window_hashes(word_hashes(low, starts, ends), block.hashes).items():
                k = np.flatnonzero(maps[n][h >> np.uint64(44)])
                k = k[of[k] == of[k + n - 1]]
                known = block.hashes[n]
                k = k[known[np.minimum(np.searchsorted(known, h[k]), len(known) - 1)] == h[k]]
                for x in k.tolist():
                    ids = block.windows[n].get(b" ".join(low[starts[y]:ends[y]].tobytes() for y in range(x, x + n)))
                    if ids:
                        d = int(of[x])
                        found.setdefault(d, []).append((x - int(base[d]), x - int(base[d]) + n))
                        items[i + d].extend(ids)
            for d, hit in found.items():
                merged: list[list[int]] = []
                for a, b in sorted(hit):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(b, merged[-1][1])
                    else:
                        merged.append([a, b])
                spans[i + d] = [{"start": a, "stop": b} for a, b in merged]
        return [pa.array(n_words), pa.array(spans, _PA_SPANS),
                pa.array([sorted(set(x)) for x in items], pa.list_(pa.string()))]

    return scan


def _scan(docs: DataFrame, text_col: str, keep: list[str], names: list[str], block: Block) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(block)
    fields = [T.StructField(names[0], T.LongType()), T.StructField(names[1], SPANS),
              T.StructField(names[2], T.ArrayType(T.StringType()))]
    return map_texts(docs, text_col, keep, fields, lambda: _scanner(sent))


def find_hits(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", keep: list[str] | None = None,
              item_col: str = "item_id", item_text_col: str = "text", n_words: str = "n_words", spans: str = "spans",
              items: str = "items", max_block_words: int = MAX_BLOCK_WORDS) -> DataFrame:
    """``keep`` columns (default: all) of every row, with its words, merged hit spans (in words) and items hit.

    The names given for the three new columns must not be in ``keep``.
    """
    keep = docs.columns if keep is None else keep
    names = [n_words, spans, items]
    parts = blocks(benchmark, item_col, item_text_col, max_block_words)
    first = next(parts, Block())
    out = _scan(docs, text_col, keep, names, first)
    second = next(parts, None)
    if second is None:
        return out
    # more than one block: each text is known by its two hashes, the hits of later blocks are joined to the first scan
    key = [fresh([*keep, *names], k) for k in ("key_a", "key_b")]
    keyed = docs.withColumns({key[0]: F.xxhash64(F.col(text_col)), key[1]: F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)})
    out = _scan(keyed, text_col, [*keep, *key], names, first)
    texts = keyed.select(*key, F.col(text_col).alias("text")).dropDuplicates(key)
    hits = None
    while second is not None:
        got = _scan(texts, "text", key, ["n", "s", "i"], second).where(F.size("s") > 0).drop("n")
        hits = got if hits is None else hits.unionByName(got)
        second = next(parts, None)
    later = hits.groupBy(*key).agg(F.flatten(F.collect_list("s")).alias("later_s"), F.flatten(F.collect_list("i")).alias("later_i"))
    a, b = out.alias("a"), later.alias("b")
    rows = a.join(b, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in key], "left")
    all_spans = F.array_sort(F.concat(F.col(f"a.{spans}"), F.coalesce("b.later_s", F.array().cast(SPANS))))
    merged = F.aggregate(all_spans, F.array().cast(SPANS), lambda acc, x: F.when(
        (F.size(acc) > 0) & (F.element_at(acc, -1)["stop"] >= x["start"]),
        F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
            F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["stop"], x["stop"]).alias("stop"))))
    ).otherwise(F.concat(acc, F.array(x))))
    return rows.select(*[F.col(f"a.`{c}`") for c in keep], F.col(f"a.{n_words}"), merged.alias(spans),
                       F.array_sort(F.array_distinct(F.concat(F.col(f"a.{items}"), F.coalesce(
                           "b.later_i", F.array().cast("array<string>"))))).alias(items))


def n_hit(spans):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda acc, x: acc + (x["stop"] - x["start"]).cast("long"))


def is_contaminated(hit, words):
    """One hit word at least, and a twentieth of all words."""
    return (hit > 0) & (20 * hit >= words)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text") -> DataFrame:
    """The rows that are not contaminated, with all their columns and whole texts."""
    names = [fresh(docs.columns, x) for x in ("hit_words", "hit_spans", "hit_items")]
    got = find_hits(docs, benchmark, text_col=text_col, n_words=names[0], spans=names[1], items=names[2])
    return got.where(~is_contaminated(n_hit(F.col(names[1])), F.col(names[0]))).select(*[F.col(f"`{c}`") for c in docs.columns])


def remove_spans(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text") -> DataFrame:
    """All rows, with the hit words and what stands between them cut out of the text."""
    names = [fresh(docs.columns, x) for x in ("hit_words", "hit_spans", "hit_items")]
    got = find_hits(docs, benchmark, text_col=text_col, n_words=names[0], spans=names[1], items=names[2])
    new, hit_spans = fresh(got.columns, "new_text"), names[1]
    keep = got.columns

    def run(batches):
        for batch in batches:
            texts, all_spans = batch.column(keep.index(text_col)), batch.column(keep.index(hit_spans)).to_pylist()
            raw, offsets = raw_text(texts)
            out = []
            for d, hit in enumerate(all_spans):
                if not texts[d].is_valid:
                    out.append(None)
                    continue
                body = raw[offsets[d]:offsets[d + 1]]
                _, starts, ends, _ = find_words(body, np.array([0, len(body)]), ALNUM)
                left, at = [], 0
                for s in hit:
                    left.append(body[at:starts[s["start"]]].tobytes())
                    at = int(ends[s["stop"] - 1])
                left.append(body[at:].tobytes())
                out.append(b"".join(left).decode("utf-8"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*keep, new])

    schema = T.StructType([*got.schema.fields, T.StructField(new, T.StringType())])
    done = got.mapInArrow(run, schema)
    return done.select(*[F.col(new).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def report(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: words, hit words, items hit and their digest, verdict."""
    got = find_hits(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), benchmark, keep=["doc_id"])
    hit = n_hit(F.col("spans"))
    return got.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
                      is_contaminated(hit, F.col("n_words")).alias("contaminated"))
