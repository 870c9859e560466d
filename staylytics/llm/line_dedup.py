"""Line dedup over overlapping three-line windows (operator 8).

The lines with a word in them are numbered; every three in a row are a
window, as is a line of PASSAGE words or more by itself, and all
lines of a text that has fewer than three. With ``pairs``, two lines in a row
that have PASSAGE words or more between them are a window too. Windows are 128-bit hashes of
trimmed lines. Over all documents, the first occurrence of a window (lowest doc_id,
then lowest line) stays. Every later one is covered; covered lines, and blank lines
between the lines of a covered window, go.

The texts are read once: tasks cut them with numpy, and the windows are written.
One shuffle of them finds the repeated ones (summed on the map side).
They are written too, and a second shuffle brings them to their later occurrences; the
join is a plain one, so Spark splits a window that is everywhere. The
last join is by document.

Defined cases: a null text has no lines and stays null; null ids come
before all others; rows equal in id and text are one document, and each
of them gets its result; a text left without a line is the empty text.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, fresh, prepare_workers, raw_text, written
from .rolling import SPACED, find_words, mix

LINES = 3
#: Words that make a single line long enough to count as a repeated passage.
PASSAGE = 50
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _windows_of(texts: pa.Array, pairs: bool):
    """(text number, first line, last line, h1, h2) arrays of the windows, for about CHUNK_BYTES of text at a time."""
    raw, offsets = raw_text(texts)
    for i, j in chunks(offsets):
        part, at = raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        _, starts, ends, of = find_words(part, at, SPACED)
        if not len(starts):
            continue
        # a line with a word in it goes from its first word to the end of its last
        breaks = np.flatnonzero(part == 10)
        line = np.searchsorted(breaks, starts)
        head = np.flatnonzero(np.concatenate([[True], (line[1:] != line[:-1]) | (of[1:] != of[:-1])]))
        words = np.diff(np.append(head, len(starts)))
        body, spans = part.tobytes(), zip(starts[head].tolist(), ends[head + words - 1].tolist())
        digests = np.frombuffer(b"".join([blake2b(body[a:b], digest_size=16).digest() for a, b in spans]), np.uint64).reshape(-1, 2)
        of = of[head]
        number = line[head] - np.searchsorted(breaks, at[of])
        n = np.bincount(of)[of]
        k = np.arange(len(of))
        nth = k - np.searchsorted(of, of)  # among the lines of its text
        size = np.minimum(n, LINES)
        found = [(k[nth + size <= n], size[nth + size <= n])]
        alone = k[(words >= PASSAGE) & (n > 1)]
        found.append((alone, np.ones_like(alone)))
        if pairs:  # the two lines of a text that has no more are a window above
            two = k[(n > 2) & (nth + 2 <= n)]
            two = two[words[two] + words[two + 1] >= PASSAGE]
            found.append((two, np.full_like(two, 2)))
        k, size = (np.concatenate(x) for x in zip(*found))
        h = mix(digests[k])  # of the lines one after another, so windows of the same lines are equal whatever made them
        for m in range(1, LINES):
            more = size > m
            h[more] = mix(h[more] * _ODD + digests[k[more] + m])
        yield i + of[k], number[k].astype(np.int32), number[k + size - 1].astype(np.int32), h[:, 0].astype(np.int64), h[:, 1].astype(np.int64)


def windows(docs: DataFrame, id_col: str, text_col: str, pairs: bool = False) -> DataFrame:
    """One row for each window: doc_id, text_hash, first and last line (from 0), h1, h2."""
    d = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    prepare_workers(docs.sparkSession)
    fields = [T.StructField(c, T.IntegerType()) for c in ("first", "last")] + [T.StructField(c, T.LongType()) for c in ("h1", "h2")]
    schema = T.StructType([*d.schema.fields[:2], *fields])

    def run(batches):
        for batch in batches:
            for of, *rest in _windows_of(batch.column(2), pairs):
                at = pa.array(of)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), *map(pa.array, rest)], names=schema.names)

    return d.mapInArrow(run, schema)


def covered(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", pairs: bool = False) -> DataFrame:
    """doc_id, text_hash and the sorted numbers of the covered lines, for documents that have any."""
    w = written(windows(docs, id_col, text_col, pairs), "windows")  # of rows equal in id and text all are the first occurrence, or none is
    seen = F.struct("doc_id", "text_hash", "first")
    repeated = w.groupBy("h1", "h2").agg(F.min(seen).alias("kept"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    repeated = written(repeated, "repeated")  # scans on both sides let Spark split a hot window
    later = w.join(repeated, ["h1", "h2"]).where(~F.struct("doc_id", "text_hash", "first").eqNullSafe(F.col("kept")))
    lines = F.sort_array(F.array_distinct(F.flatten(F.transform(F.collect_list(F.struct("first", "last")), lambda s: F.sequence(
        s["first"], s["last"])))))
    return later.groupBy("doc_id", "text_hash").agg(lines.alias("covered"))


def _left(text: Column, gone: Column) -> Column:
    """The text without the lines of the given numbers."""
    left = lambda lines: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone), lambda i: F.get(lines, i)), "\n")
    once = F.get(F.transform(F.array(F.split(text, "\n")), left), F.lit(0))  # named in the inner function, the split would be done for each line
    return F.when(gone.isNull() | text.isNull(), text).otherwise(once)


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n_chars_col: str = "n_chars",
                removed: str | None = None, pairs: bool = False) -> DataFrame:
    """All rows with their columns; the text has no covered line left, and n_chars (if there) is its new length.

    ``removed`` names an extra column for the number of lines taken out; ``pairs`` also takes passages on two lines.
    """
    h = fresh(docs.columns, "text_hash")
    d, c = docs.withColumn(h, F.xxhash64(text_col)).alias("d"), covered(docs, id_col=id_col, text_col=text_col, pairs=pairs).alias("c")
    j = d.join(c, F.col(f"d.`{id_col}`").eqNullSafe(F.col("c.doc_id")) & (F.col(f"d.{h}") == F.col("c.text_hash")), "left")
    new = fresh(docs.columns, "text_left")
    j = j.select("d.*", F.col("c.covered").alias(gone := fresh([*docs.columns, h, new], "covered")))
    j = j.withColumn(new, _left(F.col(f"`{text_col}`"), F.col(gone)))
    out = []
    for name in docs.columns:
        if name == text_col:
            out.append(F.col(new).alias(name))
        elif name == n_chars_col:
            kind = docs.schema[name].dataType
            out.append(F.when(F.col(gone).isNull(), F.col(f"`{name}`")).otherwise(F.length(new).cast(kind)).alias(name))
        else:
            out.append(F.col(f"`{name}`"))
    if removed:
        out.append(F.coalesce(F.size(gone), F.lit(0)).cast("long").alias(removed))
    return j.select(*out)


def report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_removed, and length and SHA-256 of the text that is left, for every row."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    got = dedup_lines(src.withColumn("n_lines", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long")), removed="n_removed")
    left = F.coalesce(F.col("text"), F.lit(""))
    return got.select("doc_id", "n_lines", "n_removed", F.length(left).cast("long").alias("n_chars_left"), F.sha2(left, 256).alias("sha256_left"))
