"""Alignment of the tokens of two tokenizers over the same bytes (operator 13).

Both tokenizers cut the bytes of a blank and the text; a token is known by
the offset at which it ends. Where tokens of both end at the same offset a group ends.

Diagonal run skipping finds the groups. While token i of A and token i +
shift of B end alike, groups are one to one: stretches of 1, 2, 4, ... end
offsets of both arrays are compared whole at the current shift, and after
the first stretch that differs the steps halve again, so a run of n
one-to-one groups costs about 2 log n comparisons. At an irregular group
the side that is behind takes tokens until both ends meet; that gives its links
(pairs of tokens with bytes in common), and the shift is updated.

Counts of id pairs come from all documents:

1. a task tokenizes, aligns and sums the links of each document by id
   pair; the rows are written.
2. Pairs are summed (map-side first) and the highest count of each B id, at
   most one row for each entry of its vocabulary, is joined to them. The table is written.
3. The HEAD most frequent pairs are broadcast, and tasks look them up. All
   other pairs are joined by pair; none of these can hold more than 1 /
   HEAD of all links, so no key is hot. The partial sums meet by document row.

Texts are encoded by pieces that a worker keeps (pieces.py) if they hold
no white space but blanks and line feeds; others go to the libraries whole.
Pieces end at a common offset, so no group crosses such an end: unknown pieces are
encoded and aligned together, their groups and links are kept with them, and
those of a text are its pieces' in a row. A long text is taken stretch by stretch.

Defined cases: a null or empty text, or one whose tokens of A or B do not give back the
bytes of blank and text (U+2581 is read as a blank by B), has no tokens:
zeros and an empty groups digest; rows with equal ids are aligned one by
one and all count; null ids are carried along; an empty table gives no rows; other columns
are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from itertools import pairwise, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, prepare_workers, raw_text, written
from .pieces import BYTE_LETTERS, TOGETHER, Pieces, kept, load_tokenizer
from .token_counts import can_split, load

#: The most frequent id pairs, which are broadcast: 24 bytes each.
HEAD = 1 << 16
#: Characters that are aligned at a time, about.
STRETCH = 1 << 20

#: A run of blanks and line feeds and what follows it. No merge of either tokenizer crosses the place where one begins.
_PIECES = re.compile("[ \n]*[^ \n]+|[ \n]+$")
#: White space that may stand elsewhere in a token, and the sign that the second tokenizer writes for a blank.
_ODD = re.compile("[%s]" % "".join(map(chr, [
    0x09, 0x0B, 0x0C, 0x0D, *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x2581, 0x3000])))


def byte_entries(model) -> list[bytes]:
    """The bytes of each id of a byte-level tokenizer."""
    of = {c: b for b, c in BYTE_LETTERS.items()}
    entries = {i: w for w, i in model.get_vocab(with_added_tokens=True).items()}
    added = set(model.get_added_tokens_decoder())
    return [entries.get(i, "").encode() if i in added else bytes(of[c] for c in entries.get(i, "")) for i in range(max(entries, default=-1) + 1)]


def piece_entries(model) -> list[bytes]:
    """The bytes of each id of a sentencepiece model."""
    def one(i: int) -> bytes:
        piece = model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()
    return [one(i) for i in range(model.get_piece_size())]


class Pair:
    """Both tokenizers in a worker: A's ids of blank + text, B's ids of text."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = load_tokenizer(a_path, special_as_text=True), load(b_path)
        self.entries = byte_entries(self.a), piece_entries(self.b)
        self.sizes = [np.array(list(map(len, e)), np.int64) for e in self.entries]
        self.names = [list(map(str, range(len(e)))) for e in self.entries]
        self.cuts = can_split(self.b)
        self.kept = kept(("pair", a_path, b_path), lambda: Pieces(self._of_pieces))

    def _alone(self, given: list[str], to_b: list[str], keep: list[slice]) -> list[tuple[bytes, bytes, int, int] | None]:
        """Values (see ``_aligned``) of texts that are encoded one by one; None where the tokens are not the bytes of ``given``."""
        a = [e.ids for e in self.a.encode_batch_fast(given, add_special_tokens=False)]
        b = [x[k] for x, k in zip(self.b.encode(to_b, num_threads=1), keep)]
        return [self._aligned([x, y], [len(g.encode())])[0] if self._bytes(0, x) == self._bytes(1, y) == g.encode() else None for g, x, y in zip(given, a, b)]

    def _bytes(self, k: int, ids) -> bytes:
        return b"".join(map(self.entries[k].__getitem__, ids))

    def _of_pieces(self, pieces: list[str]) -> list[tuple[bytes, bytes, int, int] | None]:
        # pieces that end in something else than white space can follow one another in any order: they go in one text
        out = {}
        joint = [p for p in pieces if p[-1] not in " \n"]
        for i in range(0, len(joint), TOGETHER):
            out.update(self._together(joint[i:i + TOGETHER]))
        # B puts a blank in front, but not of nothing: a piece is given with a line feed behind it, which is taken off again.
        # A piece that begins with a line feed has no blank, so that one is taken off too.
        rest = [p for p in pieces if p not in out]
        if not rest:
            return [out[p] for p in pieces]
        starts = [p[0] == " " for p in rest]
        out.update(zip(rest, self._alone(rest, [(p[1:] if s else p) + "\n" for p, s in zip(rest, starts)], [slice(0 if s else 1, -1) for s in starts])))
        return [out[p] for p in pieces]

    def _together(self, pieces: list[str]) -> dict[str, tuple[bytes, bytes, int, int]]:
        """The values of pieces that are encoded and aligned as one text; nothing if its tokens are not its bytes or do not end where a piece does."""
        text = " a" + "".join(pieces)
        given = text.encode()
        both = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.b.encode(text[1:])
        if any(self._bytes(k, ids) != given for k, ids in enumerate(both)):
            return {}
        values = self._aligned(both, np.cumsum([2, *map(len, pieces if text.isascii() else map(str.encode, pieces))]))
        return dict(zip(pieces, values[1:])) if values else {}

    def _aligned(self, both, ends) -> list[tuple[bytes, bytes, int, int]]:
        """Groups as they are digested, links as 64-bit numbers (id of A, id of B), tokens of A and tokens of B of each
        part of a text that ends at one of ``ends``; nothing if the tokens of A or of B do not end there."""
        ids = [np.array(x, np.int64) for x in both]
        at = [np.cumsum(size[x]) for size, x in zip(self.sizes, ids)]
        cuts = [np.searchsorted(x, ends) for x in at]
        if any(not np.array_equal(x[c], ends) for x, c in zip(at, cuts)):
            return []
        groups, link_a, link_b = align(*(x.tolist() for x in at))
        name_a, name_b = (list(map(names.__getitem__, x)) for names, x in zip(self.names, both))
        said, last = [], []  # the groups and the last token of A of each
        for a0, a1, b0, b1 in groups:
            if b1:
                said.append(",".join(name_a[a0:a1]) + "|" + ",".join(name_b[b0:b1]))
                last.append(a1 - 1)
            else:  # a run of one-to-one groups
                said += map("|".join, zip(name_a[a0:a1], name_b[b0:b0 + a1 - a0]))
                last += range(a0, a1)
        last, link_a, link_b = (np.array(x, np.int64) for x in (last, link_a, link_b))
        links = (ids[0][link_a] << 32 | ids[1][link_b]).astype("<i8").tobytes()
        upto = [[0, *x.tolist()] for x in (np.searchsorted(last, cuts[0], side="right"), 8 * np.searchsorted(link_a, cuts[0], side="right"), cuts[0] + 1, cuts[1] + 1)]
        return [(";".join(said[g0:g1]).encode(), links[l0:l1], a1 - a0, b1 - b0)
                for (g0, g1), (l0, l1), (a0, a1), (b0, b1) in zip(*map(pairwise, upto))]

    def pieces(self, text: str | None) -> list[str] | None:
        """The pieces of a text that is encoded by pieces and in one stretch."""
        return _PIECES.findall(" " + text) if text and self.cuts and len(text) < STRETCH and not _ODD.search(text) else None

    def stretches(self, text: str, pieces: list[str] | None = None, known: dict | None = None):
        """Values (see ``_aligned``) of the parts of one stretch of the text after another; ``known`` has those of ``pieces``."""
        if pieces:
            yield list(map((known or self.kept.fill([pieces])).__getitem__, pieces))
            return
        if not self.cuts or _ODD.search(text):
            yield self._alone([" " + text], [text], [slice(None)])
            return
        given, at = " " + text, 0
        while at < len(given):  # a piece that reaches the end of a stretch may go on behind it: it is taken anew
            pieces = _PIECES.findall(given[at:at + STRETCH])
            done = at + STRETCH >= len(given)
            if not done and len(pieces) > 1:
                pieces.pop()
            elif not done:
                pieces, done = _PIECES.findall(given[at:]), True
            at = len(given) if done else at + sum(map(len, pieces))
            yield list(map(self.kept.fill([pieces]).__getitem__, pieces))


def align(a: list[int], b: list[int]) -> tuple[list[tuple[int, int, int, int]], list[int], list[int]]:
    """Groups and links of two ascending lists of end offsets with the same last one.

    A group is (a from, a to, b from, b to); a run of one-to-one groups is
    one entry with 0 in the last place. Links are positions in a and b.
    """
    groups, link_a, link_b = [], [], []
    i, n, shift = 0, len(a), 0
    while i < n:
        start, step = i, 1
        while i < n and a[i:i + step] == b[i + shift:i + shift + step]:  # longer and longer stretches
            i, step = min(i + step, n), 2 * step
        while step > 1:  # the first end that differs lies within the last stretch
            step //= 2
            if i < n and a[i:i + step] == b[i + shift:i + shift + step]:
                i = min(i + step, n)
        if i > start:
            groups.append((start, i, start + shift, 0))
            link_a += range(start, i)
            link_b += range(start + shift, i + shift)
        if i == n:
            break
        first, j = i, i + shift
        first_b, x, y = j, a[i], b[j]
        link_a.append(i)
        link_b.append(j)
        while x != y:  # the side that is behind goes on
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
            link_a.append(i)
            link_b.append(j)
        i += 1
        groups.append((first, i, first_b, j + 1))
        shift = j + 1 - i
    return groups, link_a, link_b


_NO_TOKENS = (0, 0, 0, 0, "", [], [], [])
ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pair_a array<int>, pair_b array<int>, pair_n array<int>"


def align_text(pair: Pair, text: str | None, pieces: list[str] | None = None, known: dict | None = None):
    """Values of ALIGNED of one text; ``pieces`` are its pair.pieces() and ``known`` their values, if these are at hand."""
    if not text:
        return _NO_TOKENS
    n_a = n_b = n_groups = n_links = 0
    digest, keys, counts = hashlib.sha256(), [], []
    for values in pair.stretches(text, pieces, known):
        if None in values:
            return _NO_TOKENS
        said, links, of_a, of_b = zip(*values)
        said, links = b";".join(said), np.frombuffer(b"".join(links), "<i8")
        digest.update(b";" + said if n_groups else said)
        n_a, n_b, n_groups, n_links = n_a + sum(of_a), n_b + sum(of_b), n_groups + said.count(b"|"), n_links + len(links)
        k, c = np.unique(links, return_counts=True)
        keys.append(k)
        counts.append(c)
    if len(keys) > 1:
        k, at = np.unique(np.concatenate(keys), return_inverse=True)
        c = np.bincount(at, np.concatenate(counts)).astype(np.int64)
    return n_a, n_b, n_groups, n_links, digest.hexdigest(), (k >> 32).astype(np.int32), (k & 0xFFFFFFFF).astype(np.int32), c.astype(np.int32)


_PAIRS: dict[tuple[str, str], Pair] = {}


def aligned(docs: DataFrame, a_path: str, b_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row (a number of its own), doc_id and ALIGNED of every row; pair_a, pair_b and pair_n are the links summed by id pair."""
    prepare_workers(docs.sparkSession)
    src = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    schema = T.StructType([*src.schema.fields[:2], *T._parse_datatype_string(ALIGNED).fields])
    whole = [pa.int64()] * 4 + [pa.string()]

    def lists(column) -> pa.Array:
        cut = np.concatenate([[0], np.cumsum(list(map(len, column)))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(cut), pa.array(np.concatenate([*column, np.zeros(0, np.int32)]).astype(np.int32)))

    def run(batches):
        key = a_path, b_path
        pair = _PAIRS[key] if key in _PAIRS else _PAIRS.setdefault(key, Pair(*key))
        for batch in batches:
            if not batch.num_rows:
                continue
            texts, got = batch.column(2), []
            for i, j in chunks(raw_text(texts)[1]):
                some = texts.slice(i, j - i).to_pylist()
                pieces = list(map(pair.pieces, some))
                known = pair.kept.fill(list(filter(None, pieces)))  # unknown ones of all texts are encoded and aligned together
                got += map(align_text, repeat(pair), some, pieces, repeat(known))
            got = list(zip(*got))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *(pa.array(x, t) for x, t in zip(got, whole)), *map(lists, got[5:])], names=schema.names)

    return src.mapInArrow(run, schema)


def pair_counts(rows: DataFrame) -> DataFrame:
    """a, b, n (links of the id pair in all documents) and best (n is the highest of its B id)."""
    each = rows.select(F.explode(F.arrays_zip("pair_a", "pair_b", "pair_n")).alias("p"))
    n = each.groupBy(F.col("p.pair_a").alias("a"), F.col("p.pair_b").alias("b")).agg(F.sum("p.pair_n").alias("n"))
    n = written(n, "pairs")
    most = n.groupBy("b").agg(F.max("n").alias("most"))  # a row for each id of B's vocabulary
    return n.join(most, "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def _by_head(rows: DataFrame, head: pa.Table) -> DataFrame:
    """``rows`` with sums over the pairs of the table, and the other pairs."""
    key = head["a"].to_numpy().astype(np.int64) << 32 | head["b"].to_numpy()
    order = np.argsort(key)
    best = head["best"].to_numpy(zero_copy_only=False)
    sent = rows.sparkSession.sparkContext.broadcast((key[order], head["n"].to_numpy()[order], best[order].astype(np.int64)))
    keep = [c for c in rows.columns if not c.startswith("pair_")]
    fields = T._parse_datatype_string("n_best long, count_sum long, rest array<struct<a: int, b: int, n: int>>").fields
    schema = T.StructType([*(rows.schema[c] for c in keep), *fields])
    item = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int32())])

    def run(batches):
        known, total, top = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            *cols, a, b, n = batch.columns
            cut = a.offsets.to_numpy()
            span = slice(cut[0], cut[-1])
            cut = cut - cut[0]
            a, b, n = (x.values.to_numpy()[span] for x in (a, b, n))
            k = a.astype(np.int64) << 32 | b
            at = np.minimum(np.searchsorted(known, k), max(0, len(known) - 1))
            hit = known[at] == k if len(known) else np.zeros(len(k), bool)
            sums = []
            for values in (top, total):
                run_ = np.concatenate([[0], np.cumsum(np.where(hit, values[at] * n, 0) if len(known) else np.zeros(len(k), np.int64))])
                sums.append(pa.array(run_[cut[1:]] - run_[cut[:-1]]))
            left = np.concatenate([[0], np.cumsum(~hit)])[cut].astype(np.int32)
            rest = pa.StructArray.from_arrays([pa.array(x[~hit]) for x in (a, b, n)], fields=list(item))
            yield pa.RecordBatch.from_arrays([*cols, *sums, pa.ListArray.from_arrays(pa.array(left), rest)], names=schema.names)

    return rows.select(*keep, "pair_a", "pair_b", "pair_n").mapInArrow(run, schema)


def report(docs: DataFrame, a_path: str, b_path: str, *, id_col: str = "doc_id", text_col: str = "text", head: int = HEAD) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row.

    ``a_path`` is a byte-level tokenizers file and ``b_path`` a
    sentencepiece model, at the same place on every machine.
    """
    rows = written(aligned(docs, a_path, b_path, id_col=id_col, text_col=text_col), "aligned")
    counts = written(pair_counts(rows), "pair-counts")
    first = counts.orderBy(F.desc("n"), "b", "a").limit(head).toArrow()
    placed = written(_by_head(rows, first), "placed")
    part = placed.select("row", F.explode("rest").alias("r")).select("row", F.col("r.a").alias("a"), F.col("r.b").alias("b"), F.col("r.n").alias("m"))
    part = part.join(counts, ["a", "b"]).select("row", F.when(F.col("best"), F.col("m")).otherwise(0).cast("long").alias("n_best"), (F.col("m") * F.col("n")).alias("count_sum"))
    doc = [c for c in placed.columns if c not in ("row", "n_best", "count_sum", "rest")]
    both = placed.select("row", F.struct(*doc).alias("doc"), "n_best", "count_sum").unionByName(part, allowMissingColumns=True)
    got = both.groupBy("row").agg(F.first("doc", ignorenulls=True).alias("doc"), F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return got.select("doc.doc_id", "doc.n_a", "doc.n_b", "doc.n_groups", "doc.n_links", "n_best", "count_sum", "doc.groups_sha256")
