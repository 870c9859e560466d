"""Near-duplicates by ProbMinHash, banding and verification (operator 3).

1. A task turns each text into weighted five-word shingles (one that
   occurs n times weighs 1 + ln n, so that a line said a hundred times does
   not make two texts alike), draws its ProbMinHash signature (probminhash.py),
   and keeps a hash for each band, one bit for each slot, and a 128-bit
   fingerprint of the words.
2. Exact copies become one node each, however many there are.
3. Nodes that share a band hash are in one bucket. Each node is paired
   with the least node of every bucket it is in; of these the pair whose
   bits agree most is verified first.
4. Then, only for buckets whose nodes are not yet all linked: the nodes
   outside the bucket's largest part are compared with the nodes of all other parts,
   some of them at first and sixteen times as many in each further
   round, until each has been. Both sides are dealt into blocks, and a
   task compares two blocks at a time, so a large bucket is spread over
   many tasks and its pairs are never rows. None of them is lost: two
   nodes are either linked through others already or have been compared.
5. A comparison that the bits rule out (the estimate is four standard
   deviations under the limit) ends there. For all others the exact
   probability Jaccard of the weighted shingles is computed from the
   texts, and pairs of SIMILARITY or more are links. Connected nodes are
   one class.

Hot keys: copies are merged with map-side sums; every join whose one
side may hold a hot key reads two written tables, so Spark splits it.
Nothing but counts reaches the driver. With 40 bands of 8 slots a pair of similarity 0.8
shares a band with probability 0.9994, one of 0.9 with 1 - 1e-10.

Defined cases: a text without words is a class of its own; a text of
fewer than five words is one shingle; null ids are carried along and represent a class only
if it has no other; rows equal in id and text are members both.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, fresh, map_texts, prepare_workers, raw_text
from .common import written as _written
from .probminhash import BANDS, SLOTS, bands_and_bits, fingerprint, probability_jaccard, shingles, signatures

SIMILARITY = 0.8
#: Nodes of a bucket that are compared with its other parts in the first round, and the growth from round to round.
FIRST_LEADERS, MORE_LEADERS = 256, 16
#: Nodes on a side of a tile, about.
BLOCK = 256


def least_agreement(similarity: float) -> int:
    """Bits that agree in a pair of this similarity, less four standard deviations."""
    p = (1 + similarity) / 2
    return int(SLOTS * p - 4 * np.sqrt(SLOTS * p * (1 - p)))


def weights(counts: np.ndarray) -> np.ndarray:
    return 1 + np.log(counts)


def sign(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_hash, f1, f2, bands, bits of every row; bands are empty where the text has no word."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))

    def make():
        def run(texts: pa.Array) -> list[pa.Array]:
            raw, offsets = raw_text(texts)
            n = len(texts)
            prints, bands, bits, full = np.zeros((n, 2), np.int64), np.zeros((n, BANDS), np.int64), np.zeros((n, SLOTS // 64), np.int64), np.zeros(n, bool)
            for i, j in chunks(offsets, rows=64):
                of, element, count = shingles(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                bands[i:j], bits[i:j] = bands_and_bits(signatures(of, element, weights(count), j - i))
                full[i + np.unique(of)] = True
            for i in range(n):
                prints[i] = fingerprint(raw[offsets[i]:offsets[i + 1]].tobytes())
            return [pa.array(prints[:, 0]), pa.array(prints[:, 1]), _lists(bands, full), _lists(bits, full)]
        return run

    longs = T.ArrayType(T.LongType())
    fields = [T.StructField("f1", T.LongType()), T.StructField("f2", T.LongType()), T.StructField("bands", longs), T.StructField("bits", longs)]
    return map_texts(src, "text", ["doc_id", "text_hash"], fields, make)


def _lists(rows: np.ndarray, full: np.ndarray) -> pa.Array:
    sizes = np.where(full, rows.shape[1], 0)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(rows[full].ravel()))


def _verify(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of nodes whose texts have the similarity, with it."""
    p = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    p = p.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").select("a", "b", "text_a", "text_b")

    def one(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        raw, offsets = raw_text(texts)
        out = []
        for i, j in chunks(offsets):
            of, element, count = shingles(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            cut = np.searchsorted(of, np.arange(j - i + 1))
            out += [(element[x:y], weights(count[x:y])) for x, y in zip(cut[:-1], cut[1:])]
        return out

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            got = np.array([probability_jaccard(x, y) for x, y in zip(one(batch.column(2)), one(batch.column(3)))])
            ok = pa.array(got >= similarity - 1e-12)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok), pa.array(got).filter(ok)], names=["a", "b", "similarity"])

    prepare_workers(pairs.sparkSession)
    return p.mapInArrow(run, "a long, b long, similarity double")


def written(df: DataFrame) -> DataFrame:
    """A written table has a known size, so Spark sends a small one to all tasks instead of shuffling both sides of a join by it."""
    return _written(df, "near")


def _roots(parent: DataFrame) -> DataFrame:
    """(node, comp): the root above every node, from a forest of (node, comp) with comp < node."""
    top = parent.select(F.col("comp").alias("node")).distinct().join(parent, "node", "left_anti")
    label = written(parent.select("node", "comp").unionByName(top.select("node", F.col("node").alias("comp"))))
    while True:
        at = F.col
        above = label.select(at("node").alias("comp"), at("comp").alias("next"))
        over = label.select(at("node").alias("next"), at("comp").alias("last"))
        # the label of the label, and its label
        jump = label.join(above, "comp").join(over, "next").select("node", at("last").alias("comp"), (at("last") < at("comp")).alias("moved"))
        label = written(jump)
        if not label.agg(F.max("moved")).first()[0]:
            return label.drop("moved")
        label = label.drop("moved")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of the edges (a, b): comp is the least node that can be reached."""
    both = edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct()
    both = written(both)
    label = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("comp")).withColumnRenamed("a", "node"))
    while True:
        # the label of the label, then the least label of the neighbours
        jump = label.join(label.select(F.col("node").alias("comp"), F.col("comp").alias("next")), "comp").select("node", "comp", "next")
        near = both.join(label.select(F.col("node").alias("b"), F.col("comp").alias("c")), "b").groupBy("a").agg(F.min("c").alias("c"))
        least = F.least("next", "c")
        label = written(jump.join(near, F.col("node") == F.col("a")).select("node", least.alias("comp"), (least < F.col("comp")).alias("moved")))
        if not label.agg(F.max("moved")).first()[0]:
            return label.drop("moved")
        label = label.drop("moved")


def _agreement(a: str, b: str) -> Column:
    """Equal bits of two signatures."""
    same = F.lit(SLOTS)
    for k in range(SLOTS // 64):
        same = same - F.bit_count(F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k))))
    return same


# ---- comparing the parts of a bucket, tile by tile --------------------------

_TILE = ["bucket", "band", "lead_block", "block", "leads", "node", "comp", "chosen"]
_TILE_TYPES = "bucket long, band int, lead_block int, block int, leads boolean, node long, comp long, chosen boolean"


def _tiles(members: DataFrame, leaders: int) -> DataFrame:
    """Rows of the tiles in which the chosen nodes of a bucket meet all its nodes.

    Each side is dealt into blocks of about BLOCK nodes and repeated for
    every block of the other, so n nodes and l chosen ones make
    2 * n * l / BLOCK rows and no pairs.
    """
    blocks = lambda n: F.ceil(n / F.lit(BLOCK)).cast("int")
    m = members.select("*", blocks(F.least("rest", F.lit(2 * leaders))).alias("lead_blocks"), blocks(F.col("n")).alias("blocks"))
    deal = lambda salt, n: F.pmod(F.xxhash64("node", F.lit(salt)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    lead = m.where("chosen").select("bucket", "band", deal(1, "lead_blocks").alias("lead_block"), every("blocks").alias("block"),
                                    F.lit(True).alias("leads"), "node", "comp", "chosen")
    rest = m.select("bucket", "band", every("lead_blocks").alias("lead_block"), deal(2, "blocks").alias("block"),
                    F.lit(False).alias("leads"), "node", "comp", "chosen")
    return lead.unionByName(rest)


def _by_tile(rows: DataFrame, step, schema: str) -> DataFrame:
    """``step`` on the rows of each tile, given as a dict of arrays; rows of a tile are next to each other."""
    names, key = rows.columns, ["bucket", "lead_block", "block"]
    rows = rows.repartition(*key).sortWithinPartitions(*key)

    def run(batches):
        held: list[pa.Table] = []

        def tiles(table: pa.Table, whole: bool):
            """Results of the tiles in the table, and the rows of the last one if it may go on."""
            k = [table[c].to_numpy() for c in key]
            cut = np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([x[1:] != x[:-1] for x in k])]))
            ends = np.append(cut[1:], table.num_rows)
            for a, b in list(zip(cut, ends))[:None if whole else -1]:
                if b - a > 1:
                    yield step(table.slice(a, b - a))
            if not whole:
                held[:] = [table.slice(cut[-1])]

        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.concat_tables([*held, pa.Table.from_batches([batch])])
            held.clear()
            yield from (x for got in tiles(t, False) if got is not None for x in got.to_batches())
        if held:
            yield from (x for got in tiles(held[0].combine_chunks(), True) if got is not None for x in got.to_batches())

    assert names[:len(_TILE)] == _TILE
    prepare_workers(rows.sparkSession)
    return rows.mapInArrow(run, schema)


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy() for c in column.chunks]).reshape(-1, width)


def _candidates(t: pa.Table, enough: int):
    """(row of the leading node, row of the other, equal bits) of the pairs that a tile is to compare.

    Pairs of one part are linked already. A pair that shares several
    bands is left to the tiles of the first one.
    """
    leads = t["leads"].to_numpy()
    a, b = np.flatnonzero(leads), np.flatnonzero(~leads)
    node, comp, chosen = (t[c].to_numpy() for c in ("node", "comp", "chosen"))
    bits, prints = _matrix(t["bits"], SLOTS // 64).view(np.uint64), _matrix(t["prints"], BANDS)
    same = np.full((len(a), len(b)), SLOTS)
    for k in range(SLOTS // 64):
        same -= np.bitwise_count(bits[a, k][:, None] ^ bits[b, k][None, :])
    ok = (same >= enough) & (comp[a][:, None] != comp[b][None, :]) & (~chosen[b][None, :] | (node[a][:, None] < node[b][None, :]))
    i, j = np.nonzero(ok)
    first = (prints[a[i]] == prints[b[j]]).argmax(axis=1)
    mine = first == t["band"][0].as_py()
    i, j = i[mine], j[mine]
    return a[i], b[j], same[i, j]


def _narrow(enough: int):
    """Keeps the rows of a tile that are in a pair to compare."""
    def step(t: pa.Table):
        a, b, _ = _candidates(t, enough)
        return t.select(_TILE).take(np.unique(np.concatenate([a, b]))) if len(a) else None
    return step


def _link(enough: int, similarity: float):
    """Compares texts, the most alike first, until the parts that can be linked are; gives the links that did it."""
    def step(t: pa.Table):
        a, b, same = _candidates(t, enough)
        node, comp = t["node"].to_numpy(), t["comp"].to_numpy()
        parent: dict[int, int] = {}
        known: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def root(x):
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        def of(row):
            n = int(node[row])
            if n not in known:
                known[n] = _weighted(t["text"][int(row)].as_py().encode())
            return known[n]

        out = []
        for k in np.argsort(-same, kind="stable"):
            x, y = root(int(comp[a[k]])), root(int(comp[b[k]]))
            if x != y and probability_jaccard(of(a[k]), of(b[k])) >= similarity - 1e-12:
                parent[max(x, y)] = min(x, y)
                out.append((int(node[a[k]]), int(node[b[k]])))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())}) if out else None
    return step


def _weighted(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(body, np.uint8)
    _, element, count = shingles(raw, np.array([0, len(raw)]))
    return element, weights(count)


def _relabel(frame: DataFrame, comps: DataFrame, of: str) -> DataFrame:
    """``frame`` with its column ``of`` replaced by the component of that node, if it has one."""
    c = comps.select(F.col("node").alias("_node"), F.col("comp").alias("_comp"))
    return frame.join(c, F.col(of) == F.col("_node"), "left").withColumn(of, F.coalesce("_comp", of)).drop("_node", "_comp")


def link_classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, text_hash, class_id (least id of the class), class_hash (its text) and class_size of every row."""
    signed = written(sign(docs, id_col, text_col))
    full = signed.where(F.size("bands") > 0)
    nodes = full.groupBy("f1", "f2").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("rep"),
                                            F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands"), F.first("bits").alias("bits"))
    nodes = written(nodes.select(F.monotonically_increasing_id().alias("node"), "f1", "f2", F.col("rep.doc_id").alias("rep_id"),
                                     F.col("rep.text_hash").alias("rep_hash"), "copies", "bands", "bits"))
    comp = _linked(nodes, docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), similarity)
    known = nodes.select("node", "f1", "f2", "rep_id", "rep_hash", "copies", F.col("node").alias("comp"))
    known = _relabel(known, comp, "comp")
    classes = known.groupBy("comp").agg(F.min(F.struct(F.col("rep_id").isNull(), "rep_id", "rep_hash")).alias("rep"), F.sum("copies").alias("class_size"))
    of = known.select("f1", "f2", "comp").join(written(classes), "comp")
    of = written(of.select("f1", "f2", F.col("rep.rep_id").alias("class_id"), F.col("rep.rep_hash").alias("class_hash"), "class_size"))
    member = full.select("doc_id", "text_hash", "f1", "f2").join(of, ["f1", "f2"]).drop("f1", "f2")
    alone = signed.where(F.size("bands") == 0).select("doc_id", "text_hash", F.col("doc_id").alias("class_id"), F.col("text_hash").alias("class_hash"),
                                                      F.lit(1).cast("long").alias("class_size"))
    return member.unionByName(alone)


def is_kept() -> Column:
    """The document that represents its class."""
    return F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("text_hash") == F.col("class_hash"))


def _linked(nodes: DataFrame, docs: DataFrame, similarity: float) -> DataFrame:
    """(node, comp) of nodes that are linked with another one."""
    enough = least_agreement(similarity)
    band = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    lead = written(band.groupBy("bucket").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    members = written(band.join(lead, "bucket").select("bucket", "band", "node", "leader"))
    data = written(nodes.join(members.select("node").distinct(), "node", "left_semi").select(
        "node", "bits", F.transform("bands", lambda x: x.bitwiseAND(F.lit((1 << 31) - 1)).cast("int")).alias("prints"), "rep_id", "rep_hash"))
    t = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    # rows equal in id and text hash are copies: one of them is enough
    texts = written(data.select("node", "rep_id", "rep_hash").join(t, F.col("rep_id").eqNullSafe(F.col("doc_id")) & (
        F.col("rep_hash") == F.col("text_hash"))).groupBy("node").agg(F.min("text").alias("text")))
    data = data.select("node", "bits", "prints")

    # each node and the least node of one of its buckets, the one most like it
    pairs = members.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    of = lambda c: data.select(F.col("node").alias(c), F.col("bits").alias(f"bits_{c}"))
    judged = pairs.join(of("b"), "b").join(of("a"), "a").select("a", "b", _agreement("bits_a", "bits_b").alias("same")).where(F.col("same") >= enough)
    best = judged.groupBy("b").agg(F.max_by("a", F.struct("same", -F.col("a"))).alias("a")).select("a", "b")
    # each node has one link to a lesser node here: a forest
    comp = _roots(written(_verify(best, texts, similarity).select(F.col("b").alias("node"), F.col("a").alias("comp"))))

    # buckets of more than one part
    members = members.select("bucket", "band", "node", F.col("node").alias("comp"), F.lit(False).alias("tried"))
    members = _relabel(members, comp, "comp")
    leaders = FIRST_LEADERS
    while True:
        parts = members.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"), F.sum((~F.col("tried")).cast("int")).alias("untried"))
        open_ = parts.groupBy("bucket").agg(F.max(F.struct("n", "comp")).alias("main"), F.sum("n").alias("n"), F.sum("untried").alias("untried"),
                                            F.max_by("untried", F.struct("n", "comp")).alias("in_main"))
        open_ = open_.select("bucket", "n", F.col("main.comp").alias("main"), (F.col("untried") - F.col("in_main")).alias("rest"))
        open_ = written(open_.where("rest > 0"))
        if not open_.count():
            return comp
        # about ``leaders`` of the nodes outside the main part, by hash; all of them if there are no more
        draw = F.pmod(F.xxhash64("bucket", "node"), F.lit(1 << 30)) * F.col("rest") < F.lit(leaders << 30)
        chosen = ~F.col("tried") & (F.col("comp") != F.col("main")) & ((F.col("rest") <= leaders) | draw)
        members = written(members.join(open_, "bucket").select("bucket", "band", "node", "comp", "tried", "n", "rest", chosen.alias("chosen")))
        tiles = _tiles(members, leaders).join(data, "node").select(*_TILE, "bits", "prints")
        full = _by_tile(tiles, _narrow(enough), _TILE_TYPES).join(data, "node").join(texts, "node").select(*_TILE, "bits", "prints", "text")
        links = written(_by_tile(full, _link(enough, similarity), "a long, b long"))
        members = members.select("bucket", "band", "node", "comp", (F.col("tried") | F.col("chosen")).alias("tried"))
        if links.count():
            joined = components(written(_relabel(_relabel(links, comp, "a"), comp, "b")))
            every = comp.select("node").union(joined.select("node")).union(links.select("a")).union(links.select("b")).distinct()
            comp = written(_relabel(_relabel(every.select("node", F.col("node").alias("comp")), comp, "comp"), joined, "comp"))
            members = _relabel(members, joined, "comp")
        members = written(members)
        leaders *= MORE_LEADERS


def report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id, class_size and is_kept (the document that represents its class) of every row."""
    got = link_classes(docs, id_col=id_col, text_col=text_col)
    return got.select("doc_id", "class_id", "class_size", is_kept().alias("is_kept"))


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class (the least id), with all its columns; of rows equal in id and text one stays."""
    # rows equal in id and text are in one class: all of them represent it, or none does
    every = link_classes(docs, id_col=id_col, text_col=text_col).groupBy("doc_id", "text_hash")
    every = written(every.agg(F.max(is_kept()).alias("kept"), F.count(F.lit(1)).alias("n")))
    gone = written(every.where("not kept").select("doc_id", "text_hash"))  # most rows stay, so a table of the others is often small enough for all tasks
    h = fresh(docs.columns, "text_hash")
    d, g = docs.withColumn(h, F.xxhash64(text_col)).alias("d"), gone.alias("g")
    rows = d.join(g, F.col(f"d.`{id_col}`").eqNullSafe(F.col("g.doc_id")) & (F.col(f"d.{h}") == F.col("g.text_hash")), "left_anti")
    if every.where("kept and n > 1").count():
        rows = rows.dropDuplicates([id_col, h])
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])
