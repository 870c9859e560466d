"""Mixing sources to target weights by weighted fair queueing (operator 7).

The documents of a source are put in a seeded random order. A document
finishes at (words of its source up to and with it) / (target of the
source); a second and third pass over a source go on where the last one
ended. All passes together, range-sorted by finish time, are the mix,
which ends where its words reach the total budget. At finish time 1
every source has had its target.

Running totals come from ``running_total``: a range sort, one sum for
each partition, and an offset for each. So a source that holds most
rows is spread over as many partitions as its rows need; no window or
group holds a whole source. Only one row for each source and one number
for each partition pass through one task.

Defined cases: a null text has size 0; documents of size 0 take no
words; a null source is a source of its own, the last; rows with equal
ids and sizes are interchangeable copies, and each counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylytics.session import cut_lineage

from .common import chunks, fresh, map_texts, prepare_workers, raw_text, written
from .rolling import SPACED

WEIGHTS = (1.0, 2.0, 3.0)
PASSES = 3


def n_words(texts: pa.Array) -> list[pa.Array]:
    """The number of words of each text."""
    raw, offsets = raw_text(texts)
    out = np.zeros(len(texts), np.int64)
    for i, j in chunks(offsets):
        at = offsets[i:j + 1] - offsets[i]
        inside = SPACED.inside[raw[offsets[i]:offsets[j]]]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        cut = at[at < len(inside)]
        first[cut] = inside[cut]  # a word does not run on into the next text
        out[i:j] = np.diff(np.searchsorted(np.flatnonzero(first), at))
    return [pa.array(out)]


def targets(sizes: DataFrame, weights=WEIGHTS, passes: int = PASSES) -> DataFrame:
    """One row for each source (columns ``source``, ``source_size``) with its number and its target in words.

    The total is shared by weight; a source gets ``passes`` times its
    size at most and the rest is shared again, until none is above.
    That is a water level: with sources ordered by passes * size / weight
    the first k are full and the others get level * weight.
    """
    every = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.pmod(F.col("number") - 1, F.lit(len(weights))) + 1)
    t = sizes.withColumn("number", F.row_number().over(every)).withColumn("weight", w)
    t = t.withColumn("most", (passes * F.col("source_size")).cast("double"))
    total = Window.partitionBy()
    # sources that fill up at a lower level, this one included
    fuller = Window.orderBy(F.col("most") / F.col("weight"), "number").rowsBetween(Window.unboundedPreceding, 0)
    t = t.select("*", F.sum("source_size").over(total).cast("double").alias("budget"), F.sum("weight").over(total).alias("weights"),
                 F.sum("most").over(fuller).alias("full_words"), F.sum("weight").over(fuller).alias("full_weight"))
    # the level if the sources before this one are full; the first source that it does not fill sets the level for all
    level = (F.col("budget") - (F.col("full_words") - F.col("most"))) / (F.col("weights") - (F.col("full_weight") - F.col("weight")))
    t = t.withColumn("level", F.min(F.when(level * F.col("weight") <= F.col("most"), F.struct(
        F.col("full_words").alias("at"), F.col("number").alias("n"), level.alias("level")))).over(total)["level"])
    return t.select("source", "source_size", "number", "weight", F.least(
        F.col("most"), F.col("level") * F.col("weight")).alias("target"), F.col("budget").cast("long").alias("budget"))


def running_total(df: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` (a long) over all rows up to and with this one in ``order``.

    Rows that are equal in ``order`` come one after another in any order.
    """
    prepare_workers(df.sparkSession)
    part = fresh(df.columns, "part")
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(part, F.spark_partition_id())
    ranged = cut_lineage(ranged)  # range bounds come from a sample, so the partitions are fixed by writing them
    sums = ranged.groupBy(part).agg(F.sum(value).alias("s")).collect()  # one number for each partition
    offset, at = {}, 0
    for row in sorted(sums, key=lambda r: r[0]):
        offset[row[0]] = at
        at += row[1]
    names = ranged.columns
    where, what = names.index(part), names.index(value)
    schema = T.StructType([*ranged.schema.fields, T.StructField(name, T.LongType())])

    def run(batches):
        at = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if at is None:
                at = offset[batch.column(where)[0].as_py()]
            got = at + np.cumsum(batch.column(what).to_numpy(zero_copy_only=False))
            at = int(got[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.int64())], names=[*names, name])

    return ranged.mapInArrow(run, schema).drop(part)


def plan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         seed: int = 0) -> DataFrame:
    """doc_id, source, size, seeded order and a hash of the text of every row."""
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), order.alias("order"), F.xxhash64(text_col).alias("hash"),
                      F.col(text_col).alias("text"))
    got = map_texts(src, "text", ["doc_id", "source", "order", "hash"], [T.StructField("size", T.LongType())], lambda: n_words)
    return got.select("doc_id", "source", "size", "order", "hash")


def positions(rows: DataFrame, weights=WEIGHTS, passes: int = PASSES) -> DataFrame:
    """``rows`` of plan() with source_size, number, target, budget and upto."""
    rows = written(rows, "mix")  # they are read three times, without the texts then
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = cut_lineage(targets(sizes, weights, passes)).withColumnRenamed("source", "goal_source")
    before = F.sum("source_size").over(Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1))
    goal = goal.withColumn("before", F.coalesce(before, F.lit(0)))
    # sizes within a source add up in the order (number of the source, seeded order)
    joined = rows.join(goal, F.col("source").eqNullSafe(F.col("goal_source"))).drop("goal_source")
    total = running_total(joined, ["number", "order", "hash", "size"], "size", "total")
    return total.withColumn("upto", F.col("total") - F.col("before")).drop("total", "before")


def finish(k) -> Column:
    """Virtual finish time in pass k (0, 1, ...); a source without words has none."""
    return F.when(F.col("target") > 0, (F.lit(k) * F.col("source_size") + F.col("upto")) / F.col("target"))


def entries(placed: DataFrame, passes: int = PASSES) -> DataFrame:
    """All passes over the documents with words, with the words of the mix up to and with each."""
    every = F.array(*[F.struct(F.lit(k).alias("pass"), finish(k).alias("finish")) for k in range(passes)])
    e = placed.where("size > 0").select("number", "order", "size", "upto", "budget", F.explode(every).alias("e"))
    e = e.select("e.finish", "number", "e.pass", "order", "upto", "size", "budget")
    return running_total(e, ["finish", "number", "pass", "upto", "order"], "size", "mixed")


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, passes: int = PASSES, seed: int = 0) -> DataFrame:
    """doc_id, source, size, source_size, target and taken (words in the mix, repeats counted) of every row."""
    rows = plan(docs, id_col=id_col, text_col=text_col, source_col=source_col, seed=seed)
    placed = positions(rows, weights, passes)  # its range sort is written; the rest is cheap enough to do twice
    return _taken(placed, passes).select("doc_id", "source", "size", "source_size", "target", "taken")


def _taken(placed: DataFrame, passes: int) -> DataFrame:
    keys = ["finish", "number", "pass", "upto", "order"]
    last = entries(placed, passes).where(F.col("mixed") <= F.col("budget")).agg(F.max(F.struct(*keys)).alias("last")).first()["last"]
    taken = F.lit(0)
    if last is not None:  # the last entry of the mix: every entry up to it is taken
        end = F.struct(*[F.lit(last[k]).alias(k) for k in keys])
        for k in range(passes):
            mine = F.struct(finish(k).alias("finish"), "number", F.lit(k).alias("pass"), "upto", "order")
            taken = taken + F.when((F.col("size") > 0) & (mine <= end), F.col("size")).otherwise(0)
    return placed.withColumn("taken", taken.cast("long"))


def mixed_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    weights=WEIGHTS, passes: int = PASSES, seed: int = 0) -> DataFrame:
    """The rows that the mix takes, with their columns and size, source_size, target and taken (underscored where they clash).

    Rows equal in id, source and text are one document here; each of them carries what the mix takes of it.
    """
    rows = plan(docs, id_col=id_col, text_col=text_col, source_col=source_col, seed=seed).distinct()
    got = _taken(positions(rows, weights, passes), passes).where("taken > 0")
    new = [fresh(docs.columns, c) for c in ("size", "source_size", "target", "taken")]
    d, g = docs.withColumn(h := fresh(docs.columns, "mix_hash"), F.xxhash64(text_col)).alias("d"), got.alias("g")
    same = (F.col(f"d.`{id_col}`").eqNullSafe(F.col("g.doc_id")) & F.col(f"d.`{source_col}`").eqNullSafe(F.col("g.source"))
            & (F.col(f"d.{h}") == F.col("g.hash")))
    return d.join(g, same).select(*[F.col(f"d.`{c}`") for c in docs.columns],
                                  *[F.col(f"g.{c}").alias(n) for c, n in zip(("size", "source_size", "target", "taken"), new)])
