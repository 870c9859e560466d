"""What each filter of a chain removes, in every order of the filters (operator 11).

1. One pass of a table-driven byte transducer (transducer.py) over each
   text counts words, different words, capitals, code points and symbols.
   Five filters follow from the counts and a digest of the text:

   A  fewer than MIN_WORDS words
   B  different words under LEAST_DISTINCT percent of the words
   C  capitals A-Z above MOST_CAPITALS percent of the code points
   D  the text holds one of SYMBOLS
   E  a smaller doc_id, anywhere in the table, has the same text

2. Documents with the same set of failed filters behave alike in every
   order, so they are counted by (part, failed filters): 32 rows a part at most.
3. Each order and step is a sum over those rows. A document that fails k
   filters is removed by each of them in 120 / k of the 120 orders,
   which gives the Shapley sums directly.

Copies are found without gathering them: the least id of each digest is a
map-side minimum, and a row is the first of its text if (digest, id) is
among those, so no join key is held by many copies.

Defined cases: a null or empty text has no words, fails A only (and E, if
a smaller id has such a text); a row without id never fails E and makes
none fail; rows equal in id and text are first together; a null language is
the part ''; of several labels of an id one with the mark is enough; an
empty table gives no rows; texts of any length are read whole, in pieces;
other columns are not read, whatever their names.
"""

from __future__ import annotations

from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_texts, written
from .transducer import Transducer

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
#: The bounds of the filters, percentages as whole numbers.
MIN_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SYMBOLS = 100, 80, 10, "#$%&*|"
COUNTS = ["n_words", "n_distinct", "n_capitals", "n_points", "n_symbols"]


def measure(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """doc_id, part, digest of the text and its COUNTS, for every row."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{part_col}`"), F.lit("")).alias("part"),
                      F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"))

    def make():
        transducer = Transducer(SYMBOLS.encode())

        def run(texts: pa.Array) -> list[pa.Array]:
            return [pa.array(c) for c in transducer.counts(texts).T.copy()]
        return run

    return map_texts(src, "text", ["doc_id", "part", "digest"], [T.StructField(c, T.LongType()) for c in COUNTS], make)


def failures(measured: DataFrame) -> DataFrame:
    """doc_id, part and the letters of the filters that a document fails, for every row of measure()."""
    own = {"A": F.col("n_words") < MIN_WORDS, "B": 100 * F.col("n_distinct") < LEAST_DISTINCT * F.col("n_words"),
           "C": 100 * F.col("n_capitals") > MOST_CAPITALS * F.col("n_points"), "D": F.col("n_symbols") > 0}
    letters = F.concat(*[F.when(c, F.lit(x)).otherwise(F.lit("")) for x, c in own.items()])
    judged = written(measured.select("doc_id", "part", "digest", letters.alias("own")), "audit")
    first = written(judged.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")), "audit-first")
    first = first.withColumn("is_first", F.lit(True))
    copy = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    return judged.join(first, ["digest", "doc_id"], "left").select("doc_id", "part", F.concat("own", F.when(copy, F.lit("E")).otherwise(F.lit(""))).alias("fails"))


def cells(failed: DataFrame, labels: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """part, fails, n, good, toxic: documents by their failed filters."""
    mark = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("long"))
    known = labels.select(F.col(f"`{id_col}`").alias("doc_id"), "quality", "toxic").where("doc_id is not null")
    known = known.groupBy("doc_id").agg(mark("quality").alias("good"), mark("toxic").alias("toxic"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
    return failed.join(known, "doc_id", "left").groupBy("part", "fails").agg(F.count(F.lit(1)).alias("n"), total("good"), total("toxic"))


def steps(counted: DataFrame) -> DataFrame:
    """One row for each part, filter order and step."""
    rows = counted.groupBy("part").agg(F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("cells"))  # 2^5 at most
    rows = rows.select("part", "cells", F.explode(F.split(F.lit(",".join(ORDERS)), ",")).alias("filter_order"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    rows = rows.select("*", F.expr("substring(filter_order, step, 1)").alias("letter"), F.expr("substring(filter_order, 1, step - 1)").alias("earlier"))
    hit = lambda x: F.contains(x["fails"], F.col("letter"))
    here = lambda x: F.call_function("translate", x["fails"], F.col("earlier"), F.lit("")) == x["fails"]

    def total(of, value) -> Column:
        return F.aggregate("cells", F.lit(0).cast("long"), lambda s, x: s + F.when(of(x), value(x)).otherwise(F.lit(0)).cast("long"))

    n, gone = (lambda x: x["n"]), (lambda x: here(x) & hit(x))
    share = lambda x: F.expr(f"{len(ORDERS)}").cast("long") * x["n"] / F.length(x["fails"])
    return rows.select(
        "part", "filter_order", "step", total(lambda x: here(x) & ~hit(x), n).alias("kept"), total(gone, n).alias("removed"),
        total(lambda x: hit(x) & ~here(x), n).alias("redundant"), total(lambda x: x["fails"] == F.col("letter"), n).alias("unique_fails"),
        total(gone, lambda x: x["good"]).alias("good_lost"), total(gone, lambda x: x["toxic"]).alias("toxic_lost"), total(hit, share).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley."""
    return steps(cells(failures(measure(docs, id_col=id_col, text_col=text_col, part_col=part_col)), labels, id_col=id_col))
