"""License scan by canonical digests (operator 1), by built-in functions only.

A text is made canonical: ASCII letters in lower case, copyright lines
out, every run of punctuation a blank, equivalent spellings alike. The
SHA-256 of the whole canonical text is hash-joined to the digests of the
known licence texts. The digest of each line is also looked up among
those of the known one-line notices, so that a licensed document is
found as well as a licence itself. Documents are not shuffled: the known
licences are a list in the program, so their digests are small.

Defined cases: a null or empty text has the digest of the empty text and
no licence; a text of copyright lines only is empty; a line found more
than once counts once in ``notices``; rows are scanned one by one.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .license_texts import HEADERS, NAMES, OPENINGS, OTHER_NOTICES, TEXTS, VERSIONED

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A line that states a copyright: the word or sign with a year, a place for one, or the sign.
COPYRIGHT = (r"(^|\n)[ \t*#/;%-]*(?:copyright[ \t]*(?:\(c\)|©)|(?:copyright|\(c\)|©)[ \t]*(?:[0-9]{4}|<year>|\[year\]|\{year\})|©)[^\n]*")
PUNCTUATION = r"[^0-9a-z\n\x{80}-\x{10FFFF}]+"
#: Equivalent spellings, applied in this order to canonical text.
SPELLINGS = [("licence", "license"), ("sub license", "sublicense"), ("non commercial", "noncommercial"), ("non infringement", "noninfringement"),
             ("copyright owner", "copyright holder"), ("organisation", "organization"), ("favour", "favor"), ("acknowledgement", "acknowledgment"),
             ("judgement", "judgment"), ("whilst", "while"), ("per cent", "percent"), ("https", "http")]
RESERVED = "all rights reserved"


def _alike(text: Column) -> Column:
    return functools.reduce(lambda t, s: F.replace(t, F.lit(s[0]), F.lit(s[1])), SPELLINGS, text)


def canonical_lines(text: Column) -> Column:
    """The canonical lines of a text that are not empty."""
    t = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    t = F.regexp_replace(F.regexp_replace(t, COPYRIGHT, "$1"), PUNCTUATION, " ")
    return F.filter(F.transform(F.split(_alike(t), "\n"), lambda x: F.trim(x)), lambda x: x != "")


def canonical(lines: Column) -> Column:
    """The canonical text of canonical lines; spellings that a line break parts are made alike here."""
    return _alike(F.array_join(F.filter(lines, lambda x: x != RESERVED), " "))


def notices() -> list[tuple[str, str]]:
    """(licence, notice) of all known one-line notices."""
    out = [(license_id, f"{o} {n}") for license_id, _, names in NAMES for n in names for o in OPENINGS]
    out += [(license_id, line) for license_id, _, lines in HEADERS for line in lines]
    out += [(i, f"SPDX-License-Identifier: {i}{s}") for i in kinds() for s in ["", *(["-only", "-or-later"] if i in VERSIONED else [])]
            if any(c.isdigit() for c in i) or i in ("ISC", "MIT")]
    return out + [(i, text) for i, _, text in OTHER_NOTICES]


def kinds() -> dict[str, str]:
    return {i: k for i, k, _ in [*NAMES, *HEADERS, *OTHER_NOTICES]} | {"0BSD": "permissive"}


def _listed(spark: SparkSession, rows) -> DataFrame:
    """A list of the program as a table (license_id, text) of literals."""
    each = [F.struct(F.lit(i).alias("license_id"), F.lit(t).alias("text")) for i, t in rows]
    empty = F.array().cast("array<struct<license_id:string,text:string>>")
    return spark.range(1).select(F.inline(F.array(*each) if each else empty))


def known_texts(spark: SparkSession, texts=None) -> DataFrame:
    """(license_id, digest) of whole licence texts given as (licence, text); of two with one digest the first in order."""
    rows = _listed(spark, TEXTS if texts is None else texts)
    return rows.select("license_id", F.sha2(canonical(canonical_lines(F.col("text"))), 256).alias("digest")).groupBy("digest").agg(
        F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", texts=None, lines=None) -> DataFrame:
    """doc_id, digest, license_id (the whole text is this licence), notices (licences named in lines), restricted."""
    spark = docs.sparkSession
    named = _listed(spark, notices() if lines is None else lines)
    by_digest: dict[str, str] = {}
    for r in named.select("license_id", F.sha2(F.array_join(canonical_lines(F.col("text")), " "), 256).alias("line")).collect():
        by_digest[r["line"]] = min(r["license_id"], by_digest.get(r["line"], r["license_id"]))
    of_license: dict[str, list[str]] = {}
    for d, i in by_digest.items():
        of_license.setdefault(i, []).append(d)
    d = docs.select(F.col(id_col).alias("doc_id"), canonical_lines(F.col(text_col)).alias("lines"))
    each = F.array_distinct(F.transform("lines", lambda x: F.sha2(x, 256)))
    known = F.array(*map(F.lit, sorted(by_digest))) if by_digest else F.array().cast("array<string>")
    d = d.select("doc_id", F.sha2(canonical(F.col("lines")), 256).alias("digest"), F.array_intersect(each, known).alias("found"))
    ids = [F.when(F.arrays_overlap("found", F.array(*map(F.lit, of_license[i]))), F.lit(i)) for i in sorted(of_license)]
    d = d.select("doc_id", "digest", F.when(F.size("found") > 0, F.array_compact(F.array(*ids))).otherwise(
        F.array().cast("array<string>")).alias("ids") if ids else F.array().cast("array<string>").alias("ids"))
    whole = known_texts(spark, texts)
    d = d.join(F.broadcast(whole), "digest", "left")  # a row for each text of the program's list
    strict = [i for i, k in kinds().items() if k != "permissive"]
    held = F.arrays_overlap(F.col("ids"), F.array(*map(F.lit, strict))) | F.coalesce(F.col("license_id").isin(strict), F.lit(False))
    return d.select("doc_id", "digest", "license_id", F.array_join("ids", ",").alias("notices"), held.alias("restricted"))
