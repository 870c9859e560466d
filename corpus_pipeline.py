"""Corpus pipeline: documents -> identified, line-deduplicated, near-deduplicated, decontaminated, mixed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes what a stage returns as Parquet in the shared folder and hands
the reread table to the next one. All stages but the last return the
columns of documents. The last adds size, source_size, target and taken
(words that the mix takes of the document, repeats counted).

What a stage decides takes effect on what follows:

1. language   documents without a letter, or too far from every learned profile, go
2. lines      later occurrences of repeated three-line windows and of passages on one or two lines are cut out; a text with nothing left goes
3. near       one document of each class of near-duplicates stays
4. benchmark  contaminated documents go
5. mixing     documents that the mix does not reach go
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylytics.llm import decontaminate, language, line_dedup, mixing, neardup
from staylytics.llm.common import SPACE, table
from staylytics.session import ensure_checkpoint_dir


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_identified(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs, pairs=True).where(F.col("text").rlike(f"[^{SPACE}]"))


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


STAGES = [("language", identify_language), ("lines", dedup_lines), ("near", dedup_near), ("benchmark", drop_contaminated), ("mixing", mix_sources)]

#: Language profiles and near-duplicate classes are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, from the table documents."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(os.path.join(folder, name))
        docs = spark.read.parquet(os.path.join(folder, name))
    return docs
