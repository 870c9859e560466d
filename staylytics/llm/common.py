"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylytics.session import ensure_checkpoint_dir, ship_package

#: Bytes of one Arrow batch handed to Python; very long texts then travel alone.
BATCH_BYTES = 8 << 20
#: Text bytes that one round of numpy work inside a task covers (a longer text is a round of its own).
CHUNK_BYTES = 1 << 20
#: White space between words: blank and 0x09 to 0x0D.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df``, written as Parquet in the shared folder and read again."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(columns, name: str) -> str:
    """``name``, with underscores in front until no column is called so (case does not matter)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def prepare_workers(spark: SparkSession) -> None:
    """For jobs with Python in their tasks.

    Arrow batches are cut by bytes, so that a worker's memory does not
    follow the longest texts, and the workers get this package.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    ship_package(spark)


def words_array(text: Column) -> Column:
    """The words of a text (null: none) as an array, by built-in functions."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), "")


def held_out(doc_id: Column) -> Column:
    """The fold that no model learns from: crc32 of the id's text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def raw_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all texts, offsets of each text and the end); a null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES, rows: int = 1 << 15) -> Iterator[tuple[int, int]]:
    """Ranges of at most ``rows`` rows and ``limit`` bytes, one row at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = min(i + rows, max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1))
        yield i, min(j, n)
        i = min(j, n)


def map_texts(df: DataFrame, text_col: str, keep: list[str], fields: list[T.StructField],
              make: Callable[[], Callable[[pa.Array], list[pa.Array]]]) -> DataFrame:
    """``keep`` columns of every row plus ``fields`` computed from its text, batch by batch.

    ``make()`` runs once in each task and returns a function from the
    text array of a batch to one array for each field. Field names must
    not clash with ``keep`` (use ``fresh``). No row is added or lost.
    """
    prepare_workers(df.sparkSession)
    if text_col in keep:
        src, at = df.select(*[F.col(f"`{c}`") for c in keep]), keep.index(text_col)
    else:
        src = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").alias(fresh(keep, "text_in")))
        at = len(keep)
    n_keep = len(keep)
    schema = T.StructType([*src.schema.fields[:n_keep], *fields])

    def run(batches):
        fn = make()
        for batch in batches:
            if batch.num_rows == 0:
                continue
            got = fn(batch.column(at))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n_keep], *got], names=schema.names)

    return src.mapInArrow(run, schema)
