"""Token ids of documents as Parquet files that can be read in parts (operator 12).

``write`` makes a folder of

* ``tokens/``  one row for each document, in ascending id order over all
  files: doc_id, part (the file), at (ids of the file's documents before
  it), n_tokens, ids (list of int, the end id last). ``ids`` is dictionary
  encoded (delta where a dictionary does not pay), doc_id, at and n_tokens
  are delta encoded. Row groups, pages and rows in a page are bounded, and
  the files have page indexes, so a reader skips pages by doc_id or at.
* ``index/``   one row for each file: part, start (ids of all files before
  it), n_docs, n_tokens.

``read`` gives chosen columns (metadata alone never touches the ids),
``read_documents`` a range of ids and ``read_tokens`` a range of token
places.

Texts are range-partitioned by id and encoded behind the shuffle, so they are encoded
once. Rows with equal ids are ordered by text hash and then by their place
in the input, and range partitions may cut between them, so one id with a third
of all rows is spread over many files. What passes through the driver is one row for each file.

Where the tokenizer's rules are those of ``cuts_at_blanks``, texts are cut
into words, the different words of a batch into parts as these say, and the ids of a part,
from the library, are kept by the worker; with other rules whole texts go to the library.

Defined cases: a null or empty text has the end id only; null ids come
first; rows with equal ids are written one by one; an empty table is written as files
without rows; texts of any length are encoded whole; other columns are
not read, whatever their names.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, prepare_workers, raw_text
from .pieces import BYTE_LETTERS, Table, kept, load_tokenizer

END_ID = 1
#: Bytes of a row group and of a page, and rows in a page at most.
ROW_GROUP_BYTES, PAGE_BYTES, PAGE_ROWS = 32 << 20, 256 << 10, 2000
#: Text bytes that are cut into words together (a longer text is by itself).
ROUND_BYTES = 2 << 20
#: Rules with which a text can be cut at ASCII white space. Nothing that is matched holds white space.
BLANK_RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
    "post_processor": None,
}

#: Letters of Latin script that are one code point, stay so in NFC and have one lower-case letter.
_LATIN = "\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u017e"
#: What is not such a letter, printable ASCII or ASCII white space; and what may be a special token.
_ODD = f"[^\t-\r -~{_LATIN}]|<\\|"
#: The pattern of BLANK_RULES for words in lower case without any of that.
_PARTS = f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{_LATIN}]+|[0-9]|[!-/:-@\\[-`{{-~]+"

TOKENS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("at", T.LongType()),
    T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])
INDEX = "part int, start long, n_docs long, n_tokens long"


def cuts_at_blanks(model) -> bool:
    """Whether ASCII white space separates what the tokenizer encodes: BLANK_RULES, and added tokens without white space, which begin with <|."""
    rules = json.loads(model.to_str())
    return all(rules[k] == v for k, v in BLANK_RULES.items()) and not any(
        set(t["content"]) & set(" \t\n\v\f\r") or not t["content"].startswith("<|") or t["normalized"] or t["single_word"] for t in rules["added_tokens"])


def _byte_letters(part: str) -> str:
    """A plain part with its bytes as the letters that stand for them."""
    return part if part.isascii() else part.encode().decode("latin-1").translate(BYTE_LETTERS)


def _keys(words: pa.Array) -> pa.ListArray:
    """What the words are looked up by: the parts of a word as BLANK_RULES cut it, and a word with anything odd whole."""
    parts = pc.replace_substring_regex(pc.utf8_lower(words), pattern=_PARTS, replacement="\\0 ")
    return pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.if_else(pc.match_substring_regex(words, _ODD), words, parts)))


def _joined(lists: pa.ListArray, at: pa.Array, offsets: pa.Array) -> pa.ListArray:
    """The lists at these places, those between two offsets as one list."""
    lists = lists.take(at)
    return pa.ListArray.from_arrays(lists.offsets.take(offsets), lists.values)


def id_bytes(path: str):
    """A function from texts (a list or an Arrow array without nulls) to the ids of each, as little-endian 32-bit bytes."""
    model = load_tokenizer(path)

    def encode(texts) -> list[bytes]:
        texts = texts.to_pylist() if isinstance(texts, pa.Array) else texts
        got = model.encode_batch_fast(texts, add_special_tokens=False) if texts else []
        return [np.array(e.ids, "<u4").tobytes() for e in got]

    if not cuts_at_blanks(model):
        return encode
    bpe, odd = model.model, re.compile(_ODD)

    def encode_key(key: str) -> bytes:
        # a part as BLANK_RULES cut it is given to the library's merges; another word is the library's from the start
        return encode([key])[0] if odd.search(key) else array("I", map(attrgetter("id"), bpe.tokenize(_byte_letters(key)))).tobytes()

    table = kept(path, lambda: Table(encode_key))

    def by_part(texts: pa.Array) -> list[bytes]:
        # a word is cut once, and a part looked up once, however often these texts have it
        words = pc.ascii_split_whitespace(texts)
        word = words.values.dictionary_encode()
        keys = _keys(word.dictionary)
        key = keys.values.dictionary_encode()
        table.trim()
        ids = [table[k] for k in key.dictionary.to_numpy(zero_copy_only=False)]
        cut = np.concatenate([[0], np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)) // 4)])
        ids = pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(np.frombuffer(b"".join(ids), "<i4")))
        ids = _joined(_joined(ids, key.indices, keys.offsets), word.indices, words.offsets)
        cut, body = ids.offsets.to_numpy().astype(np.int64) * 4, memoryview(ids.values.to_numpy()).cast("B")
        return [bytes(body[a:b]) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]

    def rounds(texts) -> list[bytes]:
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        return [x for i, j in chunks(raw_text(texts)[1], ROUND_BYTES) for x in by_part(texts.slice(i, j - i))]

    return rounds


def encoded(docs: DataFrame, tokenizer: str, end_id: int = END_ID, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of TOKENS in ascending id order."""
    prepare_workers(docs.sparkSession)
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    order = ["doc_id", "tie", "place"]
    src = src.withColumn("tie", F.xxhash64("text")).withColumn("place", F.monotonically_increasing_id())
    src = src.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", F.spark_partition_id().alias("part"), "text")
    names, end = TOKENS.names, np.array([end_id], "<u4").tobytes()

    def run(batches):
        ids_of, at = id_bytes(tokenizer), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [x + end for x in ids_of(batch.column(2))]
            n = np.array([len(x) // 4 for x in rows], np.int64)
            cut = np.concatenate([[0], np.cumsum(n)])
            ids = pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(np.frombuffer(b"".join(rows), "<i4")))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(at + cut[:-1]), pa.array(n), ids], names=names)
            at += int(cut[-1])

    return src.mapInArrow(run, TOKENS)


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, *, id_col: str = "doc_id", text_col: str = "text",
          row_group_bytes: int = ROW_GROUP_BYTES, page_bytes: int = PAGE_BYTES, page_rows: int = PAGE_ROWS) -> None:
    """Encodes the documents and writes ``folder``; the tokenizer file has the same path on every machine."""
    options = {"parquet.writer.version": "v2", "parquet.block.size": row_group_bytes, "parquet.page.size": page_bytes,
               "parquet.page.row.count.limit": page_rows, "parquet.enable.dictionary": "true", "compression": "snappy"}
    options |= {f"parquet.enable.dictionary#{c}": "false" for c in ("doc_id", "at", "n_tokens")}
    spark = docs.sparkSession
    encoded(docs, tokenizer, end_id, id_col=id_col, text_col=text_col).write.options(**options).parquet(f"{folder}/tokens")
    rows = tokens(spark, folder).groupBy("part").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).collect()
    index, start = [], 0
    for r in sorted(rows, key=lambda r: r["part"]):
        index.append((r["part"], start, r["n_docs"], r["n_tokens"]))
        start += r["n_tokens"]
    spark.createDataFrame(index, INDEX).coalesce(1).write.parquet(f"{folder}/index")


def tokens(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(TOKENS).parquet(f"{folder}/tokens")


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids; columns that are not chosen are not read."""
    first = F.broadcast(read_index(spark, folder).select("part", F.col("start").alias("first")))  # a row for each file
    return tokens(spark, folder).join(first, "part").select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids")


def read_documents(spark: SparkSession, folder: str, first_id: int, last_id: int) -> DataFrame:
    """read() of the documents whose id lies between the two, both included; pages of others are skipped."""
    return read(spark, folder).where(F.col("doc_id").between(first_id, last_id))


def read_tokens(spark: SparkSession, folder: str, start: int, n: int) -> DataFrame:
    """doc_id, start and ids of the ``n`` ids from place ``start`` on, cut to that range; pages of others are skipped."""
    end = start + n
    hit = read_index(spark, folder).where((F.col("start") < end) & (F.col("start") + F.col("n_tokens") > start)).orderBy("part").collect()
    if n <= 0 or not hit:
        return read(spark, folder).select("doc_id", "start", "ids").limit(0)
    first, last = hit[0], hit[-1]
    # in the first file a document may begin before ``start``: the last such place is found among the metadata
    t = tokens(spark, folder).where(F.col("part").between(first["part"], last["part"]))
    before = t.where((F.col("part") == first["part"]) & (F.col("at") <= start - first["start"])).agg(F.max("at")).first()[0]
    t = t.where(((F.col("part") > first["part"]) | (F.col("at") >= before)) & ((F.col("part") < last["part"]) | (F.col("at") < end - last["start"])))
    at = F.broadcast(read_index(spark, folder).select("part", F.col("start").alias("first")))
    t = t.join(at, "part").withColumn("start", F.col("first") + F.col("at"))
    skip = F.greatest(F.lit(0), F.lit(start) - F.col("start"))
    size = F.least(F.col("n_tokens"), F.lit(end) - F.col("start")) - skip
    return t.where(size > 0).select("doc_id", (F.col("start") + skip).alias("start"), F.slice("ids", (skip + 1).cast("int"), size.cast("int")).alias("ids"))


def checksums(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (of the ids as little-endian 32-bit integers) of rows of read()."""
    prepare_workers(rows.sparkSession)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(3)
            cut, body = ids.offsets.to_numpy(), memoryview(ids.values.to_numpy().astype("<u4", copy=False)).cast("B")
            crc = [zlib.crc32(body[4 * a:4 * b]) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.select("doc_id", "start", "n_tokens", "ids").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
