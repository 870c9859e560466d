"""Token files against the library's ids, and what their footers say."""

import glob
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from staylytics.llm import pieces, token_files
from staylytics.llm.queries import tokenizer

WORD = tokenizer("word_bpe_49k.json")
LETTERS = [*" \n\t\x0b\x0c\r\x1c\x1f\x85\xa0aBcS'9.ßΣσς#é漢　 ́İ\x00\U0001F600ﬁ", "the ", "don't ", "ΑΣ", "<|endoftext|>", "<|startoftext|>", "<|endof", "  ", "'LL", "é", "x" * 70, "\xc9T\xc9", "\u0152uvre,", "\u0130", "\u0149\u0133", "\xd7", "Don'T'll", "'sup", "..'s"]


def odd_texts():
    r = random.Random(3)
    texts = ["".join(r.choice(LETTERS) for _ in range(r.randint(0, 60))) for _ in range(600)]
    return texts + [None, "", " ", "a<|endoftext|> b", "word " * 4000, "x" * 3000, "é" * 500]


def whole(texts):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(WORD)
    return [[*e.ids, 1] for e in model.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_pieces_are_the_library_ids(monkeypatch):
    texts = odd_texts()
    assert token_files.cuts_at_blanks(pieces.load_tokenizer(WORD))
    assert not token_files.cuts_at_blanks(pieces.load_tokenizer(tokenizer("byte_bpe_50k.json")))
    want = [np.array(x[:-1], "<u4").tobytes() for x in whole(texts)]
    ids = token_files.id_bytes(WORD)
    assert ids([t or "" for t in texts]) == want
    monkeypatch.setattr(pieces, "KEPT_PARTS", 5)  # the table starts anew again and again
    assert ids([t or "" for t in texts]) == want


def test_every_letter_that_is_cut_without_the_library():
    plain = [c for c in map(chr, range(0x180)) if not c.isspace() and not re.search(token_files._ODD, c)]
    assert len(plain) > 200
    texts = [f"{c} a{c}B {c}{c}1{c} '{c} .'{c}\x0b{c}'S'{c}" for c in plain] + ["\x1c".join(plain), "\x85".join(plain), "<|ENDOFTEXT|> <|endoftext|>.", "\t\n\x0b\x0c\r "]
    ids = token_files.id_bytes(WORD)
    assert ids(texts) == ids(pa.array(texts)) == [np.array(x[:-1], "<u4").tobytes() for x in whole(texts)]
    assert ids([]) == []


def test_repeated_words_are_looked_up_once(monkeypatch):
    looked = []

    class Table(pieces.Table):
        def __getitem__(self, piece):
            looked.append(piece)
            return super().__getitem__(piece)

    monkeypatch.setattr(token_files, "Table", Table)
    monkeypatch.setattr(token_files, "kept", lambda key, make: make())
    texts = ["Some words, and some (more) words. " * 200, None, "words 漢 漢字, " * 100, "words " + "漢" * 90]
    got = token_files.id_bytes(WORD)([t or "" for t in texts])
    assert got == [np.array(x[:-1], "<u4").tobytes() for x in whole(texts)]
    assert len(looked) == len(set(looked)) < 15


def test_long_pieces_are_not_kept():
    table = pieces.Table(str.upper)
    assert [table[p] for p in ("ab", "x" * 65)] == ["AB", "X" * 65] and list(table) == ["ab"]


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    texts = odd_texts()
    rows = [(i if i % 50 else None, t, "x", 1) for i, t in enumerate(texts)] + [(7, f"again {k}", "x", 1) for k in range(40)] + [(7, "same", "x", 1)] * 30
    rows += [(1000 + i, f"row {i} of some words, number {i * i}", "x", 1) for i in range(2500)]
    d = spark.createDataFrame(rows, "doc_id long, text string, part string, n_tokens int").repartition(4)
    folder = str(tmp_path_factory.mktemp("tokens") / "t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files
    token_files.write(d, folder, WORD, row_group_bytes=1 << 12, page_bytes=1024, page_rows=20)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    return folder, rows


def test_round_trip(spark, files):
    folder, rows = files
    ids = whole([t for _, t, *_ in rows])
    got = sorted(token_files.read(spark, folder).collect(), key=lambda r: r["start"])
    key = lambda i: (i is not None, i or 0)
    assert [r["doc_id"] for r in got] == sorted((i for i, *_ in rows), key=key)
    at = 0
    for r in got:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        at += r["n_tokens"]
    assert sorted((key(r["doc_id"]), r["ids"]) for r in got) == sorted((key(i), x) for (i, *_), x in zip(rows, ids))
    sums = token_files.checksums(token_files.read(spark, folder)).collect()
    assert sorted((key(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in sums) == sorted(
        (key(i), len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for (i, *_), x in zip(rows, ids))


def test_reads_parts(spark, files):
    folder, _ = files
    rows = sorted(token_files.read(spark, folder).collect(), key=lambda r: r["start"])
    every = [x for r in rows for x in r["ids"]]
    assert {r["doc_id"] for r in token_files.read_documents(spark, folder, 11, 19).collect()} == set(range(11, 20))
    r = random.Random(5)
    for start, n in [(0, 1), (0, len(every)), (len(every) - 1, 5), (len(every), 3), (5, 0), *((r.randrange(len(every)), r.randint(1, 3000)) for _ in range(6))]:
        got = sorted(token_files.read_tokens(spark, folder, start, n).collect(), key=lambda x: x["start"])
        assert [x for g in got for x in g["ids"]] == every[start:start + n]
        assert not got or got[0]["start"] == start
    plan = token_files.read(spark, folder).select("doc_id", "n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan
    plan = token_files.read_documents(spark, folder, 11, 19)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(doc_id,11)" in plan


def test_footers(spark, files):
    folder, rows = files
    groups, names = [], glob.glob(f"{folder}/tokens/*.parquet")
    assert len(names) > 1
    for name in names:
        meta = pq.ParquetFile(name).metadata
        groups.append(meta.num_row_groups)
        for g in range(meta.num_row_groups):
            cols = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c) for c in range(meta.num_columns)}
            assert "DELTA_BINARY_PACKED" in cols["doc_id"].encodings and "DELTA_BINARY_PACKED" in cols["at"].encodings
            assert cols["ids.list.element"].has_dictionary_page or "DELTA_BINARY_PACKED" in cols["ids.list.element"].encodings
            assert all(c.has_offset_index and c.has_column_index for c in cols.values())
    assert max(groups) > 1
    index = token_files.read_index(spark, folder).agg({"n_docs": "sum"}).first()[0]
    assert index == len(rows)


def test_empty_table(spark, tmp_path):
    token_files.write(spark.createDataFrame([], "doc_id int, text string"), str(tmp_path / "t"), WORD)
    assert token_files.checksums(token_files.read(spark, str(tmp_path / "t"))).count() == 0
    assert token_files.read_tokens(spark, str(tmp_path / "t"), 0, 5).count() == 0
