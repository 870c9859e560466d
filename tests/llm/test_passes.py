"""How often the operators of the corpus pipeline go through the texts, and their counts against plain ones."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from staylytics.llm import language, line_dedup, mixing, neardup


@pytest.fixture
def counted(spark):
    """Documents, and an accumulator of how many of their texts have been read."""
    r = random.Random(3)
    line = lambda: " ".join(r.choice(["one", "two", "three", "four"]) + str(r.randint(0, 99)) for _ in range(30))
    same = "\n".join(line() for _ in range(4))
    rows = [(i, "\n".join([*(line() for _ in range(5)), same if i % 3 else line()]), f"s{i % 3}") for i in range(40)]
    n = spark.sparkContext.accumulator(0)

    def read(text):
        n.add(1)
        return text

    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return docs.withColumn("text", F.udf(read, "string").asNondeterministic()("text")), n


def test_line_windows_read_texts_once(counted):
    docs, n = counted
    assert line_dedup.covered(docs, pairs=True).count() == 25  # of the 26 with the passage, all but the first
    assert n.value == 40


def test_mix_reads_texts_once(counted):
    docs, n = counted
    assert mixing.positions(mixing.plan(docs)).agg(F.sum("size")).first()[0] == sum(180 if i % 3 == 0 else 270 for i in range(40))
    assert n.value == 40


def test_line_windows_of_any_kind_meet(spark):
    """A line or two by themselves are the same window as in a longer text."""
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, f"{long}\nother line"), (2, f" \n{long}\t"), (3, f"a b\n{long}\nc d\ne"), (4, f"a b\r\n\n {long}"), (5, f"x\n\ny\n{long} z"), (6, None), (7, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = {r["doc_id"]: r["covered"] for r in line_dedup.covered(docs, pairs=True).collect()}
    assert got == {2: [1], 3: [1], 4: [0, 1, 2]}
    left = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs, pairs=True).collect()}
    assert left == dict(rows) | {2: " ", 3: "a b\nc d\ne", 4: ""}


def plain_grams(texts):
    out = Counter()
    for t in texts:
        for w in "".join(c if c.isalpha() else " " for c in t.lower()).split():
            w = f" {w} "
            out.update(w[1:-1])
            out.update(w[i:i + 2] for i in range(len(w) - 1))
            out.update(w[i:i + 3] for i in range(len(w) - 2))
    return out


@pytest.mark.parametrize("many", [False, True])
def test_grams_plain(many):
    r = random.Random(5)
    letters = "".join(chr(i) for i in range(0x4e00, 0x8e00)) if many else "abcéßİпри中\U00010400 \n1.-"
    texts = ["", "12", *("".join(r.choice(letters + "  ") for _ in range(r.choice([1, 2, 9, 4000 if many else 90]))) for _ in range(30))]
    group = np.sort(np.array([r.randint(0, 4) for _ in texts]))
    g, codes, counts = language.grams(texts, group)
    assert (np.lexsort((codes, g)) == np.arange(len(g))).all()
    text = lambda c: "".join(" " if x == 1 else chr(x) for x in (c >> 42, c >> 21 & 0x1fffff, c & 0x1fffff) if x)
    want = [plain_grams([t for t, k in zip(texts, group) if k == j]) for j in range(5)]
    for j in range(5):
        assert {text(c): n for c, n in zip(codes[g == j].tolist(), counts[g == j].tolist())} == want[j]
    top = language.ranked(g, codes, counts, 4)
    assert [x.tolist() for x in top] == [list(x) for x in zip(*((j, c, k) for j in range(5) for k, (_, c) in enumerate(
        sorted((-n, c) for c, n in zip(codes[g == j].tolist(), counts[g == j].tolist()))[:4])))]


def test_word_counts_plain():
    r = random.Random(9)
    texts = [None, "", " ", *("".join(r.choice("ab é\t\n\x0b\x0c\r\x00中") for _ in range(r.randint(0, 12))) for _ in range(500))]
    got = mixing.n_words(pa.array(texts, pa.string()).slice(1))[0].to_pylist()
    assert got == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts[1:]]


def test_keep_one_of_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(2, text), (2, text), (None, text), (3, text + " x"), (4, None), (4, None), (5, ""), (None, "alone"), (None, None), (6, "other words"), (2, "again")]
    got = neardup.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(2, text), (4, None), (5, ""), (None, "alone"), (None, None), (6, "other words"), (2, "again")], key=repr)
