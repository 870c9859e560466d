"""Filter audit and its byte transducer against plain Python."""

import random
import re
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest

from staylytics.llm import filter_audit, transducer

LETTERS = [*" \n\tabAB#é漢😀%", "the ", " word", "x" * 70, "x" * 69 + "y", "ü" * 40, "　", "\x00", "\x1f"]


def plain_counts(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    return [len(words), len(set(words)), len(re.findall("[A-Z]", text or "")), len(text or ""), len(re.findall(r"[#$%&*|]", text or ""))]


@pytest.mark.parametrize("piece", [64, 1000, 1 << 18])
def test_transducer(piece, monkeypatch):
    monkeypatch.setattr(transducer, "PIECE", piece)
    r = random.Random(1)
    texts = [None, "", " ", "x", *("".join(r.choice(LETTERS) for _ in range(r.randint(0, 300))) for _ in range(400))]
    texts += [" ".join(r.choice(LETTERS) * r.randint(1, 3) for _ in range(30_000)), None, "y" * 5000]
    got = transducer.Transducer(b"#$%&*|").counts(pa.array(texts, pa.string()))
    assert got.tolist() == [plain_counts(t) for t in texts]
    assert transducer.Transducer(b"#").counts(pa.array([], pa.string())).shape == (0, 5)


def test_colliding_hashes_do_not_merge_words(monkeypatch):
    monkeypatch.setattr(transducer.SpanTable, "_hash", lambda self, start, length, doc: np.zeros(len(start), np.uint64))
    texts = ["a b a c ab " + "z" * 80 + " " + "z" * 80 + " " + "z" * 79 + "y", "a b a c"]
    assert transducer.Transducer(b"#").counts(pa.array(texts))[:, 1].tolist() == [6, 3]


def plain_audit(docs, labels):
    least = {}
    for i, t, *_ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    good, toxic = {i for i, q, _ in labels if q == 1} - {None}, {i for i, _, x in labels if x == 1} - {None}
    fails = []
    for i, t, lang in docs:
        w, d, c, p, s = plain_counts(t)
        f = {x for x, bad in zip("ABCDE", [w < 100, 100 * d < 80 * w, 100 * c > 10 * p, s > 0, i is not None and i > least[t or ""]]) if bad}
        fails.append((lang or "", f, i in good, i in toxic))
    rows = []
    for part in {x[0] for x in fails}:
        mine = [x for x in fails if x[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        some = []
        for order in permutations("ABCDE"):
            left = mine
            for k, f in enumerate(order):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                total[f] += len(gone)
                some.append((part, "".join(order), k + 1, len(left), len(gone), sum(f in x[1] for x in mine) - len(gone),
                             sum(x[1] == {f} for x in mine), sum(x[2] for x in gone), sum(x[3] for x in gone), f))
        rows += [(*x[:-1], total[x[-1]]) for x in some]
    return sorted(rows)


COLS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_audit(spark):
    r = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    text = lambda: " ".join(r.choice(words[:r.choice([100, 300])]) for _ in range(r.choice([20, 99, 100, 130, 150]))) + r.choice(["", "", " #", " A" * 60])
    texts = [text() for _ in range(60)]
    docs = [(r.choice([None, *range(80)]), r.choice([*texts, None, "", texts[0], texts[0]]), r.choice(["en", "fr", None, ""])) for _ in range(300)]
    labels = [(r.choice([None, *range(90)]), r.choice([0, 1, None]), r.choice([0, 1, None])) for _ in range(80)]
    d = spark.createDataFrame([(*x, "a", 1) for x in docs], "doc_id long, text string, lang string, digest string, fails int").repartition(5)
    la = spark.createDataFrame([(*x, "b") for x in labels], "doc_id long, quality int, toxic int, good string")
    got = sorted(tuple(x[c] for c in COLS) for x in filter_audit.audit(d, la).collect())
    assert got == plain_audit(docs, labels)
    assert len(got) == 3 * 600 and any(x[-1] for x in got) and any(x[7] for x in got)
    assert filter_audit.audit(d.limit(0), la).count() == 0
    assert sorted(tuple(x[c] for c in COLS) for x in filter_audit.audit(d, la.limit(0)).collect()) == plain_audit(docs, [])
