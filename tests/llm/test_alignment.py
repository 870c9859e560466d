"""Alignment of two tokenizers against a plain version over whole texts."""

import hashlib
import random
from collections import Counter

import pytest

from staylytics.llm import alignment, pieces
from staylytics.llm.queries import tokenizer

A, B = tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")
LETTERS = [*" \n\t\r\x1c\x85\xa0abS'9.ß#é漢　 ́\x00\U0001F600ﬁ", "the ", "don't ", "<|endoftext|>", "<s>", "</s>", "<0x0A>", "  ", "ing", "\n\n", " \n ", "123", "…", "x" * 30]
COLS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def odd_texts():
    r = random.Random(4)
    plain = [x for x in LETTERS if x not in ("\t", "\r", "\x1c", "\x85", "\xa0", "\u3000")]
    texts = ["".join(r.choice(plain if k % 3 else LETTERS) for _ in range(r.randint(0, 50))) for k in range(500)]
    return texts + [None, "", " ", "\n", " lead", "trail ", "a▁b", "▁", "word and word " * 300, "x" * 500, "\n\n  a\n b", "The cat\tsat", "Œuvre naïve fût élève. " * 20]


def whole_ids():
    """Functions: text to ids and entry bytes, by the libraries and on whole texts."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    # the byte-level alphabet, from the bytes of one-byte texts
    letter = {}
    for x in range(256):
        try:
            t = bytes([x]).decode()
        except UnicodeDecodeError:
            continue
        letter[a.id_to_token(a.encode(t).ids[0])] = x
    for x in range(128, 256):
        t = chr(x).encode()
        s = "".join(a.id_to_token(i) for i in a.encode(chr(x)).ids)
        letter |= dict(zip(s, t))
    for x in range(0x100, 0x10FFFF, 41):
        if not 0xD800 <= x < 0xE000:
            letter |= dict(zip("".join(a.id_to_token(i) for i in a.encode(chr(x)).ids), chr(x).encode()))
    bytes_a = lambda i: bytes(letter[c] for c in a.id_to_token(i))
    bytes_b = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    return (lambda t: [(i, bytes_a(i)) for i in a.encode(" " + t, add_special_tokens=False).ids]), (lambda t: [(i, bytes_b(i)) for i in b.encode(t)])


def plain_report(docs):
    of_a, of_b = whole_ids()
    rows, links = [], []
    for i, t in docs:
        a, b = (of_a(t), of_b(t)) if t else ([], [])
        if any(b"".join(x for _, x in s) != (" " + (t or "")).encode() for s in (a, b)):
            rows.append((i, 0, 0, 0, 0, ""))
            links.append([])
            continue
        spans = []
        for s in (a, b):
            at, mine = 0, []
            for k, x in s:
                mine.append((at, at + len(x), k))
                at += len(x)
            spans.append(mine)
        common = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups = ["|".join(",".join(str(k) for x, e, k in s if lo < e <= hi) for s in spans) for lo, hi in zip([0, *common], common)]
        links.append([(ka, kb) for xa, ea, ka in spans[0] for xb, eb, kb in spans[1] if max(xa, xb) < min(ea, eb)])
        rows.append((i, len(a), len(b), len(groups), len(links[-1]), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    count = Counter(x for own in links for x in own)
    most = {}
    for (_, kb), n in count.items():
        most[kb] = max(n, most.get(kb, 0))
    return [(*r[:5], sum(count[x] == most[x[1]] for x in own), sum(count[x] for x in own), r[5]) for r, own in zip(rows, links)]


def test_runs_and_groups():
    r = random.Random(5)
    for _ in range(300):
        n = r.randint(1, 80)
        shared = set(r.sample(range(1, n), r.randint(0, n - 1))) | {n}
        a, b = (sorted(shared | set(r.sample(range(1, n), r.randint(0, (n - 1) // 4)))) for _ in range(2))
        groups, la, lb = alignment.align(a, b)
        ends = sorted(set(a) & set(b))
        got = [e for a0, a1, _, b1 in groups for e in (a[a0:a1] if not b1 else [a[a1 - 1]])]
        assert got == ends
        want = [(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if max([0, *a][i], [0, *b][j]) < min(x, y)]
        assert list(zip(la, lb)) == want


@pytest.mark.parametrize("head", [alignment.HEAD, 40, 0])
def test_report(spark, head, monkeypatch):
    texts = odd_texts()
    docs = [(i if i % 40 else None, t) for i, t in enumerate(texts)] + [(9, "the same text")] * 3
    d = spark.createDataFrame([(*x, 1, "x") for x in docs], "doc_id long, text string, row int, pair_a string").repartition(4)
    got = sorted((tuple(x[c] for c in COLS) for x in alignment.report(d, A, B, head=head).collect()), key=repr)
    assert got == sorted(plain_report(docs), key=repr)
    assert sum(x[1] > 0 for x in got) > 250 and any(x[1] == 0 and x[0] is not None for x in got)


def test_stretches_and_small_tables(monkeypatch):
    monkeypatch.setattr(alignment, "STRETCH", 9)
    monkeypatch.setattr(pieces, "KEPT_PIECES", 4)
    texts = odd_texts()
    pair = alignment.Pair(A, B)
    assert pair.cuts
    want = plain_report(list(enumerate(texts)))
    for t, w in zip(texts, want):
        x = alignment.align_text(pair, t)
        assert x[:5] == (*w[1:5], w[7])


def of_pieces(pair, texts):
    parts = list(map(pair.pieces, texts))
    known = pair.kept.fill(list(filter(None, parts)))
    return [alignment.align_text(pair, t, p, known) for t, p in zip(texts, parts)]


def test_a_piece_is_aligned_once(monkeypatch):
    r = random.Random(6)
    words = ["".join(r.choice("abcdefgilmnorstuéß9") for _ in range(r.randint(1, 9))) for _ in range(60)]
    texts = [" ".join(r.sample(words, 60)) for _ in range(20)]
    monkeypatch.setattr(pieces, "_KEPT", {})
    pair, align, given = alignment.Pair(A, B), alignment.align, []
    monkeypatch.setattr(alignment, "align", lambda a, b: given.append(len(a)) or align(a, b))
    got = [x[:5] for part in (texts[:10], texts[10:]) for x in of_pieces(pair, part)]
    assert got == [(*w[1:5], w[7]) for w in plain_report(list(enumerate(texts)))]
    assert sum(given) < 2 * got[0][0]  # words come without change in texts of the same words


def test_long_pieces_are_not_kept(monkeypatch):
    monkeypatch.setattr(pieces, "_KEPT", {})
    monkeypatch.setattr(pieces, "KEPT_LONG", 300)
    r = random.Random(7)
    texts = ["the word " + "".join(r.choice("漢字ßab") for _ in range(100)) + " and\n" for _ in range(40)]
    pair = alignment.Pair(A, B)
    got = [x[:5] for k in range(0, 40, 2) for x in of_pieces(pair, texts[k:k + 2])]
    assert got == [(*w[1:5], w[7]) for w in plain_report(list(enumerate(texts)))]
    assert sum(len(p) for p in [*pair.kept.new, *pair.kept.old]) < 1000


def test_nothing(spark):
    assert alignment.report(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0
    some = alignment.report(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"), A, B).collect()
    assert sorted(tuple(x) for x in some) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
