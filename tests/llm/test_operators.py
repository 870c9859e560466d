"""Each training-data operator against a plain Python version, and on the rows that break things."""

import hashlib
import math
import random
from collections import Counter

import brute
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylytics.llm import classifier, decontaminate, language, licenses, line_dedup, mixing, neardup, quality_rules, token_counts, url_rules
from staylytics.llm.queries import tokenizer

SF = "/root/testdata/sf0.001"
#: Names that the operators use themselves.
CLASHES = ["text_hash", "n_words", "size", "lang_pred", "score", "hit_words", "spans", "items", "covered", "mix_hash", "taken", "part", "TEXT_IN", "kept"]
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
                    + [T.StructField(c, T.StringType()) for c in CLASHES])


def prose(seed, n, words="the of and to in that is was he for it with as his on be at by had not are but from or have".split()):
    r = random.Random(seed)
    return " ".join(r.choice(words) + (r.choice("abcdefgh") * r.randint(0, 3)) for _ in range(n))


def rows_():
    long = "\n".join(prose(s, 40) for s in range(400))          # 16,000 words
    near = prose(5, 200).split()
    near[100] = "changed"
    frank = "le la les des une est dans pour que qui sur pas plus par avec tout faire son mais comme".split()
    r = [(1, prose(5, 200), "en", "a"), (2, " ".join(near), "en", "a"), (3, prose(5, 200), "en", "b"), (4, prose(6, 150), "en", None),
         (5, None, "en", "a"), (6, "", "fr", "b"), (7, " \n\t ", None, "b"), (8, "12 34 -- !!", "en", "c"), (9, long, "en", "c"),
         (10, prose(7, 120, frank), "fr", "c"), (11, prose(7, 120, frank), "fr", "c"), (11, prose(7, 120, frank), "fr", "c"),
         (None, prose(8, 90), "en", "a"), (None, None, None, None), (12, "x", None, "a"), (13, "Été. Œuvre, ß!", "fr", "d"),
         (14, prose(9, 60) + "\n" + "\n".join(prose(s, 40) for s in (3, 4, 5)) + "\nMIT License", "en", "d"),
         (15, "Licensed under the MIT Licence\n" + prose(10, 40), "en", "a"), (16, "go go go go go go go go go go " * 30, "en", "a")]
    return [(i, t, la, so, len(t or ""), *["x"] * len(CLASHES)) for i, t, la, so in r]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(rows_(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def got(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def expect(rows):
    return sorted(rows, key=repr)


# ---------------------------------------------------------------- 1
def test_licenses(odd, none, spark):
    assert licenses.scan(none).count() == 0
    out = got(licenses.scan(odd), "doc_id", "license_id", "notices", "restricted")
    assert len(out) == len(rows_())
    by = {r[0]: r[1:] for r in out}
    assert by[15] == (None, "MIT", False) and by[1] == (None, "", False) and by[5] == (None, "", False)
    mit = licenses.TEXTS[4][1]
    same = ["Copyright (c) 2020 Jo Doe\n\n" + mit, "// " + mit.upper().replace("\n", "\n// "), mit.replace("sublicense", "sub-license").replace('"', "''")]
    other = [mit + " And more.", mit.replace("without limitation", "with limitation")]
    d = spark.createDataFrame(list(enumerate(same + other)), "doc_id int, text string")
    assert got(licenses.scan(d), "doc_id", "license_id") == [(0, "MIT"), (1, "MIT"), (2, "MIT"), (3, None), (4, None)]
    held = spark.createDataFrame([(0, "a\nLicensed under CC BY-NC 4.0.\nb"), (1, "All rights reserved."), (2, "the MIT License is one")], "doc_id int, text string")
    assert got(licenses.scan(held), "doc_id", "notices", "restricted") == [(0, "CC-BY-NC-4.0", True), (1, "all-rights-reserved", True), (2, "", False)]


def test_license_whole_texts(spark):
    strict = {i for i, k in licenses.kinds().items() if k != "permissive"}
    want = [(k, i, i in strict) for k, (i, _) in enumerate(licenses.TEXTS)]
    d = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(licenses.TEXTS)], "doc_id int, text string")
    assert got(licenses.scan(d), "doc_id", "license_id", "restricted") == expect(want)
    assert {"Apache-2.0", "CC-BY-SA-4.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-3.0", "MPL-2.0"} <= {i for _, i, _ in want}
    gpl = next(t for i, t in licenses.TEXTS if i == "GPL-3.0")
    apache = next(t for i, t in licenses.TEXTS if i == "Apache-2.0").replace("[yyyy] [name of copyright owner]", "2021 Jo Doe")
    d = spark.createDataFrame([(0, "# " + gpl.replace("\n", "\n# ")), (1, gpl.replace("Everyone", "Nobody", 1)), (2, apache)], "doc_id int, text string")
    assert got(licenses.scan(d), "doc_id", "license_id") == [(0, "GPL-3.0"), (1, None), (2, "Apache-2.0")]


def test_license_headers(spark):
    lines = ['// Licensed under the Apache License, Version 2.0 (the "License");', " * it under the terms of the GNU General Public License as published by",
             "# SPDX-License-Identifier: GPL-3.0-or-later", "/* SPDX-License-Identifier: MIT */", "License, v. 2.0. If a copy of the MPL was not distributed with this",
             "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."]
    d = spark.createDataFrame([(k, f"x = 1\n{t}\ny") for k, t in enumerate(lines)], "doc_id int, text string")
    assert got(licenses.scan(d), "doc_id", "notices", "restricted") == [
        (0, "Apache-2.0", False), (1, "GPL", True), (2, "GPL-3.0", True), (3, "MIT", False), (4, "MPL-2.0", True), (5, "CC-BY-NC-4.0", True)]


# ---------------------------------------------------------------- 2
URLS = [None, "", "no scheme", "://", "http://ORG/x", "http://a.org", "http://Ex.Example.ORG/es/1?x=://b/#", "x://a.com/de", "http://q.com/de/?a#b",
        "http://notexample.org/es/", "http://example.org/en/12", "https://e.net/fr/1.html?a=1&b=2", "http://É.com/fr/", "http://a.net/" + "x/" * 3000]


def test_url_rules(spark):
    r = random.Random(3)
    urls = URLS + [f"http://{r.choice(['www.', 'm.', ''])}{r.choice(['ab', 'cd', 'example'])}.{r.choice(['com', 'org', 'net'])}/{r.choice(['en', 'fr', 'de', 'es'])}"
                   f"/{r.randint(1, 99)}{r.choice(['', '.html', '?ref=1'])}" for _ in range(300)] + URLS[4:6]
    schema = "page_id long, url string, host string, path string, given string, set string, tokens string"
    pages = spark.createDataFrame([(None if i == 9 else i, u, *"abcde") for i, u in enumerate(urls)], schema)
    out = {r["page_id"]: r for r in url_rules.judge(pages, min_support=0.05).collect()}
    assert len(out) == len(urls)
    plain = pages.select("page_id", "url", url_rules.tokens(F.col("url")).alias("t")).collect()
    judged = {p["page_id"]: brute.judge_url(p["url"], url_rules.RULES) for p in plain}
    rules = brute.mined_rules([(p["t"], judged[p["page_id"]][3]) for p in plain if judged[p["page_id"]][3] and len(p["t"]) < 20], 0.05, 0.8)
    for p in plain:
        host, path, rule, verdict = judged[p["page_id"]]
        mined = brute.best_rule(p["t"], rules)
        o = out[p["page_id"]]
        assert (o["host"], o["path"], o["rule"]) == (host, path, rule)
        assert o["verdict"] == (verdict or (mined[2] if mined else "allow")), p
    assert any(o["mined_rule"] for o in out.values())
    # of tokens in the same labelled urls each one makes the rule fire
    alike = [(i, f"http://a{i}.com/de/aaa/spam/{i}") for i in range(100)] + [(200, "http://q.net/spam/zz"), (201, "http://q.net/aaa/zz"), (202, "http://q.net/zz")]
    alike = {r["page_id"]: r["verdict"] for r in url_rules.judge(spark.createDataFrame(alike, "page_id int, url string")).collect()}
    assert (alike[200], alike[201], alike[202]) == ("block", "block", "allow")
    assert url_rules.judge(pages.limit(0)).count() == 0
    assert {r["verdict"] for r in url_rules.judge(pages.where("url is null or url = ''")).collect()} == {"allow"}


# ---------------------------------------------------------------- 3
def test_near_duplicates_odd(odd, none):
    assert neardup.report(none).count() == 0 and neardup.keep_one(none).count() == 0
    out = got(neardup.report(odd), "doc_id", "class_id", "class_size")
    assert len(out) == len(rows_())
    by = {}
    for r in out:
        by.setdefault(r[0], []).append(r[1:])
    assert by[1] == by[2] == by[3] == [(1, 3)] and by[10] == [(10, 3)] and by[11] == [(10, 3)] * 2
    assert by[5] == [(5, 1)] and by[9] == [(9, 1)] and by[None] == [(None, 1)] * 2
    kept = neardup.keep_one(odd)
    assert kept.columns == odd.columns
    assert expect(r["doc_id"] for r in kept.collect()) == expect([1, 4, 5, 6, 7, 8, 9, 10, 12, 13, 14, 15, 16, None, None])


def test_near_duplicates_brute(spark):
    r = random.Random(4)
    texts = []
    for g in range(12):  # groups of copies that are edited more and more, so that some links go through others
        base = [f"w{g}x{i}" for i in range(60)]
        for _ in range(12):
            t = list(base)
            for _ in range(r.randint(0, 4)):
                t[r.randrange(60)] = f"e{r.random()}"
            texts.append(" ".join(t))
            if r.random() < 0.4:
                base = t
    texts += ["a b", "a  b", "b a", "a a a a a a a a", "a a a a a a", "p q r s t u"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    want = brute.classes(texts)
    assert got(neardup.report(d), "doc_id", "class_id") == expect(enumerate(want))
    assert 20 < len(set(want)) < len(texts) - 20


# ---------------------------------------------------------------- 4
def test_language(odd, none):
    assert language.identify(none).count() == 0
    out = got(language.identify(odd), "doc_id", "held_out", "lang_pred", "score")
    known = brute.language_profiles([(r[1], r[2]) for r in rows_() if not brute.held_out(r[0])])
    want = [(r[0], brute.held_out(r[0]), *brute.nearest(r[1], known)) for r in rows_()]
    assert [o[:3] for o in out] == [w[:3] for w in expect(want)]
    assert all(abs(o[3] - w[3]) < 1e-12 for o, w in zip(out, expect(want)))
    kept = language.keep_identified(odd)
    assert kept.columns == odd.columns
    assert expect(r["doc_id"] for r in kept.collect()) == expect(
        [r[0] for r, w in zip(rows_(), want) if w[2] != "und" and w[3] >= language.MIN_SCORE])
    nothing = language.identify(odd.withColumn("lang", F.lit(None).cast("string")))
    assert {(r["lang_pred"], r["score"]) for r in nothing.collect()} == {("und", 0.0)}


def test_language_held_out_accuracy(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language.identify(d).join(d, "doc_id").where("held_out")
    assert out.where("lang = lang_pred").count() >= 0.98 * out.count() > 100


# ---------------------------------------------------------------- 5
def test_token_counts(odd, none, spark):
    model = token_counts.load(tokenizer("piece_bpe_32k.model"))
    path = tokenizer("piece_bpe_32k.model")
    assert token_counts.token_counts(none, path).count() == 0
    r = random.Random(6)
    letters = list(" \n\t▁ab<s>é漢　\x00\U0001F600ﬁ0.,") + ["the ", "ing", "<0x0A>", "</s>", "  "]
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 40))) for _ in range(500)] + ["x" * 5000, "é" * 3000, " " * 300]
    d = odd.select("doc_id", "text", "n_words").unionByName(spark.createDataFrame([(100 + i, t, "") for i, t in enumerate(texts)], "doc_id long, text string, n_words string"))
    want = [(i, len((t or "").encode()), n := len(model.encode(t or "")), n > 20) for i, t in [(r[0], r[1]) for r in rows_()] + [(100 + i, t) for i, t in enumerate(texts)]]
    assert got(token_counts.token_counts(d, path, limit=20), "doc_id", "n_bytes", "n_tokens", "over_limit") == expect(want)


def test_token_cache_starts_anew(monkeypatch):
    path = tokenizer("piece_bpe_32k.model")
    monkeypatch.setattr(token_counts, "CACHE_WORDS", 3)
    cache = token_counts.Lengths(path, {"▁the": 1})
    for t in ["the cat sat on the mat", "a dog " * 9, "the " + "long" * 50]:
        assert cache.count(t) == len(token_counts.load(path).encode(t))
        assert len(cache) <= 12


def test_frequent_lengths_of_one_id(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "SAMPLE_DOCS", 10)
    d = spark.createDataFrame([(None, prose(s, 30)) for s in range(40)], "doc_id long, text string")  # one of four is in the sample
    assert 0 < len(token_counts.frequent_lengths(d, tokenizer("piece_bpe_32k.model"))) < len({w for s in range(40) for w in prose(s, 30).split()})


# ---------------------------------------------------------------- 6
def test_quality_rules(odd, none, spark):
    assert quality_rules.judge(none).count() == 0
    out = {(r["doc_id"], r["n_words"]): r for r in quality_rules.judge(odd).collect()}
    assert quality_rules.judge(odd).count() == len(rows_())
    assert not out[1, 200]["base_failed"] and out[1, 200]["kept"] and out[5, 0]["base_failed"] and out[12, 1]["base_failed"]
    assert out[16, 300]["n_repeat_words"] == 300 and not out[16, 300]["kept"]
    d = spark.createDataFrame([(1, "a b c d e f g h x a b c d e f g h i", "l", "s"), (2, "# &x\n # &x \n# &x\n\n\n", None, None), (3, "é ü\x0bñ", "l", None)],
                              "doc_id int, text string, lang string, source string")
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert got(quality_rules.judge(d), *cols) == [(1, 18, 18, 0, 0, 16), (2, 6, 9, 6, 1, 0), (3, 3, 3, 0, 0, 0)]


def test_quality_rules_keep_good(spark):
    sf = "/root/testdata/sf0.01"
    d = quality_rules.judge(spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("not base_failed")
    good, bad = d.where("quality = 1"), d.where("quality = 0")
    assert good.where("kept").count() >= 0.98 * good.count() and bad.where("kept").count() <= 0.2 * bad.count()


# ---------------------------------------------------------------- 7
def test_mixing(odd, none, spark):
    assert mixing.mix(none).count() == 0 and mixing.mixed_documents(none).count() == 0
    plain = [(r[0], r[3], len(brute.split(r[1]))) for r in rows_()]
    target, taken = brute.mix(plain)
    out = got(mixing.mix(odd), "doc_id", "source", "size", "target", "taken")
    want = expect((i, s, n, target[s], t) for (i, s, n), t in zip(plain, taken))
    assert [o[:3] + o[4:] for o in out] == [w[:3] + w[4:] for w in want]
    assert all(abs(o[3] - w[3]) < 1e-6 for o, w in zip(out, want))
    mixed = mixing.mixed_documents(odd)
    assert mixed.columns == [*odd.columns, "_size", "source_size", "target", "_taken"]
    assert mixed.where("_taken <= 0").count() == 0
    assert got(mixing.mix(odd.repartition(7)), "doc_id", "taken") == got(mixing.mix(odd.coalesce(1)), "doc_id", "taken")


def test_mixing_bound(spark):
    d = spark.createDataFrame([(i, "w " * (i % 7 + 1), "big" if i > 20 else f"s{i % 4}") for i in range(2000)], "doc_id int, text string, source string")
    plain = [(i, "big" if i > 20 else f"s{i % 4}", i % 7 + 1) for i in range(2000)]
    target, taken = brute.mix(plain)
    assert got(mixing.mix(d), "doc_id", "taken") == expect((i, t) for (i, _, _), t in zip(plain, taken))
    by = {r["source"]: r for r in mixing.mix(d).groupBy("source", "source_size", "target").agg(F.sum("taken").alias("t")).collect()}
    assert any(r["target"] == 3 * r["source_size"] for r in by.values())
    assert all(abs(r["t"] - r["target"]) <= 14 for r in by.values())


# ---------------------------------------------------------------- 8
def test_line_dedup(odd, none):
    assert line_dedup.report(none).count() == 0
    order = sorted({(r[0] is not None, r[0] or 0, r[1] or "", r[1] is None) for r in rows_()})
    docs = [(i if there else None, None if null else t) for there, i, t, null in order]
    left = dict(zip([(i, t) for i, t in docs], brute.dedup_lines(docs)))
    out = line_dedup.dedup_lines(odd)
    assert out.columns == odd.columns
    assert got(out, "doc_id", "text") == expect((r[0], left[r[0], r[1]]) for r in rows_())
    assert out.where("text is not null and n_chars <> length(text)").count() == 0
    assert got(line_dedup.report(odd), "doc_id", "n_chars_left") == expect((r[0], len(left[r[0], r[1]] or "")) for r in rows_())


def test_line_dedup_brute(spark):
    r = random.Random(8)
    long = prose(77, 60)
    docs = [(i, "\n".join(r.choice(["a", "b", " a ", "", "c", long, "d e"]) for _ in range(r.randint(0, 12)))) for i in range(150)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert got(line_dedup.dedup_lines(d), "doc_id", "text") == expect(zip([i for i, _ in docs], brute.dedup_lines(docs)))


def test_line_dedup_pairs(spark):
    r = random.Random(18)
    a, b = prose(71, 41), prose(72, 43)
    lines = ["a", "b c", "", a, b, prose(73, 24), prose(74, 25), prose(75, 60)]
    docs = [(0, f"x\n{a}\n{b}\ny"), (1, f"p\n {a}\n\n{b}\nq"), (2, f"{a}\n{b}"), (3, f"z\n{a}\nz")]
    docs += [(i, "\n".join(r.choice(lines) for _ in range(r.randint(0, 12)))) for i in range(4, 150)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    out = {x["doc_id"]: x["text"] for x in line_dedup.dedup_lines(d, pairs=True).collect()}
    assert [out[i] for i in range(4)] == [docs[0][1], "p\nq", "", docs[3][1]]
    assert out == dict(zip([i for i, _ in docs], brute.dedup_lines_pairs(docs)))


# ---------------------------------------------------------------- 9
def test_classifier(odd, none, spark):
    labels = spark.createDataFrame([(1, 1), (4, 1), (16, 0), (None, 1), (3, None), (10, 1), (10, 1), (8, 0)], "doc_id long, quality int")
    assert classifier.classify(none, labels).count() == 0
    out = classifier.classify(odd, labels).collect()
    assert len(out) == len(rows_()) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in out)
    again = classifier.classify(odd.repartition(5), labels).collect()
    assert expect((r["doc_id"], round(r["score"], 9)) for r in out) == expect((r["doc_id"], round(r["score"], 9)) for r in again)
    assert {r["score"] for r in classifier.classify(odd, labels.limit(0)).collect() if r["doc_id"] in (5, 6, 7)} == {0.5}
    model = classifier.train(odd, labels)
    diff, bias = model.weights()
    texts = {x[0]: x[1] for x in rows_()}
    for r in out:  # the score is softmax of the average vector
        text = texts[r["doc_id"]]
        z = bias
        for _, _, _, bucket in classifier.features(pa.array([text], pa.string())):
            z += diff[bucket].mean() if len(bucket) else 0
        if r["doc_id"] is not None:
            assert abs(r["score"] - 1 / (1 + math.exp(-z))) < 1e-9


def test_classifier_features():
    texts = ["go go é a\U0001F600 abcd", "", "x", "a bc\u3000d go go go", "  ", "go"]
    for i, j, of, bucket in classifier.features(pa.array(texts)):
        for d, t in enumerate(texts[i:j]):
            w = brute.split(t)
            assert (of == d).sum() == len(w) + max(0, len(w) - 1) + sum(a == b for a, b in zip(w, w[1:])) + len(brute.char_grams(t))
        # equal words and n-grams share a bucket wherever they stand
        alone = lambda t: sorted(next(classifier.features(pa.array([t])))[3].tolist())
        words = brute.split(texts[0])
        pairs = sum((Counter(alone(f"{a} {b}")) - Counter(alone(a) + alone(b)) for a, b in zip(words, words[1:])), Counter())
        assert Counter(bucket[of == 0].tolist()) == Counter(sum((alone(w) for w in words), [])) + pairs
        assert pairs.total() == 5 and len(pairs) == 5 and pairs[classifier.ECHO] == 1


def test_classifier_fit_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(classifier, "fit", lambda ids, counts, labels, seed=1: len(labels))
    docs = spark.range(20_000).select(F.lit(4).alias("doc_id"), F.concat(F.lit("some text "), F.col("id").cast("string")).alias("text"))
    labels = spark.createDataFrame([(4, 1), (4, 1), (4, 0)], "doc_id long, quality int")
    assert not brute.held_out(4) and classifier.train(docs, labels) == 2  # an id and its two labels


def test_classifier_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = classifier.classify(spark.read.parquet(f"{sf}/documents.parquet"), labels).join(labels, "doc_id").where("held_out")
    assert out.where("quality = predicted").count() >= 0.93 * out.count() > 50


# ---------------------------------------------------------------- 10
ITEMS = [(1, prose(9, 20)), (2, "Œuvre ß"), (3, ""), (None, prose(6, 150)), (5, None), (6, "The CHANGED"), (1, prose(8, 13)), (10, prose(3, 40))]


@pytest.mark.parametrize("block", [1 << 20, 25])
def test_decontaminate(odd, none, spark, block, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    monkeypatch.setattr(decontaminate, "MAX_BLOCK_WORDS", block)
    cols = ["n_words", "spans", "items"]
    src = odd.select("doc_id", "text")
    got_ = decontaminate.find_hits(src, items, keep=["doc_id"], max_block_words=block)
    out = got(got_.select("doc_id", "n_words", decontaminate.n_hit(F.col("spans")).alias("n"), F.size("items").alias("k"),
                          F.sha2(F.array_join("items", ","), 256).alias("s")), "doc_id", "n_words", "n", "k", "s")
    assert out == expect((r[0], *brute.judge_benchmark(r[1], ITEMS)[:4]) for r in rows_()) and cols
    assert decontaminate.report(none, items).count() == 0
    assert {(r["n_hit"], r["items_sha256"]) for r in decontaminate.report(odd, items.limit(0)).collect()} == {(0, hashlib.sha256(b"").hexdigest())}


def test_decontaminate_modes(odd, spark):
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    kept = decontaminate.drop_contaminated(odd, items)
    assert kept.columns == odd.columns
    assert expect(r["doc_id"] for r in kept.collect()) == expect(r[0] for r in rows_() if not brute.judge_benchmark(r[1], ITEMS)[4])
    cut = decontaminate.remove_spans(odd.drop("spans"), items)
    assert cut.count() == len(rows_())
    texts = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert texts[5] is None and texts[10] == dict((r[0], r[1]) for r in rows_())[10] and len(brute.split(texts[4])) == 0
    assert brute.judge_benchmark(texts[14], ITEMS)[1] == 0
