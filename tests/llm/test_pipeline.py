"""The corpus pipeline against plain Python versions of its stages, and without the parts it is made of."""

import random

import brute
import corpus_pipeline
import pytest

from staylytics.llm import language

WORDS = {"en": "the of and to in that is was he for it with as his on be at by had not".split(),
         "fr": "le la les des une est dans pour que qui sur pas plus par avec tout faire".split()}


def documents():
    r = random.Random(11)
    text = lambda lang, n: " ".join(r.choice(WORDS[lang]) + r.choice(["", "a", "bo", "cu", "di", "e"]) for _ in range(n))
    lines = lambda lang, k: "\n".join(text(lang, r.randint(8, 20)) for _ in range(k))
    items = [(i, text("en", 30)) for i in range(4)]
    shared = lines("en", 4)
    docs = []
    for i in range(60):
        lang = "fr" if i % 4 == 0 else "en"
        docs.append([i, lines(lang, r.randint(4, 12)), lang, f"s{i % 5}" if i % 7 else None])
    for k, i in enumerate((3, 9, 14)):          # a passage that is repeated
        docs[i][1] += "\n" + shared + "\n" + lines("en", 1)
    for k, i in enumerate((20, 21, 33)):        # benchmark items
        docs[i][1] = docs[i][1].split("\n")[0] + "\n" + items[k][1]
    for i, j in ((40, 5), (41, 5), (42, 6)):    # near copies
        w = docs[j][1].split(" ")
        w[len(w) // 2] = "zz"
        docs[i][1] = " ".join(w)
    docs[50][1], docs[51][1], docs[52][1], docs[53][1] = None, "", "123 --", docs[7][1]  # 53: an exact copy
    docs[54][1] = "привет как дела друзья мои " * 5
    return [tuple(d) + (len(d[1] or ""), "extra") for d in docs], items


def plain(docs, items):
    known = brute.language_profiles([(d[1], d[2]) for d in docs if not brute.held_out(d[0])])
    found = [brute.nearest(d[1], known) for d in docs]
    docs = [d for d, (lang, score) in zip(docs, found) if lang != "und" and score >= language.MIN_SCORE]
    docs = sorted(docs, key=lambda d: d[0])
    docs = [(d[0], t, *d[2:4], d[4] if t == d[1] else len(t), d[5]) for d, t in zip(docs, brute.dedup_lines([(d[0], d[1]) for d in docs])) if brute.split(t)]
    docs = [d for i, (d, c) in enumerate(zip(docs, brute.classes([d[1] for d in docs]))) if i == c]
    docs = [d for d in docs if not brute.judge_benchmark(d[1], items)[4]]
    target, taken = brute.mix([(d[0], d[3], len(brute.split(d[1]))) for d in docs])
    return [(*d, len(brute.split(d[1])), t) for d, t in zip(docs, taken) if t]


def test_pipeline_brute(spark, tmp_path):
    docs, items = documents()
    sf = str(tmp_path)
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, size string").repartition(3).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(items, "item_id int, text string").write.parquet(f"{sf}/benchmark.parquet")
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "size", "_size", "source_size", "target", "taken"]
    got = sorted(tuple(r[c] for c in ["doc_id", "text", "lang", "source", "n_chars", "size", "_size", "taken"]) for r in out.collect())
    want = sorted(plain(docs, items))
    assert got == want
    assert 30 < len(want) < 56 and not {r[0] for r in want} & {20, 21, 33, 50, 51, 52, 53, 54}


@pytest.mark.parametrize("k", range(5))
def test_stages_on_empty_tables(spark, tmp_path, k):
    sf = str(tmp_path)
    spark.createDataFrame([], "item_id int, text string").write.parquet(f"{sf}/benchmark.parquet")
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, taken int")
    name, stage = corpus_pipeline.STAGES[k]
    out = stage(spark, none, sf)
    assert out.count() == 0 and out.columns[:6] == none.columns and (k == 4 or len(out.columns) == 6)


def test_stages_keep_clean_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    first = corpus_pipeline.identify_language(spark, docs, sf)
    assert first.count() == docs.count() and first.columns == docs.columns
