"""Quality rules with adaptive thresholds (operator 6), by built-in functions only.

Base counts of a text come from array functions. The adaptive part
draws a mergeable quantile sketch (KLL) of each signal for each
language and source, over the documents that pass the base rules, and
merges the sketches of a language for groups that are too small. A
signal's bounds are the quartiles widened by ``SPREAD`` times the
distance between them plus a slack; a join brings them back to the
documents. Sketches merge on the map side, so a hot source costs one
sketch for each task.

Defined cases: a null text has no words and fails the base rules; null
languages and sources are groups of their own; rows are judged one by
one, equal ids included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylytics.session import cut_lineage

from .common import words_array

SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"
WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
#: Quartile distances beyond the quartiles that are still usual.
SPREAD = 3.0
#: Documents of a language and source below which the sketch of the language is used.
MIN_GROUP = 50
#: Size of a sketch: exact up to as many values, then within about 0.1 % in rank.
SKETCH_K = 2048
#: Signal -> what its bounds are widened by in any case. The upper bound counts, for mean_word the lower one too.
SIGNALS = {"symbol_share": 0.05, "upper_share": 0.25, "mark_share": 0.10, "dup_line_share": 0.50, "echo_share": 0.10,
           "mean_word": 1.5}
TWO_SIDED = ("mean_word",)


def _without(text: Column, letters: str) -> Column:
    return F.translate(text, letters, "")


def base_counts(docs: DataFrame, text_col: str, keep: list[Column]) -> DataFrame:
    """``keep`` and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and the signals."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    names = [f"k{i}" for i in range(len(keep))]
    kept = [F.col(n) for n in names]
    d = docs.select(*[c.alias(n) for c, n in zip(keep, names)], text.alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(_without(x, WHITE)) > 0)
    d = d.select(*kept, F.length(_without(F.col("text"), WHITE)).alias("word_chars"),
                 (F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).alias("n_symbols"),
                 (F.length("text") - F.length(_without(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))).alias("n_upper"),
                 (F.length("text") - F.length(_without(F.col("text"), "!?"))).alias("n_marks"),
                 lines.alias("lines"), words_array(F.col("text")).alias("words"))
    d = d.select(*kept, "word_chars", "n_symbols", "n_upper", "n_marks", F.size("lines").alias("n_lines"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
                 F.size("words").alias("n_words"), F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    # one hash for each window of eight words
    windows = F.when(F.col("n_words") >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.col("n_words") - WINDOW),
        lambda i: F.xxhash64(*[F.get("hashes", i + k) for k in range(WINDOW)])))
    counts = ["word_chars", "n_symbols", "n_upper", "n_marks", "n_lines", "n_dup_lines", "n_words"]
    echoes = F.size(F.filter("hashes", lambda h, i: F.coalesce(F.get("hashes", i - 1) == h, F.lit(False))))  # words equal to the one before
    counts.append("n_echoes")
    d = d.select(*kept, *counts[:-1], echoes.alias("n_echoes"), windows.alias("windows"))
    # only a text with a repeated window sorts its windows; equal ones are then neighbours
    d = d.select(*kept, *counts, F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array(
        F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("order"))
    same = lambda x, i: F.coalesce(F.get("order", i)["h"] == x["h"], F.lit(False))
    d = d.select(*kept, *counts, F.sort_array(F.transform(
        F.filter("order", lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["i"])).alias("at"))
    covered = F.aggregate(F.transform("at", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(
        F.get("at", i + 1) - p, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x)
    d = d.select(*kept, *counts, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return d.select(*kept, F.col("n_words").cast("long").alias("n_words"), F.col("word_chars").cast("long").alias("word_chars"),
                    F.col("n_symbols").cast("long").alias("n_symbols"), F.col("n_dup_lines").cast("long").alias("n_dup_lines"),
                    "n_repeat_words", failed.alias("base_failed"),
                    share("n_symbols", "n_words").alias("symbol_share"), share("n_upper", "word_chars").alias("upper_share"),
                    share("n_marks", "n_words").alias("mark_share"), share("n_dup_lines", "n_lines").alias("dup_line_share"),
                    share("n_echoes", "n_words").alias("echo_share"), share("word_chars", "n_words").alias("mean_word"))


def bounds(counts: DataFrame, lang: str, source: str) -> DataFrame:
    """For each language and source: the usual range (low, high) of every signal."""
    sketch = lambda c: F.expr(f"kll_sketch_agg_double({c}, {SKETCH_K})")
    group = counts.where(~F.col("base_failed")).groupBy(lang, source).agg(
        F.count(F.lit(1)).alias("n"), *[sketch(s).alias(f"{s}_sketch") for s in SIGNALS])
    whole = group.groupBy(F.col(lang).alias("of")).agg(
        *[F.expr(f"kll_merge_agg_double({s}_sketch, {SKETCH_K})").alias(f"{s}_whole") for s in SIGNALS])
    both = group.join(whole, F.col(lang).eqNullSafe(F.col("of")))
    at = lambda s, q: F.expr(
        f"kll_sketch_get_quantile_double(if(n < {MIN_GROUP}, {s}_whole, {s}_sketch), {q}D)")
    low = {s: at(s, 0.25) for s in SIGNALS}
    high = {s: at(s, 0.75) for s in SIGNALS}
    cols = [(high[s] + SPREAD * (high[s] - low[s]) + slack).alias(f"{s}_high") for s, slack in SIGNALS.items()]
    cols += [(low[s] - SPREAD * (high[s] - low[s]) - SIGNALS[s]).alias(f"{s}_low") for s in TWO_SIDED]
    return both.select(F.col(lang).alias("b_lang"), F.col(source).alias("b_source"), *cols)


def judge(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source") -> DataFrame:
    """doc_id, the base counts, base_failed and kept (false too where a signal is out of its group's bounds)."""
    counts = base_counts(docs, text_col, [F.col(id_col), F.col(lang_col), F.col(source_col)])
    # a few numbers for each document: written once, read for the sketches and for the verdict
    counts = cut_lineage(counts.withColumnsRenamed({"k0": "doc_id", "k1": "lang", "k2": "source"}))
    limits = bounds(counts, "lang", "source")
    usual = F.lit(True)
    for s in SIGNALS:
        usual = usual & (F.col(s) <= F.col(f"{s}_high"))
    for s in TWO_SIDED:
        usual = usual & (F.col(s) >= F.col(f"{s}_low"))
    # a group without bounds has no document that passes the base rules
    joined = counts.join(limits, F.col("lang").eqNullSafe(F.col("b_lang")) & F.col("source").eqNullSafe(F.col("b_source")), "left")
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & F.coalesce(usual, F.lit(True))).alias("kept"))
