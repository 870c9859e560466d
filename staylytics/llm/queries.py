"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import hashlib
import os
import re

from . import alignment, classifier, decontaminate, filter_audit, language, licenses, line_dedup, mixing, neardup, quality_rules, token_counts, token_files, url_rules
from .common import shared_folder, table

#: Where the vocabulary files of the public tokenizers are.
TOKENIZERS = os.environ.get("STAYLYTICS_TOKENIZERS", "/opt/tokenizers")

QUERIES = {}
ORACLE = {}


def tokenizer(name: str) -> str:
    """The place of a vocabulary file; the public_tokenizers module knows it where it is installed."""
    try:
        from public_tokenizers import path
    except ModuleNotFoundError:
        return os.path.join(TOKENIZERS, name)
    return path(name)


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return deco


@query("op10_decontaminate", r"""
WITH letters AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS u, 'abcdefghijklmnopqrstuvwxyz' AS l),
d AS (SELECT row_number() OVER () AS rid, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), u, l), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM documents, letters),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item_id,
             regexp_extract_all(translate(coalesce(text, ''), u, l), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM benchmark, letters),
bw AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS g
       FROM b, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS t(i) WHERE len(w) >= n),
hits AS (SELECT rid, i, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
places AS (SELECT DISTINCT rid, i + k AS p FROM hits, unnest(range(0, n)) AS t(k)),
hit AS (SELECT rid, count(*) AS n_hit FROM places GROUP BY rid),
ids AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS s
        FROM (SELECT DISTINCT rid, item_id FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN ids USING (rid)
""")
def op10_decontaminate(spark, sf_dir):
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op5_token_counts")
def op5_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


SIGNALS = quality_rules.SIGNALS


@query("op6_quality_rules", rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t,
                  list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
           FROM documents),
windows AS (SELECT rid, i, array_to_string(w[i:i + 7], ' ') AS g FROM d, unnest(range(1, len(w) - 6)) AS t(i) WHERE len(w) >= 8),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM windows) WHERE n > 1),
covered AS (SELECT rid, count(DISTINCT i + k) AS n FROM twice, unnest(range(0, 8)) AS t(k) GROUP BY rid),
c AS (SELECT rid, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines,
             length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(t, '[^!?]', '', 'g')) AS n_marks,
             len(list_filter(w, lambda x, i: x = w[i - 1] AND i > 1)) AS n_echoes
      FROM d LEFT JOIN covered USING (rid)),
s AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
             n_symbols / greatest(n_words, 1) AS symbol_share, n_upper / greatest(word_chars, 1) AS upper_share,
             n_marks / greatest(n_words, 1) AS mark_share, n_dup_lines / greatest(n_lines, 1) AS dup_line_share,
             n_echoes / greatest(n_words, 1) AS echo_share, word_chars / greatest(n_words, 1) AS mean_word FROM c),
g AS (SELECT lang, source, count(*) AS n, {", ".join(f"quantile_disc({x}, 0.25) AS {x}_l, quantile_disc({x}, 0.75) AS {x}_h" for x in SIGNALS)}
      FROM s WHERE NOT base_failed GROUP BY lang, source),
a AS (SELECT lang, {", ".join(f"quantile_disc({x}, 0.25) AS {x}_l, quantile_disc({x}, 0.75) AS {x}_h" for x in SIGNALS)}
      FROM s WHERE NOT base_failed GROUP BY lang),
b AS (SELECT g.lang, g.source, {", ".join(
    f"CASE WHEN n < {quality_rules.MIN_GROUP} THEN a.{x}_{q} ELSE g.{x}_{q} END AS {x}_{q}" for x in SIGNALS for q in "lh")}
      FROM g JOIN a ON g.lang IS NOT DISTINCT FROM a.lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce({" AND ".join(
    f"{x} <= {x}_h + {quality_rules.SPREAD}::DOUBLE * ({x}_h - {x}_l) + {k}::DOUBLE" for x, k in SIGNALS.items())}
           AND mean_word >= mean_word_l - {quality_rules.SPREAD}::DOUBLE * (mean_word_h - mean_word_l) - {SIGNALS["mean_word"]}::DOUBLE, true) AS kept
FROM s LEFT JOIN b ON s.lang IS NOT DISTINCT FROM b.lang AND s.source IS NOT DISTINCT FROM b.source
""")
def op6_quality_rules(spark, sf_dir):
    return quality_rules.judge(table(spark, sf_dir, "documents"))


@query("op7_mixing", r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source,
                  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                  md5('0:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS o FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source IS NULL, source) AS number
      FROM d GROUP BY source),
w AS (SELECT *, [1.0, 2.0, 3.0][(number - 1) % 3 + 1]::DOUBLE AS weight, CAST(3 * source_size AS DOUBLE) AS most FROM s),
f AS (SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) AS budget, sum(weight) OVER () AS weights,
             sum(most) OVER (ORDER BY most / weight, number) AS full_words,
             sum(weight) OVER (ORDER BY most / weight, number) AS full_weight FROM w),
l AS (SELECT *, (budget - (full_words - most)) / (weights - (full_weight - weight)) AS level FROM f),
one AS (SELECT level FROM l WHERE level * weight <= most ORDER BY full_words, number LIMIT 1),
t AS (SELECT source, source_size, number, budget, least(most, one.level * weight) AS target FROM l, one),
p AS (SELECT rid, doc_id, d.source, size, source_size, number, target, budget, o,
             sum(size) OVER (PARTITION BY number ORDER BY o, rid) AS upto
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT rid, size, number, pass, upto, o, budget, CAST(pass * source_size + upto AS DOUBLE) / target AS finish
      FROM p, range(0, 3) AS k(pass) WHERE size > 0),
m AS (SELECT rid, size, budget, sum(size) OVER (ORDER BY finish, number, pass, upto, o) AS mixed FROM e),
x AS (SELECT rid, sum(size) AS taken FROM m WHERE mixed <= budget GROUP BY rid)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken FROM p LEFT JOIN x USING (rid)
""")
def op7_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


@query("op4_language_id")
def op4_language_id(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"))


@query("op9_quality_classifier")
def op9_quality_classifier(spark, sf_dir):
    return classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op2_url_rules")
def op2_url_rules(spark, sf_dir):
    return url_rules.judge(table(spark, sf_dir, "pages"))


def _canonical_line(text: str) -> str:
    """One notice made canonical as the operator does, for the SQL side."""
    t = re.sub("[^0-9a-z\x80-\U0010ffff]+", " ", text.translate(str.maketrans(licenses.UPPER, licenses.LOWER))).strip()
    for a, b in licenses.SPELLINGS:
        t = t.replace(a, b)
    return t


def _alike_sql(text: str) -> str:
    for a, b in licenses.SPELLINGS:
        text = f"replace({text}, '{a}', '{b}')"
    return text


def _licenses_sql() -> str:
    known = {}
    for license_id, text in licenses.notices():
        known.setdefault(hashlib.sha256(_canonical_line(text).encode()).hexdigest(), license_id)
    known = ", ".join(f"('{d}', '{i}')" for d, i in sorted(known.items()))
    texts = ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in licenses.TEXTS)
    strict = ", ".join(f"'{i}'" for i, k in licenses.kinds().items() if k != "permissive")
    clean = (r"regexp_replace(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
             rf"'{licenses.COPYRIGHT}', '\1', 'g'), '{licenses.PUNCTUATION}', ' ', 'g')")
    lines = f"list_filter(list_transform(string_split({_alike_sql(clean)}, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '')"
    whole = "sha256(" + _alike_sql(f"array_to_string(list_filter(lines, lambda x: x <> '{licenses.RESERVED}'), ' ')") + ")"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {lines} AS lines FROM documents),
k AS (SELECT * FROM (VALUES {known}) AS t(digest, license_id)),
w AS (SELECT {whole} AS digest, min(i) AS license_id FROM (SELECT i, {lines} AS lines FROM (VALUES {texts}) AS t(i, text)) GROUP BY 1),
n AS (SELECT rid, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS ids, bool_or(license_id IN ({strict})) AS strict
      FROM (SELECT rid, sha256(unnest(lines)) AS digest FROM d) JOIN k USING (digest) GROUP BY rid)
SELECT doc_id, dg AS digest, w.license_id, coalesce(ids, '') AS notices,
       coalesce(strict, false) OR coalesce(w.license_id IN ({strict}), false) AS restricted
FROM (SELECT *, {whole} AS dg FROM d) LEFT JOIN w ON dg = w.digest LEFT JOIN n USING (rid)
"""


@query("op1_license_scan", _licenses_sql())
def op1_license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op8_line_dedup", r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
l AS (SELECT rid, doc_id, i - 1 AS i, trim(lines[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS x
      FROM d, unnest(range(1, len(lines) + 1)) AS t(i)),
w AS (SELECT rid, doc_id, i, x, count(*) OVER p AS n, lead(i, 1) OVER o AS i2, lead(i, 2) OVER o AS i3, lead(x, 1) OVER o AS x2,
             lead(x, 2) OVER o AS x3, row_number() OVER o AS k
      FROM l WHERE x <> '' WINDOW o AS (PARTITION BY rid ORDER BY i), p AS (PARTITION BY rid)),
v AS (SELECT rid, doc_id, i AS a, coalesce(i3, i2, i) AS b, [x, x2, x3] AS g FROM w WHERE i3 IS NOT NULL OR k = 1
      UNION ALL
      SELECT rid, doc_id, i, i, [x, NULL, NULL] FROM w WHERE n > 1 AND len(regexp_split_to_array(x, '[\x20\x09-\x0D]+')) >= 50),
r AS (SELECT rid, a, b, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, rid, a) AS nth FROM v),
c AS (SELECT rid, list(DISTINCT i) AS gone FROM r, unnest(range(a, b + 1)) AS t(i) WHERE nth > 1 GROUP BY rid),
f AS (SELECT doc_id, lines, gone, CASE WHEN gone IS NULL THEN coalesce(text, '') ELSE coalesce(array_to_string(
             list_filter(lines, lambda x, i: NOT list_contains(gone, i - 1)), chr(10)), '') END AS t
      FROM d LEFT JOIN c USING (rid))
SELECT doc_id, CAST(coalesce(len(lines), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       CAST(length(t) AS BIGINT) AS n_chars_left, sha256(t) AS sha256_left FROM f
""")
def op8_line_dedup(spark, sf_dir):
    return line_dedup.report(table(spark, sf_dir, "documents"))


@query("op3_near_duplicates")
def op3_near_duplicates(spark, sf_dir):
    return neardup.report(table(spark, sf_dir, "documents"))


def _audit_sql() -> str:
    orders = ", ".join(f"('{o}')" for o in filter_audit.ORDERS)
    gone = "contains(fails, letter) AND NOT earlier_fails"
    total = lambda of, value="n": f"CAST(coalesce(sum({value}) FILTER (WHERE {of}), 0) AS BIGINT)"
    return rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (SELECT doc_id, part,
             CASE WHEN len(w) < 100 THEN 'A' ELSE '' END
          || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
          || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END
          || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
          || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails FROM d),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
      FROM labels GROUP BY doc_id),
c AS (SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
      FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails),
s AS (SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS letter, filter_order[:step - 1] AS earlier
      FROM (VALUES {orders}) AS o(filter_order), range(1, 6) AS r(step)),
x AS (SELECT *, translate(fails, earlier, '') <> fails AS earlier_fails FROM c, s)
SELECT part, filter_order, step, {total("NOT contains(fails, letter) AND NOT earlier_fails")} AS kept, {total(gone)} AS removed,
       {total("contains(fails, letter) AND earlier_fails")} AS redundant, {total("fails = letter")} AS unique_fails,
       {total(gone, "good")} AS good_lost, {total(gone, "toxic")} AS toxic_lost,
       CAST(sum(coalesce(sum(n) FILTER (WHERE {gone}), 0)) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM x GROUP BY part, filter_order, step, letter
"""


@query("op11_filter_audit", _audit_sql())
def op11_filter_audit(spark, sf_dir):
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op12_token_files")
def op12_token_files(spark, sf_dir):
    folder = shared_folder(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), folder, tokenizer("word_bpe_49k.json"))
    return token_files.checksums(token_files.read(spark, folder))


@query("op13_token_alignment")
def op13_token_alignment(spark, sf_dir):
    return alignment.report(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))
