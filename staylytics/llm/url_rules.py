"""URL filter by mined association rules (operator 2).

Given rules (host and path prefix, allow or block) decide the urls that
they fit. These urls are the labels: each becomes the set of its
tokens (host labels, path segments, file ending, query keys) and its
verdict, Spark's FP-growth finds the frequent combinations, and those
whose verdict has enough confidence and support become rules, unless a
part of the combination says the same with as much confidence. The other urls are matched
through an inverted index from token to rules; the rule of highest
confidence, then support, decides. Where none matches the verdict is
DEFAULT.

Sizes: a token is frequent if at least MIN_SUPPORT of the labelled urls
have it, so there are at most (mean tokens of a url) / MIN_SUPPORT; they
and the rules are the only things that reach the driver or every task.
Tokens that occur in exactly the same urls count as one, so a long
fixed path does not multiply the combinations. Rules are matched
against the distinct sets of indexed tokens, not against each url.

Defined cases: a null url, or one without ``://``, has an empty host and
path, no rule and no tokens; urls of equal text get equal verdicts; with
no labelled url nothing is mined.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylytics.session import cut_lineage

#: The given rules: verdict, host, start of the path.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
MIN_SUPPORT, MIN_CONFIDENCE = 0.01, 0.8
DEFAULT = "allow"
#: Matched token sets that are sent to all tasks at most (some 100 bytes each).
MAX_SENT = 50_000

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)


def given_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct (length, rule, verdict), or null."""
    fits = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p), F.struct(
        F.lit(len(h + p)).alias("length"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for v, h, p in rules]
    return F.array_max(F.array_compact(F.array(*fits)))


def tokens(url: Column) -> Column:
    """The distinct tokens of a url. Numbers count as one token; a file ending is a token of its own."""
    part = lambda text, cut, mark: F.transform(
        F.filter(F.split(text, cut), lambda x: x != ""), lambda x: F.concat(F.lit(mark), x))
    path = F.regexp_replace(path_of(url), r"\d+", "0")
    query = F.regexp_replace(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 3), "=[^&]*", "")
    ending = F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)
    path = F.regexp_replace(path, r"\.[A-Za-z0-9]+$", "")
    return F.array_distinct(F.concat(part(host_of(url), r"\.", "host:"), part(path, "/", "path:"), part(ending, "/", "end:"),
                                     part(query, "&", "key:")))


def _frequent(labelled: DataFrame, least: float) -> dict[str, str]:
    """Tokens in ``least`` or more labelled urls, each with the least one of those that occur in the same urls."""
    each = labelled.select(F.xxhash64("url").alias("u"), F.explode("tokens").alias("token"))
    # the sum of the urls' hashes tells tokens of different urls apart
    count = each.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("u").cast("decimal(38,0)")).alias("s"))
    rows = count.where(F.col("n") >= least).groupBy("n", "s").agg(F.collect_list("token").alias("tokens")).collect()
    return {t: min(r["tokens"]) for r in rows for t in r["tokens"]}


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> tuple[DataFrame | None, dict[str, str]]:
    """Rules (rule_id, parts, verdict, confidence, support) from rows with ``url``, ``tokens`` and ``verdict``, and the alike tokens.

    Tokens that occur in the same labelled urls make the same rules, so
    one of them is mined; each of them stands for it when rules are matched.
    """
    n = labelled.count()
    alike = _frequent(labelled, min_support * n) if n else {}
    known = sorted(set(alike.values()))
    if not known:
        return None, {}
    items = F.concat(F.array_intersect("tokens", F.array(*map(F.lit, known))), F.array(F.concat(F.lit("="), F.col("verdict"))))
    sets = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=1.0).fit(labelled.select(items.alias("items"))).freqItemsets
    sets = cut_lineage(sets)
    verdict = F.filter("items", lambda x: x.startswith("="))
    parts = F.array_sort(F.filter("items", lambda x: ~x.startswith("=")))
    split = sets.select(parts.alias("parts"), F.get(verdict, 0).alias("verdict"), "freq").where(F.size("parts") > 0)
    whole = split.where("verdict is null").select("parts", F.col("freq").alias("of"))
    rules = split.where("verdict is not null").join(whole, "parts").select(
        "parts", F.substring("verdict", 2, 20).alias("verdict"), (F.col("freq") / F.col("of")).alias("confidence"),
        (F.col("freq") / F.lit(n)).alias("support")).where(F.col("confidence") >= min_confidence)
    # a rule adds nothing if leaving out one of its tokens gives the verdict with as much confidence (and more support)
    smaller = rules.where(F.size("parts") > 1).select("parts", "verdict", F.col("confidence").alias("mine"), F.explode("parts").alias("x"))
    smaller = smaller.select(F.col("parts").alias("longer"), "verdict", "mine", F.array_remove("parts", F.col("x")).alias("parts"))
    idle = smaller.join(rules.select("parts", "verdict", "confidence"), ["parts", "verdict"]).where(
        F.col("confidence") >= F.col("mine")).select(F.col("longer").alias("parts"), "verdict").distinct()
    left = rules.join(idle, ["parts", "verdict"], "left_anti")
    return cut_lineage(left.select(F.array_join("parts", " ").alias("rule_id"), "parts", "verdict", "confidence", "support")), alike


def match(sets: DataFrame, rules: DataFrame, alike: dict[str, str]) -> DataFrame:
    """The verdict of the best rule whose tokens, or tokens alike, are all in the set: columns ``set`` and ``mined``."""
    index = rules.select("rule_id", "verdict", "confidence", "support", F.size("parts").alias("n"), F.explode("parts").alias("part"))
    same = sets.sparkSession.createDataFrame(sorted(alike.items()), "token string, part string")
    index = index.join(same, "part")
    hits = sets.select("set", F.explode("set").alias("token")).join(index, "token")
    full = hits.groupBy("set", "rule_id", "n", "verdict", "confidence", "support").agg(F.size(F.collect_set("part")).alias("found")).where("found = n")
    best = F.max(F.struct("confidence", "support", "verdict", "rule_id"))
    return full.groupBy("set").agg(best.alias("best")).select("set", F.col("best.verdict").alias("mined"), F.col("best.rule_id").alias("mined_rule"))


def judge(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", rules=RULES, min_support: float = MIN_SUPPORT,
          min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """page_id, host, path, rule, verdict and mined_rule of every row."""
    url = F.col(url_col)
    p = pages.select(F.col(id_col).alias("page_id"), url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"),
                     tokens(url).alias("tokens"))
    p = p.withColumn("given", given_rule(F.col("host"), F.col("path"), rules))
    mined, alike = mine(p.where("given is not null").select("url", "tokens", F.col("given.verdict").alias("verdict")), min_support, min_confidence)
    out = ["page_id", "host", "path", F.col("given.rule").alias("rule")]
    parts = set() if mined is None else {t for r in mined.select("parts").collect() for t in r["parts"]}
    used = sorted(t for t, part in alike.items() if part in parts)  # frequent tokens
    if not used:
        return p.select(*out, F.coalesce("given.verdict", F.lit(DEFAULT)).alias("verdict"), F.lit(None).cast("string").alias("mined_rule"))
    p = p.withColumn("set", F.when(F.col("given").isNull(), F.array_sort(F.array_intersect("tokens", F.array(*map(F.lit, used))))))
    p = p.drop("tokens", "url")
    got = cut_lineage(match(p.where("set is not null").select("set").distinct(), mined, alike))
    if got.count() <= MAX_SENT:  # else a plain join, whose hot sets Spark splits
        got = F.broadcast(got)
    return p.join(got, "set", "left").select(*out, F.coalesce("given.verdict", "mined", F.lit(DEFAULT)).alias("verdict"), "mined_rule")
