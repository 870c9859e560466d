"""Plain Python versions of the operators, for small fixtures."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WHITE = " \t\n\x0b\x0c\r"


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


# ---------------------------------------------------------------- operator 2
def judge_url(url, rules):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, None))
    return host, path, best[1], best[2]


def mined_rules(labelled, min_support, min_confidence):
    """labelled: (tokens, verdict) -> {frozenset: (verdict, confidence, support)}, by looking at every subset."""
    n = len(labelled)
    where = defaultdict(list)
    for i, (tokens, _) in enumerate(labelled):
        for t in tokens:
            where[t].append(i)
    known = {t for t, rows in where.items() if len(rows) >= min_support * n}
    count, by = Counter(), Counter()
    for tokens, verdict in labelled:
        items = sorted(set(tokens) & known)
        for mask in range(1, 1 << len(items)):
            s = frozenset(x for k, x in enumerate(items) if mask >> k & 1)
            count[s] += 1
            by[s, verdict] += 1
    least = math.ceil(min_support * n)
    rules = {(s, v): (k / count[s], k / n) for (s, v), k in by.items() if k >= least and k / count[s] >= min_confidence}
    return {(s, v): x for (s, v), x in rules.items()
            if not any((s - {t}, v) in rules and rules[s - {t}, v][0] >= x[0] for t in s)}


def best_rule(tokens, rules):
    hits = [(c, n, v, " ".join(sorted(s))) for (s, v), (c, n) in rules.items() if s <= set(tokens)]
    return max(hits, default=None)


# ---------------------------------------------------------------- operator 3
def weighted_shingles(text):
    w = split(text)
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else ([tuple(w)] if w else [])
    return {g: 1 + math.log(n) for g, n in Counter(grams).items()}


def probability_jaccard(x, y):
    every = set(x) | set(y)
    return sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in every) for i in set(x) & set(y))


def classes(texts, similarity=0.8):
    """Least index of the class of each text."""
    s = [weighted_shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(len(s)):
        for j in range(i):
            if s[i] and len(set(s[i]) & set(s[j])) * 2 > min(len(s[i]), len(s[j])) and probability_jaccard(s[i], s[j]) >= similarity - 1e-12:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(s))]


# ---------------------------------------------------------------- operator 4
def ngrams(text):
    out = Counter()
    for w in "".join(c if c.isalpha() else " " for c in (text or "").lower()).split():
        p = f" {w} "
        for n in (1, 2, 3):
            out.update(g for i in range(len(p) - n + 1) if (g := p[i:i + n]) != " ")
    return out


def gram_code(g):
    a = [1 if c == " " else ord(c) for c in g] + [0, 0]
    return a[0] << 42 | a[1] << 21 | a[2]


def profile(counts, size=300):
    return [gram_code(g) for g, n in sorted(counts.items(), key=lambda x: (-x[1], gram_code(x[0])))[:size]]


def language_profiles(rows):
    total = defaultdict(Counter)
    for text, lang in rows:
        if text is not None and lang is not None:
            total[lang].update(ngrams(text))
    return {x: profile(c) for x, c in total.items() if c}


def nearest(text, known, size=300):
    mine = profile(ngrams(text))
    if not mine or not known:
        return "und", 0.0
    best = None
    for lang in sorted(known):
        rank = {c: i for i, c in enumerate(known[lang])}
        d = sum(abs(rank[c] - i) if c in rank else size for i, c in enumerate(mine))
        if best is None or d < best[0]:
            best = (d, lang)
    return best[1], 1 - best[0] / (size * len(mine))


# ---------------------------------------------------------------- operator 8
def dedup_lines(rows):
    """(doc_id, text) in order -> texts without later occurrences of repeated windows."""
    seen, out = set(), []
    for _, text in rows:
        if text is None:
            out.append(None)
            continue
        lines = text.split("\n")
        at = [(i, x.strip(WHITE)) for i, x in enumerate(lines) if x.strip(WHITE)]
        found = []
        if at:
            for k in range(max(1, len(at) - 2)):
                w = at[k:k + 3]
                found.append((w[0][0], w[-1][0], tuple(x for _, x in w)))
            if len(at) > 1:
                found += [(i, i, (x,)) for i, x in at if len(split(x)) >= 50]
        gone = set()
        for a, b, key in sorted(found):
            if key in seen:
                gone |= set(range(a, b + 1))
            seen.add(key)
        out.append("\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else text)
    return out


def dedup_lines_pairs(rows):
    """As dedup_lines, with a window for two lines in a row that have 50 words or more."""
    seen, out = set(), []
    for _, text in rows:
        lines = (text or "").split("\n")
        at = [(i, x.strip(WHITE)) for i, x in enumerate(lines) if x.strip(WHITE)]
        spans = [at[k:k + 3] for k in range(max(1, len(at) - 2))] if at else []
        spans += [[x] for x in at if len(at) > 1 and len(split(x[1])) >= 50]
        spans += [list(p) for p in zip(at, at[1:]) if len(at) > 2 and len(split(p[0][1])) + len(split(p[1][1])) >= 50]
        gone = set()
        for a, b, key in sorted((s[0][0], s[-1][0], tuple(x for _, x in s)) for s in spans):
            if key in seen:
                gone |= set(range(a, b + 1))
            seen.add(key)
        out.append(text if not gone else "\n".join(x for i, x in enumerate(lines) if i not in gone))
    return out


# ---------------------------------------------------------------- operator 10
def judge_benchmark(text, items):
    """(words, hit words, item ids, digest, contaminated)."""
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
    w = words(text)
    hit, ids = set(), set()
    for item_id, t in items:
        x = words(t)
        n = min(13, len(x))
        grams = {tuple(x[i:i + n]) for i in range(len(x) - n + 1)} if n else set()
        for i in range(len(w) - n + 1 if n else 0):
            if tuple(w[i:i + n]) in grams:
                hit |= set(range(i, i + n))
                ids.add("null" if item_id is None else str(item_id))
    digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
    return len(w), len(hit), len(ids), digest, bool(hit) and 20 * len(hit) >= len(w)


# ---------------------------------------------------------------- operator 7
def mix(rows, weights=(1.0, 2.0, 3.0), passes=3):
    """(doc_id, source, size) -> (targets by source, words taken of each row)."""
    size = Counter()
    for _, s, n in rows:
        size[s] += n
    order = sorted(size, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = float(sum(size.values())), set()
    while True:  # share by weight, stop at the bound, share the excess again
        rest = total - sum(passes * size[s] for s in full)
        weight = sum(w[s] for s in order if s not in full)
        over = {s for s in order if s not in full and rest * w[s] / weight > passes * size[s]} if weight else set()
        if not over:
            break
        full |= over
    target = {s: float(passes * size[s]) if s in full else rest * w[s] / weight for s in order}
    entries, upto = [], Counter()
    number = {s: i for i, s in enumerate(order)}
    key = [hashlib.md5(f"0:{'null' if d is None else d}".encode()).hexdigest() for d, _, _ in rows]
    for i in sorted(range(len(rows)), key=lambda i: (number[rows[i][1]], key[i])):
        _, s, n = rows[i]
        upto[s] += n
        entries += [((k * size[s] + upto[s]) / target[s], number[s], k, upto[s], key[i], i) for k in range(passes) if n]
    taken, used = [0] * len(rows), 0
    for *_, i in sorted(entries):
        if used + rows[i][2] > total:
            break
        used += rows[i][2]
        taken[i] += rows[i][2]
    return target, taken


# ---------------------------------------------------------------- operator 9
def char_grams(text):
    """The character n-grams of a text's words, with marks at the words' ends."""
    out = []
    for w in split(text):
        p = f"<{w}>"
        out += [p[i:i + n] for n in (3, 4) for i in range(len(p) - n + 1)]
    return out
