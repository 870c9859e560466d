"""Exact ranks and quantiles, whole or by group, by radix selection.

Rows are first counted by (group, value), summed map-side, so a value
held by a third of all rows is one row here. A value is known by a 64-bit code
whose order is that of the values (``code``), and a rank is found digit by digit:
the counts of the first 22 bits of the codes of a group, put in order and added up, tell
in which of them each wanted rank lies; only values with such a prefix are
counted by the next 21 bits, and then by the last 21. That is three
passes over the counted values whatever their number, and nothing that is put in order
in one task has more than 2^22 rows. All joins are equi-joins, no
value is compared with a list of cuts, and the plan has no driver
round trip: the counts are shuffled once and that shuffle is read again by each pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bits of a code behind its first prefix and behind its second one.
AFTER_FIRST, AFTER_SECOND = 42, 21


def code(x: Column) -> Column:
    """A long for a double: exponent and mantissa as they are stored, negative for values below zero.

    -0.0 and 0.0 have one code; NULL and NaN have none.
    """
    a = F.abs(x)
    near = F.floor(F.log2(a))  # off by one at most
    e = near + (a >= F.pow(F.lit(2.0), near + 1)).cast("long") - (a < F.pow(F.lit(2.0), near)).cast("long")
    e = F.least(F.greatest(e, F.lit(-1022)), F.lit(1023))
    normal = (e + 1023) * F.lit(1 << 52) + ((a / F.pow(F.lit(2.0), e) - 1) * F.lit(float(1 << 52))).cast("long")
    size = (F.when(a == 0, F.lit(0)).when(a < F.lit(2.0 ** -1022), (a * F.lit(2.0 ** 537) * F.lit(2.0 ** 537)).cast("long"))
            .when(a == F.lit(float("inf")), F.lit(2047 << 52)).otherwise(normal))
    return F.when(~F.isnan(x), F.when(x < 0, -size).otherwise(size))


def _same(a: str, b: str, keys: list[str]) -> Column:
    """Groups are equal; NULL is a group too."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return cond


def _counted(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    """(keys, value, cnt) of the values that are numbers; without keys all rows are one group, ``whole``."""
    d = df.select(*([F.col(k) for k in keys] or [F.lit(0).alias("whole")]), F.col(col).cast("double").alias("value"))
    d = d.where(F.col("value").isNotNull() & ~F.isnan("value"))
    return d.groupBy(*(keys or ["whole"]), "value").agg(F.count(F.lit(1)).alias("cnt"))


def _less(parts: list, order: str) -> Column:
    """Rows with a smaller ``order`` within the parts."""
    w = Window.partitionBy(*parts).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("cnt").over(w), F.lit(0))


def value_ranks(df: DataFrame, col: str, counts: DataFrame | None = None) -> DataFrame:
    """(value, cnt, cum_before): rows with that value, and rows with a smaller one.

    ``counts`` may give (value, cnt) where these are known already.
    """
    c = (_counted(df, [], col) if counts is None else counts).select("value", "cnt", code(F.col("value")).alias("c"))
    c = c.select("value", "cnt", "c", F.shiftright("c", AFTER_SECOND).alias("b"))
    second = c.groupBy("b").agg(F.sum("cnt").alias("cnt")).withColumn("a", F.shiftright("b", AFTER_FIRST - AFTER_SECOND))
    first = second.groupBy("a").agg(F.sum("cnt").alias("cnt")).select("a", _less([], "a").alias("less_a"))
    second = second.select("a", "b", _less(["a"], "b").alias("less_b")).join(first, "a").select("b", (F.col("less_a") + F.col("less_b")).alias("less"))
    ranked = c.select("value", "cnt", "b", _less(["b"], "c").alias("less_c"))
    return ranked.join(second, "b").select("value", "cnt", (F.col("less") + F.col("less_c")).alias("cum_before"))


def group_quantiles(df: DataFrame, keys: list[str], col: str, probs: dict[str, float], linear: bool = False) -> DataFrame:
    """One row per group of ``keys`` (one in all without keys) and one column per name of ``probs``.

    The quantile p of n values is the least one with at least p * n values
    up to it (``percentile_disc``); ``linear`` interpolates at (n - 1) * p.
    A group without values has no row.
    """
    by = keys or ["whole"]
    counts = _counted(df, keys, col).withColumn("c", code(F.col("value")))
    at = {n: (F.col("n") - 1) * F.lit(float(p)) if linear else F.greatest(F.ceil(F.col("n") * F.lit(float(p))) - 1, F.lit(0)).cast("double")
          for n, p in probs.items()}
    ranks = F.array(*[F.struct(F.lit(i).alias("i"), fn(h).cast("long").alias("rank")) for i, (h, fn) in enumerate(
        (h, fn) for h in at.values() for fn in (F.floor, F.ceil))])
    # ranks that lie in a row's range, counted from its beginning
    mine = F.transform(F.filter("want", lambda x: (x["rank"] >= F.col("less")) & (x["rank"] < F.col("less") + F.col("cnt"))),
                       lambda x: F.struct(x["i"].alias("i"), (x["rank"] - F.col("less")).alias("rank")))

    first = counts.groupBy(*by, F.shiftright("c", AFTER_FIRST).alias("prefix")).agg(F.sum("cnt").alias("cnt"))
    first = first.select(*by, "prefix", "cnt", _less(by, "prefix").alias("less"), F.sum("cnt").over(Window.partitionBy(*by)).alias("n"))
    held = first.withColumn("want", ranks).select(*by, "prefix", "n", mine.alias("want")).where(F.size("want") > 0)
    for before, after in ((AFTER_FIRST, AFTER_SECOND), (AFTER_SECOND, 0)):
        c, h = counts.alias("c"), held.alias("h")
        inside = c.join(h, _same("c", "h", by) & (F.shiftright("c.c", before) == F.col("h.prefix")))
        inside = inside.select(*[F.col(f"c.{k}") for k in by], "h.prefix", F.shiftright("c.c", after).alias("next"), "c.cnt", "c.value", "h.n", "h.want")
        if after:  # behind the last prefix each value is a row already
            inside = inside.groupBy(*by, "prefix", "next").agg(F.sum("cnt").alias("cnt"), F.min("value").alias("value"), F.min("n").alias("n"), F.first("want").alias("want"))
        inside = inside.select(*by, F.col("next").alias("prefix"), "cnt", "value", "n", "want", _less([*by, "prefix"], "next").alias("less"))
        held = inside.select(*by, "prefix", "value", "n", mine.alias("want")).where(F.size("want") > 0)

    found = held.select(*by, "n", "value", F.explode("want.i").alias("i"))
    value = lambda i: F.max(F.when(F.col("i") == i, F.col("value")))
    wide = found.groupBy(*by).agg(F.max("n").alias("n"), *[value(i).alias(f"_{i}") for i in range(2 * len(probs))])
    low, high = (lambda k: F.col(f"_{2 * k}")), (lambda k: F.col(f"_{2 * k + 1}"))
    between = lambda k, h: F.when(low(k) == high(k), low(k)).otherwise(low(k) + (high(k) - low(k)) * (h - F.floor(h)))
    return wide.select(*keys, *[between(k, h).alias(name) for k, (name, h) in enumerate(at.items())])


def exact_quantiles(df: DataFrame, col: str, probs: list[float]) -> DataFrame:
    """Linear-interpolated quantiles (numpy 'linear'): rows (prob, value)."""
    names = {f"q{i}": p for i, p in enumerate(probs)}
    wide = group_quantiles(df, [], col, names, linear=True)
    return wide.select(F.inline(F.array(*[F.struct(F.lit(float(p)).alias("prob"), F.col(n).alias("value")) for n, p in names.items()])))


def quantile_row(df: DataFrame, col: str, probs: list[float], names: list[str]) -> DataFrame:
    """One row, one column per probability."""
    return group_quantiles(df, [], col, dict(zip(names, probs)), linear=True)


def exact_quantiles_multi(df: DataFrame, cols: list[str], probs: list[float]) -> DataFrame:
    """Linear-interpolated quantiles of several columns at once: rows (column, prob, value)."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])).alias("s")).select("s.*")
    names = {f"q{i}": p for i, p in enumerate(probs)}
    wide = group_quantiles(long, ["column"], "value", names, linear=True)
    return wide.select("column", F.inline(F.array(*[F.struct(F.lit(float(p)).alias("prob"), F.col(n).alias("value")) for n, p in names.items()])))
