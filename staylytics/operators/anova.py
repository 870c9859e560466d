"""One-way ANOVA, Kruskal-Wallis, Tukey HSD and eta squared.

All of them run on sufficient statistics: one groupBy gives n, mean and
the within-group sum of squares per group (Welford-merged by Spark, so
partial aggregation keeps hot groups cheap). Kruskal-Wallis ranks come
from ``quantiles.value_ranks`` (prefix sums over distinct values), never
from a window over the whole table. Only scalars go to the driver for
the F and studentised-range tails.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dist
from .describe import PRICE, top_k_by_count
from ..session import cut_lineage, ship_package
from .quantiles import value_ranks


def anova_input(dl: DataFrame, group: str, top_k: int | None = None) -> DataFrame:
    """(g, y): y = ln(price + 1) for prices in 1..2000; optionally the top_k largest groups.

    A row without a group belongs to none and takes no part.
    """
    d = dl.filter(F.col(PRICE).between(1, 2000) & F.col(group).isNotNull()).select(
        F.col(group).alias("g"), F.log(F.col(PRICE) + 1).alias("y"))
    if top_k:
        d = d.join(F.broadcast(top_k_by_count(d, "g", top_k)), "g", "left_semi")
    return d


def group_stats(d: DataFrame) -> DataFrame:
    """Per group: n, mean, within sum of squares (n * population variance)."""
    return d.groupBy("g").agg(
        F.count("y").alias("n"), F.avg("y").alias("mean"),
        (F.var_pop("y") * F.count("y")).alias("ss_within"))


def anova_table(d: DataFrame) -> DataFrame:
    """One row with k, N, SSB, SSW, F and eta squared."""
    return _table(group_stats(d), d.agg(F.avg("y")).scalar())


def _table(gs: DataFrame, gm) -> DataFrame:
    t = gs.agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"),
        F.sum(F.col("n") * (F.col("mean") - gm) * (F.col("mean") - gm)).alias("ssb"),
        F.sum("ss_within").alias("ssw"))
    return t.select(
        "k", "n", "ssb", "ssw",
        (F.col("k") - 1).alias("df_between"), (F.col("n") - F.col("k")).alias("df_within"),
        F.try_divide(F.col("ssb") / (F.col("k") - 1), F.col("ssw") / (F.col("n") - F.col("k"))).alias("f_stat"),
        F.try_divide(F.col("ssb"), F.col("ssb") + F.col("ssw")).alias("eta_sq"))


def kruskal(d: DataFrame) -> DataFrame:
    """Tie-corrected Kruskal-Wallis H in one row (h, h_uncorrected, tie_correction, n, k)."""
    gv = cut_lineage(d.where(F.col("y").isNotNull()).groupBy("g", F.col("y").cast("double").alias("value")).agg(F.count(F.lit(1)).alias("c")))
    ranks = cut_lineage(value_ranks(d, "y", counts=gv.groupBy("value").agg(F.sum("c").alias("cnt"))))
    mean_rank = F.col("cum_before") + (F.col("cnt") + 1) / 2.0
    per_group = gv.join(ranks, "value").groupBy("g").agg(
        F.sum("c").alias("ng"), F.sum(F.col("c") * mean_rank).alias("rsum"))
    n = ranks.agg(F.sum("cnt")).scalar()
    ties = ranks.agg(F.sum(F.pow(F.col("cnt").cast("double"), 3) - F.col("cnt"))).scalar()
    h0 = per_group.agg(
        (F.lit(12.0) / (n * (n + 1.0)) * F.sum(F.col("rsum") * F.col("rsum") / F.col("ng"))
         - 3.0 * (n + 1.0)).alias("h_uncorrected"),
        F.count(F.lit(1)).alias("k"))
    corr = F.lit(1.0) - ties / (F.pow(n.cast("double"), 3) - n)
    return h0.select(F.try_divide(F.col("h_uncorrected"), corr).alias("h"), "h_uncorrected",
                     corr.alias("tie_correction"), n.alias("n"), "k")


def tukey_pairs(d: DataFrame) -> DataFrame:
    """T4 (SQL part): every pair of groups g1 < g2 with mean difference, SE and q.

    Joins the k-row group summary with itself: k(k-1)/2 pairs of groups,
    which are the result, never pairs of rows.
    """
    gs = cut_lineage(group_stats(d))
    return _pairs(gs, *_fit(gs))


def _fit(gs: DataFrame) -> tuple[int, float, float]:
    """(k, df within, mean square within) from the group summary."""
    t = gs.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum("ss_within").alias("ssw")).first()
    dfw = (t["n"] or 0) - t["k"]
    return t["k"], float(dfw), t["ssw"] / dfw if dfw > 0 else float("nan")


def _pairs(gs: DataFrame, k: int, dfw: float, mse: float) -> DataFrame:
    a, b = gs.alias("a"), gs.alias("b")
    p = a.join(b, F.col("a.g") < F.col("b.g"))
    se = F.sqrt(F.lit(mse) / 2.0 * (1.0 / F.col("a.n") + 1.0 / F.col("b.n")))
    diff = F.col("b.mean") - F.col("a.mean")
    return p.select(F.col("a.g").alias("group1"), F.col("b.g").alias("group2"),
                    diff.alias("meandiff"), se.alias("se"), (F.abs(diff) / se).alias("q_stat"))


def tukey_hsd(d: DataFrame, alpha: float = 0.05) -> DataFrame:
    """T4: full Tukey-Kramer table with adjusted p, confidence interval and reject flag.

    The tails of the pairs (groups, not data) are computed in tasks.
    """
    gs = cut_lineage(group_stats(d))
    k, dfw, mse = _fit(gs)
    crit = dist.studentized_range_ppf(1 - alpha, k, dfw) if dfw > 0 and k > 1 else float("nan")

    def tails(batches):
        for pdf in batches:
            yield pdf.assign(p_adj=[dist.studentized_range_sf(q, k, dfw) for q in pdf["q_stat"]])[
                ["group1", "group2", "meandiff", "se", "p_adj"]]

    ship_package(d.sparkSession)
    t = _pairs(gs, k, dfw, mse).mapInPandas(tails, "group1 string, group2 string, meandiff double, se double, p_adj double")
    return t.select("group1", "group2", "meandiff", "p_adj", (F.col("meandiff") - F.lit(crit) * F.col("se")).alias("lower"),
                    (F.col("meandiff") + F.lit(crit) * F.col("se")).alias("upper"), (F.col("p_adj") < alpha).alias("reject"))


def anova_tests(d: DataFrame, factor: str) -> DataFrame:
    """T1 + T3 with p-values: factor, F, p, H."""
    t = anova_table(d).first()
    h = kruskal(d).first()
    p = dist.f_sf(t["f_stat"], t["df_between"], t["df_within"]) if t["f_stat"] is not None else None
    return d.sparkSession.createDataFrame(
        [(factor, t["f_stat"], p, h["h"], int(t["k"]), int(t["n"]))],
        "factor string, f_stat double, p_value double, h_kruskal double, k int, n bigint")


def tukey_significant(d: DataFrame, alpha: float = 0.05) -> DataFrame:
    """T5: significant pairs out of all pairs. A pair is significant if its q exceeds the critical value, so no tail is computed."""
    gs = cut_lineage(group_stats(d))
    k, dfw, mse = _fit(gs)
    crit = dist.studentized_range_ppf(1 - alpha, k, dfw) if dfw > 0 and k > 1 else None
    significant = F.col("q_stat") > F.lit(crit).cast("double")
    return _pairs(gs, k, dfw, mse).agg(F.count_if(significant).alias("sig_pairs"), F.count(F.lit(1)).alias("total_pairs"))
