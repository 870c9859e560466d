"""Inferential queries T1-T6 (registry + oracle)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import anova as A
from ..oracle import oracle
from ..registry import Ctx, query

P = "avg_price_next_30_days"


def _input_sql(group: str, top_k: int | None) -> str:
    s = f", d0 AS (SELECT {group} AS g, ln({P} + 1) AS y FROM dim_listings WHERE {P} BETWEEN 1 AND 2000 AND {group} IS NOT NULL)"
    if top_k:
        s += (f", top AS (SELECT g FROM d0 GROUP BY g ORDER BY count(*) DESC, g ASC NULLS LAST LIMIT {top_k})"
              ", d AS (SELECT * FROM d0 WHERE g IN (SELECT g FROM top))")
    else:
        s += ", d AS (SELECT * FROM d0)"
    return s + """,
gs AS (SELECT g, count(y) AS n, avg(y) AS mean, var_pop(y) * count(y) AS ss_within FROM d GROUP BY g),
gm AS (SELECT avg(y) AS gm FROM d),
t AS (SELECT count(*) AS k, CAST(sum(n) AS BIGINT) AS n, sum(n * (mean - gm) * (mean - gm)) AS ssb,
             sum(ss_within) AS ssw FROM gs, gm GROUP BY gm)
"""


ANOVA_COLS = ["ssb", "ssw", "f_stat", "eta_sq"]
ANOVA_SELECT = """SELECT k, n, ssb, ssw, k - 1 AS df_between, n - k AS df_within,
       (ssb / (k - 1)) / (ssw / (n - k)) AS f_stat, ssb / (ssb + ssw) AS eta_sq FROM t"""

KRUSKAL_SELECT = """,
rk AS (SELECT g, y, rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0e0 AS rnk FROM d),
nn AS (SELECT count(*) AS n FROM d),
rs AS (SELECT g, sum(rnk) AS rsum, count(*) AS ng FROM rk GROUP BY g),
ti AS (SELECT sum(CAST(c AS DOUBLE) * c * c - c) AS tt FROM (SELECT count(*) AS c FROM d GROUP BY y) z),
h0 AS (SELECT 12.0e0 / (n * (n + 1.0e0)) * sum(rsum * rsum / ng) - 3.0e0 * (n + 1.0e0) AS h_uncorrected,
              count(*) AS k FROM rs, nn GROUP BY n)
SELECT h_uncorrected / (1.0e0 - tt / (CAST(n AS DOUBLE) * n * n - n)) AS h, h_uncorrected,
       1.0e0 - tt / (CAST(n AS DOUBLE) * n * n - n) AS tie_correction, n, k FROM h0, ti, nn"""

TUKEY_SELECT = """
SELECT a.g AS group1, b.g AS group2, b.mean - a.mean AS meandiff,
       sqrt(m.mse / 2.0e0 * (1.0e0 / a.n + 1.0e0 / b.n)) AS se,
       abs(b.mean - a.mean) / sqrt(m.mse / 2.0e0 * (1.0e0 / a.n + 1.0e0 / b.n)) AS q_stat
FROM gs a JOIN gs b ON a.g < b.g, (SELECT ssw / (n - k) AS mse FROM t) m"""

FACTORS = {"room_type": ("room_type", None), "neighbourhood": ("neighbourhood", 20)}


def _d(c: Ctx, factor: str):
    group, k = FACTORS[factor]
    return A.anova_input(c["dim_listings"], group, k)


for _f in FACTORS:
    def _mk(f):
        @query(f"anova_{f}")
        def q_anova(c: Ctx):
            """F statistic and sums of squares."""
            return A.anova_table(_d(c, f))

        @query(f"kruskal_{f}")
        def q_kruskal(c: Ctx):
            """Tie-corrected Kruskal-Wallis H."""
            return A.kruskal(_d(c, f))

        @query(f"tukey_{f}")
        def q_tukey(c: Ctx):
            """T4: pairwise mean differences, SE and studentised range statistic."""
            return A.tukey_pairs(_d(c, f))

        group, k = FACTORS[f]
        oracle(f"anova_{f}", _input_sql(group, k) + ANOVA_SELECT, ANOVA_COLS)
        oracle(f"kruskal_{f}", _input_sql(group, k) + KRUSKAL_SELECT, ["h", "h_uncorrected", "tie_correction"])
        oracle(f"tukey_{f}", _input_sql(group, k) + TUKEY_SELECT, ["meandiff", "se", "q_stat"])
    _mk(_f)


@query("eta_squared")
def q_eta_squared(c: Ctx):
    """Share of variance explained by each factor."""
    a = A.anova_table(_d(c, "room_type")).select(F.lit("room_type").alias("factor"), "eta_sq")
    b = A.anova_table(_d(c, "neighbourhood")).select(F.lit("neighbourhood").alias("factor"), "eta_sq")
    return a.unionByName(b)


oracle("eta_squared", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT * FROM (WITH {_input_sql(g, k)[1:]} SELECT '{f}' AS factor, ssb / (ssb + ssw) AS eta_sq FROM t)"
    for f, (g, k) in FACTORS.items()) + ") e", ["eta_sq"])


@query("anova_tests")
def q_anova_tests(c: Ctx):
    """T1-T3 with p-values (F tail on the driver from the F statistic)."""
    return A.anova_tests(_d(c, "room_type"), "room_type").unionByName(
        A.anova_tests(_d(c, "neighbourhood"), "neighbourhood"))


@query("tukey_hsd_room_type")
def q_tukey_hsd_room_type(c: Ctx):
    """T4 with adjusted p-values, intervals and reject flags."""
    return A.tukey_hsd(_d(c, "room_type"))


@query("tukey_significant_pairs")
def q_tukey_significant_pairs(c: Ctx):
    """T5 for the top-20 neighbourhoods."""
    return A.tukey_significant(_d(c, "neighbourhood"))
