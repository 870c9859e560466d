"""Mixed-effects queries T7-T11: iterative fits over the whole tables.

The fits are unit-tested against a dense numpy REML (tests/test_mixed.py);
the criterion they minimise has a SQL oracle on a fixed grid.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from ..functions.columns import round_half_away
from ..operators import describe as E
from ..operators import mixed as MX
from ..oracle import oracle
from ..registry import Ctx, query

# test-data parameter: the room type standing in for 'Entire home/apt' (c_mktsegment values)
TEST_ENTIRE_HOME = "BUILDING"

FE_SCHEMA = "term string, estimate double, std_error double, z_value double, p_value double"


def _a(c: Ctx) -> MX.MixedFit:
    return c.once("lmm_a", lambda: MX.model_intercept(c["dim_listings"]))


def _b(c: Ctx) -> MX.MixedFit:
    return c.once("lmm_b", lambda: MX.model_slope(c["dim_listings"], TEST_ENTIRE_HOME))


def _c(c: Ctx) -> MX.MixedFit:
    return c.once("lmm_c", lambda: MX.model_weekend(c["fct_availability"]))


def _fe_frame(c: Ctx, fit: MX.MixedFit, re_name: str):
    rows = fit.fixed_effects() + [(re_name, float(fit.group_var), None, None, None),
                                  ("Scale", float(fit.scale), None, None, None)]
    return c.spark.createDataFrame(rows, FE_SCHEMA)


@query("lmm_intercept")
def q_lmm_intercept(c: Ctx):
    """Fixed effects and variance components of the random-intercept model."""
    return _fe_frame(c, _a(c), "Group Var")


@query("lmm_fit_stats")
def q_lmm_fit_stats(c: Ctx):
    """Sizes, variance ratio, REML -2 log L and the ML-refit AIC of each model."""
    rows = []
    for name, fit in (("A_intercept", _a(c)), ("B_slope", _b(c)), ("C_weekend", _c(c))):
        rows.append((name, int(fit.n_obs), int(fit.n_groups), float(fit.theta), float(fit.group_var),
                     float(fit.scale), float(fit.reml_neg2_loglik), float(fit.ml_aic)))
    return c.spark.createDataFrame(rows, "model string, n_obs bigint, n_groups bigint, theta double, "
                                         "group_var double, scale double, reml_neg2_loglik double, ml_aic double")


@query("neighbourhood_premium")
def q_neighbourhood_premium(c: Ctx):
    """T8 + J8: random intercept per neighbourhood, premium % = expm1(u) * 100, with centroid."""
    return _premiums(c).join(E.centroids(c["dim_listings"]), "neighbourhood")


def _premiums(c: Ctx):
    u = _a(c).blups.select(F.col("g").alias("neighbourhood"), F.col("u").alias("random_intercept"))
    return u.select("*", round_half_away(F.expm1("random_intercept") * 100, 1).alias("premium_pct"))


@query("premium_extremes")
def q_premium_extremes(c: Ctx):
    """The five highest and the five lowest neighbourhood premiums."""
    p = _premiums(c)
    top = p.orderBy(F.desc("random_intercept"), "neighbourhood").limit(5).withColumn("end", F.lit("top"))
    return top.unionByName(p.orderBy("random_intercept", "neighbourhood").limit(5).withColumn("end", F.lit("bottom")))


@query("lmm_residuals")
def q_lmm_residuals(c: Ctx):
    """Response, fitted value and conditional residual of every row of model A."""
    return _a(c).fitted()


GRID = (0.0, 0.01, 0.1, 0.5, 1.0, 10.0)


@query("lmm_null_criterion")
def q_lmm_null_criterion(c: Ctx):
    """T7's criterion on a fixed grid of variance ratios, for the model without predictors."""
    des = MX.build_design(MX.listing_model_frame(c["dim_listings"]), "log_price", "neighbourhood", [])
    ymean = float(des.frame.agg(F.avg("y")).first()[0])
    sums = MX._theta_sums(MX.group_sums(des, np.zeros(1), ymean), list(GRID), 1)
    rows = [(v["theta"], float(v["reml"]), float(v["ml"])) for v in (MX._criteria(s, [0]) for s in sums)]
    return c.spark.createDataFrame(rows, "theta double, neg2_reml double, neg2_ml double")


oracle("lmm_null_criterion", f"""
, d AS (SELECT neighbourhood AS g, ln({E.PRICE} + 1) AS y FROM dim_listings
        WHERE {E.PRICE} BETWEEN 1 AND 2000 AND {E.RATE} IS NOT NULL AND neighbourhood IS NOT NULL),
m AS (SELECT avg(y) AS ym FROM d),
gs AS (SELECT g, CAST(count(*) AS DOUBLE) AS n, sum(y - ym) AS s, sum((y - ym) * (y - ym)) AS ss FROM d, m GROUP BY g),
t AS (SELECT unnest([{", ".join(f"{x}e0" for x in GRID)}]) AS theta),
a AS (SELECT theta, sum(n) AS n, sum(n - theta / (1 + theta * n) * n * n) AS a, sum(s - theta / (1 + theta * n) * n * s) AS b,
             sum(ss - theta / (1 + theta * n) * s * s) AS qy, sum(ln(1 + theta * n)) AS ld FROM gs, t GROUP BY theta)
SELECT theta, (n - 1) * (ln((qy - b * b / a) / (n - 1)) + 1 + ln(2 * pi())) + ld + ln(a) AS neg2_reml,
       n * (ln((qy - b * b / a) / n) + 1 + ln(2 * pi())) + ld AS neg2_ml FROM a""", ["neg2_reml", "neg2_ml"])


@query("lmm_residual_hist")
def q_lmm_residual_hist(c: Ctx):
    """60-bin histogram of the conditional residuals of model A (all rows)."""
    return MX.residual_histogram(_a(c).fitted())


@query("lmm_residual_qq")
def q_lmm_residual_qq(c: Ctx):
    """Normal Q-Q points of model A residuals on a 99-point probability grid."""
    return MX.qq_points(_a(c).fitted())


@query("lmm_slope")
def q_lmm_slope(c: Ctx):
    """Fixed effects and slope variance of the random-slope model."""
    return _fe_frame(c, _b(c), "is_entire_home Var")


@query("lmm_slope_effects")
def q_lmm_slope_effects(c: Ctx):
    """Random slope per neighbourhood, descending."""
    return _b(c).blups.select(F.col("g").alias("neighbourhood"), F.col("u").alias("entire_home_slope"))


@query("lmm_weekend")
def q_lmm_weekend(c: Ctx):
    """Weekend coefficient and premium % from the mixed model over all availability rows."""
    fit = _c(c)
    idx = fit.terms.index("is_weekend")
    coef = float(fit.beta[idx])
    return c.spark.createDataFrame(
        [(coef, float(fit.se[idx]), round(math.expm1(coef) * 100, 2), int(fit.n_obs), int(fit.n_groups),
          float(fit.ml_aic))],
        "weekend_coef double, std_error double, weekend_premium_pct double, n_obs bigint, n_groups bigint, "
        "ml_aic double")
