"""Linear mixed models with one random effect per group (T7-T11), over all rows.

Model: y = X b + z u_g + e,  u_g ~ N(0, s2 * theta),  e ~ N(0, s2 I).
z = 1 gives a random intercept, z = a 0/1 column a random slope with no
random intercept. For one random effect per group the inverse of
V_g = I + theta z z' is I - c_g z z' with c_g = theta / (1 + theta z'z),
so everything the (RE)ML criterion needs is a sum over groups of
per-group sums (n, X'X, X'y, y'y, z'X, z'y, z'z):

  A(theta) = sum_g X'X - c_g (X'z)(z'X)        b(theta) = sum_g X'y - c_g X'z z'y
  Q(theta) = sum_g y'y - c_g (z'y)^2 - b'A^-1 b  ld(theta) = sum_g log(1 + theta z'z)
  REML: (N-p) log(Q/(N-p)) + ld + log|A|        ML: N log(Q/N) + ld

Work plan: one aggregation of the rows by group (partial aggregation
map-side, so a group holding a third of all rows is still one small
partial row per task); the group table is written once; the criterion is
then evaluated for a whole grid of theta values per Spark job (the grid
is exploded next to every group row and summed per theta), and the grid
is refined around the best point a few times. The driver only sees
(grid size) x (p^2) numbers, whatever the number of groups or rows.
BLUPs u_g = c_g (z'y - z'X b) are a column expression on the group table,
residuals a column expression on the rows.

X is centred by its global means before the sums (the intercept absorbs
the shift), which keeps the raw sums well conditioned; estimates are
reported on the original scale.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

LOG2PI = math.log(2 * math.pi)


@dataclass
class Design:
    frame: DataFrame          # group, y, x0..x{p-1} (x0 = intercept), z
    terms: list[str]          # names of x0..x{p-1}
    group: str


def build_design(df: DataFrame, y: str, group: str, numeric: list[str],
                 categorical: str | None = None, z: str | None = None,
                 levels: list[str] | None = None, numeric_first: bool = False) -> Design:
    """Design matrix columns (Spark expressions) in the formula's term order.

    Categorical levels are sorted; the first is the reference level
    (treatment coding). Rows with a NULL response, group or predictor are
    dropped, as a formula interface drops incomplete rows. ``z`` names the
    random-effect regressor; None means a random intercept.
    """
    need = [y, group, *numeric] + ([categorical] if categorical else []) + ([z] if z else [])
    d = df.where(F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in dict.fromkeys(need))))
    terms: list[str] = ["Intercept"]
    cat_exprs, cat_terms = [], []
    if categorical:
        from .features import levels as distinct_levels

        lv = levels if levels is not None else distinct_levels(d, categorical)
        for v in lv[1:]:
            cat_terms.append(f"C({categorical})[T.{v}]")
            cat_exprs.append(F.when(F.col(categorical) == v, 1.0).otherwise(0.0))
    num_exprs = [F.col(c).cast("double") for c in numeric]
    if numeric_first:
        exprs, terms = num_exprs + cat_exprs, terms + numeric + cat_terms
    else:
        exprs, terms = cat_exprs + num_exprs, terms + cat_terms + numeric
    zc = F.lit(1.0) if z is None else F.col(z).cast("double")
    frame = d.select(F.col(group).alias("g"), F.col(y).cast("double").alias("y"), F.lit(1.0).alias("x0"),
                     *[e.alias(f"x{i + 1}") for i, e in enumerate(exprs)], zc.alias("z"))
    return Design(frame, terms, group)


def _pairs(p: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(p) for j in range(i, p)]


def group_sums(des: Design, means: np.ndarray, ymean: float) -> DataFrame:
    """One row per group: n and the centred cross-product sums."""
    p = len(des.terms)
    xs = [F.col("x0")] + [F.col(f"x{i}") - F.lit(float(means[i])) for i in range(1, p)]
    yc = F.col("y") - F.lit(ymean)
    zc = F.col("z")
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(yc * yc).alias("yy"), F.sum(zc * yc).alias("zy"),
            F.sum(zc * zc).alias("zz")]
    aggs += [F.sum(xs[i] * xs[j]).alias(f"xx_{i}_{j}") for i, j in _pairs(p)]
    aggs += [F.sum(xs[i] * yc).alias(f"xy_{i}") for i in range(p)]
    aggs += [F.sum(xs[i] * zc).alias(f"zx_{i}") for i in range(p)]
    return des.frame.groupBy("g").agg(*aggs)


def _theta_sums(gs: DataFrame, thetas: list[float], p: int) -> list[dict]:
    """Criterion ingredients for every theta of the grid, in one Spark job."""
    arr = F.array(*[F.lit(float(t)) for t in thetas])
    t = gs.select("*", F.posexplode(arr).alias("k", "theta"))
    c = F.col("theta") / (F.lit(1.0) + F.col("theta") * F.col("zz"))
    aggs = [F.sum("n").alias("n"), F.count(F.lit(1)).alias("groups"),
            F.sum(F.col("yy") - c * F.col("zy") * F.col("zy")).alias("qy"),
            F.sum(F.log1p(F.col("theta") * F.col("zz"))).alias("ld")]
    aggs += [F.sum(F.col(f"xx_{i}_{j}") - c * F.col(f"zx_{i}") * F.col(f"zx_{j}")).alias(f"a_{i}_{j}")
             for i, j in _pairs(p)]
    aggs += [F.sum(F.col(f"xy_{i}") - c * F.col(f"zx_{i}") * F.col("zy")).alias(f"b_{i}") for i in range(p)]
    rows = t.groupBy("k").agg(*aggs).collect()
    out = []
    for r in rows:
        a = np.zeros((p, p))
        for i, j in _pairs(p):
            a[i, j] = a[j, i] = r[f"a_{i}_{j}"]
        out.append({"theta": float(thetas[r["k"]]), "n": int(r["n"]), "groups": int(r["groups"]),
                    "qy": float(r["qy"]), "ld": float(r["ld"]),
                    "A": a, "b": np.array([r[f"b_{i}"] for i in range(p)], dtype=float)})
    return out


def independent_columns(xtx: np.ndarray, tol: float = 1e-10) -> list[int]:
    """Greedy column pivot: keep a column unless it is (nearly) a combination of kept ones."""
    keep: list[int] = []
    for j in range(xtx.shape[0]):
        d = xtx[j, j]
        if d <= 0:
            continue
        if keep:
            k = np.array(keep)
            sol = np.linalg.lstsq(xtx[np.ix_(k, k)], xtx[k, j], rcond=None)[0]
            resid = d - xtx[k, j] @ sol
        else:
            resid = d
        if resid > tol * d:
            keep.append(j)
    return keep


def _criteria(s: dict, keep: list[int]) -> dict:
    a = s["A"][np.ix_(keep, keep)]
    b = s["b"][keep]
    n, p = s["n"], len(keep)
    beta = np.linalg.solve(a, b)
    q = s["qy"] - float(beta @ b)
    sign, logdet = np.linalg.slogdet(a)
    q = max(q, 1e-300)
    reml = (n - p) * (math.log(q / (n - p)) + 1 + LOG2PI) + s["ld"] + logdet
    ml = n * (math.log(q / n) + 1 + LOG2PI) + s["ld"]
    return {**s, "beta": beta, "q": q, "reml": reml, "ml": ml, "logdet": logdet}


@dataclass
class MixedFit:
    terms: list[str]
    beta: np.ndarray            # original scale, NaN for dropped (collinear) terms
    se: np.ndarray
    theta: float
    scale: float                # residual variance (REML)
    group_var: float            # theta * scale
    reml_neg2_loglik: float
    ml_neg2_loglik: float
    ml_aic: float
    n_obs: int
    n_groups: int
    blups: DataFrame            # g, n, u
    design: Design
    beta_c: np.ndarray          # centred-scale coefficients of kept terms
    keep: list[int]
    means: np.ndarray
    ymean: float

    def fixed_effects(self) -> list[tuple]:
        out = []
        for t, b, s in zip(self.terms, self.beta, self.se):
            if np.isnan(b):
                out.append((t, None, None, None, None))
                continue
            zv = b / s if s > 0 else None
            pv = math.erfc(abs(zv) / math.sqrt(2)) if zv is not None else None
            out.append((t, float(b), float(s), None if zv is None else float(zv), pv))
        return out

    def fitted(self, rows: DataFrame | None = None) -> DataFrame:
        """Rows of the design with fitted = Xb + z u_g and resid = y - fitted."""
        fr = self.design.frame if rows is None else rows
        xb = F.lit(0.0)
        for i, b in enumerate(self.beta):
            if not np.isnan(b):
                xb = xb + F.col(f"x{i}") * F.lit(float(b))
        # the BLUP table has one row per group (a few dozen neighbourhoods); Spark
        # broadcasts it from its measured size under AQE, no forced hint needed
        j = fr.join(self.blups.select("g", "u"), "g", "left")
        fit = xb + F.col("z") * F.coalesce(F.col("u"), F.lit(0.0))
        return j.select("g", "y", fit.alias("fitted"), (F.col("y") - fit).alias("resid"))


# ln theta is searched this far at most (e^60 is beyond what doubles can tell from infinity), in steps of this width
EDGE, WIDER = 60.0, 12.0


def fit_mixed(des: Design, passes: int = 2, grid: int = 201, lo: float = -14.0, hi: float = 9.0,
              refine: int = 201) -> MixedFit:
    """REML fit (and the ML criterion for the AIC) by grid refinement over log theta.

    One Spark job per pass: a ``grid``-point pass over [lo, hi] (plus
    theta = 0), more of the same on the side where the best point is the
    last one, then ``passes`` passes of ``refine`` points around the best
    REML and ML points, each 100x finer than the last.
    """
    p = len(des.terms)
    st = des.frame.agg(F.avg("y").alias("ym"), *[F.avg(f"x{i}").alias(f"m{i}") for i in range(p)]).first()
    means = np.array([0.0] + [float(st[f"m{i}"]) for i in range(1, p)])
    ymean = float(st["ym"])
    gs = cut_lineage(group_sums(des, means, ymean))  # one row per group, written once

    def sums(thetas: list[float]) -> list[dict]:
        return _theta_sums(gs, thetas, p)

    step = (hi - lo) / (grid - 1)
    first = sums([0.0] + [math.exp(x) for x in np.linspace(lo, hi, grid)])
    s0 = next(s for s in first if s["theta"] == 0.0)
    keep = independent_columns(s0["A"])
    evals: dict[float, dict] = {s["theta"]: _criteria(s, keep) for s in first}
    while abs(lo) < EDGE and abs(hi) < EDGE:
        best = {min(evals, key=lambda t: evals[t][c]) for c in ("reml", "ml")}
        ends = sorted(t for t in evals if t > 0)
        if ends[-1] in best:
            new, hi = np.linspace(hi + step, hi + WIDER, round(WIDER / step)), hi + WIDER
        elif ends[0] in best:  # theta = 0 is a point of its own and may be the best
            new, lo = np.linspace(lo - WIDER, lo - step, round(WIDER / step)), lo - WIDER
        else:
            break
        for s in sums([math.exp(x) for x in new]):
            evals[s["theta"]] = _criteria(s, keep)
    for _ in range(passes):
        nxt = set()
        for crit in ("reml", "ml"):
            pos = {t: v for t, v in evals.items() if t > 0}
            tb = math.log(min(pos, key=lambda t: pos[t][crit]))
            nxt |= {math.exp(x) for x in np.linspace(tb - step, tb + step, refine)}
        new = sorted(t for t in nxt if t not in evals)
        if new:
            for s in sums(new):
                evals[s["theta"]] = _criteria(s, keep)
        step /= (refine - 1) / 2
    best = {c: min(evals, key=lambda t: evals[t][c]) for c in ("reml", "ml")}
    fit = evals[best["reml"]]
    theta = best["reml"]
    n = fit["n"]
    scale = fit["q"] / (n - len(keep))
    cov_c = scale * np.linalg.inv(fit["A"][np.ix_(keep, keep)])
    # back to the original scale: intercept_0 = intercept_c + ymean - sum b_j m_j
    bfull_c = np.zeros(p)
    bfull_c[keep] = fit["beta"]
    tmat = np.eye(p)
    tmat[0, 1:] = -means[1:]
    beta = tmat @ bfull_c
    beta[0] += ymean
    covfull = np.zeros((p, p))
    covfull[np.ix_(keep, keep)] = cov_c
    cov = tmat @ covfull @ tmat.T
    se = np.sqrt(np.maximum(np.diag(cov), 0.0))
    dropped = [i for i in range(p) if i not in keep]
    beta[dropped] = np.nan
    se[dropped] = np.nan
    ml = evals[best["ml"]]["ml"]
    k_params = len(keep) + 2
    c = F.lit(theta) / (F.lit(1.0) + F.lit(theta) * F.col("zz"))
    zxb = F.lit(0.0)
    for idx, b in zip(keep, fit["beta"]):
        zxb = zxb + F.col(f"zx_{idx}") * F.lit(float(b))
    blups = gs.select("g", "n", (c * (F.col("zy") - zxb)).alias("u"))
    n_groups = fit["groups"]
    return MixedFit(des.terms, beta, se, theta, scale, theta * scale, fit["reml"], ml,
                    ml + 2 * k_params, n, n_groups, blups, des, fit["beta"], keep, means, ymean)


def residual_histogram(resid: DataFrame, bins: int = 60) -> DataFrame:
    """Equal-width histogram between min and max (the last bin is closed)."""
    mm = resid.agg(F.min("resid").alias("lo"), F.max("resid").alias("hi")).first()
    lo, hi = float(mm["lo"]), float(mm["hi"])
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((F.col("resid") - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = resid.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    every = resid.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))  # empty bins count 0
    return every.join(counts, "bin", "left").select(
        "bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_start"),
        (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_end"),
        F.coalesce("count", F.lit(0)).alias("count"))


# ---- the three models of the multilevel analysis ---------------------------

ENTIRE_HOME = "Entire home/apt"


def listing_model_frame(dl: DataFrame, entire_home: str = ENTIRE_HOME) -> DataFrame:
    """T7/T10 input: listings with price 1..2000 and a known rate, log features."""
    price, rate = "avg_price_next_30_days", "availability_rate_next_30_days"
    return dl.where(F.col(price).between(1, 2000) & F.col(rate).isNotNull()).select(
        "neighbourhood", "room_type",
        F.ln(F.col(price) + 1).alias("log_price"),
        F.ln(F.col("minimum_nights") + 1).alias("log_min_nights"),
        F.ln(F.col("total_reviews") + 1).alias("log_reviews"),
        F.col(rate).alias("avail"),
        F.when(F.col("room_type") == entire_home, 1.0).otherwise(0.0).alias("is_entire_home"))


def model_intercept(dl: DataFrame) -> MixedFit:
    """log_price ~ log_min_nights + log_reviews + avail + C(room_type), (1 | neighbourhood)."""
    d = listing_model_frame(dl)
    return fit_mixed(build_design(d, "log_price", "neighbourhood",
                                  ["log_min_nights", "log_reviews", "avail"], "room_type"))


def model_slope(dl: DataFrame, entire_home: str = ENTIRE_HOME) -> MixedFit:
    """Same covariates + is_entire_home, random slope on is_entire_home only."""
    d = listing_model_frame(dl, entire_home)
    return fit_mixed(build_design(d, "log_price", "neighbourhood",
                                  ["log_min_nights", "log_reviews", "avail", "is_entire_home"],
                                  z="is_entire_home"))


def model_weekend(fa: DataFrame) -> MixedFit:
    """log1p(price) ~ is_weekend + C(room_type), (1 | neighbourhood), all availability rows."""
    d = fa.where(F.col("price_usd").between(1, 5000) & F.col("neighbourhood").isNotNull()).select(
        "neighbourhood", "room_type", F.log1p("price_usd").alias("log_price"),
        F.when(F.col("is_weekend"), 1.0).otherwise(0.0).alias("is_weekend"))
    return fit_mixed(build_design(d, "log_price", "neighbourhood", ["is_weekend"], "room_type"))


def qq_points(resid: DataFrame, grid: int = 99) -> DataFrame:
    """Normal Q-Q on a probability grid: exact residual quantiles vs standard normal quantiles."""
    from statistics import NormalDist

    from .quantiles import exact_quantiles

    probs = [(i + 0.5) / grid for i in range(grid)]
    nd = NormalDist()
    theo = resid.sparkSession.createDataFrame([(float(p), nd.inv_cdf(p)) for p in probs],
                                              "prob double, theoretical double")
    q = exact_quantiles(resid, "resid", probs).withColumnRenamed("value", "sample")
    return theo.join(q, "prob").select("prob", "theoretical", "sample")
