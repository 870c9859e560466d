"""Mixed models from group sums against a dense numpy REML on small fixtures."""

import math

import numpy as np
import pandas as pd
import pytest

from staylytics.operators import mixed as MX


def dense_criteria(X, y, z, g, theta):
    """REML and ML -2 log L with the residual variance profiled out, dense V."""
    n, p = X.shape
    vinv = np.zeros((n, n))
    ld = 0.0
    for lab in np.unique(g):
        idx = np.where(g == lab)[0]
        zg = z[idx][:, None]
        v = np.eye(len(idx)) + theta * zg @ zg.T
        vinv[np.ix_(idx, idx)] = np.linalg.inv(v)
        ld += np.linalg.slogdet(v)[1]
    a = X.T @ vinv @ X
    beta = np.linalg.solve(a, X.T @ vinv @ y)
    r = y - X @ beta
    q = r @ vinv @ r
    reml = (n - p) * (math.log(q / (n - p)) + 1 + math.log(2 * math.pi)) + ld + np.linalg.slogdet(a)[1]
    ml = n * (math.log(q / n) + 1 + math.log(2 * math.pi)) + ld
    return reml, ml, beta, q / (n - p), vinv


def golden(f, lo, hi, it=200):
    phi = (math.sqrt(5) - 1) / 2
    a, b = lo, hi
    c, d = b - phi * (b - a), a + phi * (b - a)
    for _ in range(it):
        if f(c) < f(d):
            b = d
        else:
            a = c
        c, d = b - phi * (b - a), a + phi * (b - a)
    return (a + b) / 2


def fixture(slope: bool, seed=7):
    rng = np.random.default_rng(seed)
    rows = []
    for gi in range(9):
        u = rng.normal(0, 0.5)
        for _ in range(rng.integers(5, 40)):
            x1 = rng.normal(2, 1)
            cat = ["a", "b", "c"][rng.integers(0, 3)]
            zz = float(rng.integers(0, 2)) if slope else 1.0
            y = 1.0 + 0.3 * x1 + (0.4 if cat == "b" else 0.0) + u * zz + rng.normal(0, 0.7)
            rows.append((f"g{gi}", x1, cat, zz, y))
    return pd.DataFrame(rows, columns=["grp", "x1", "cat", "zflag", "y"])


@pytest.mark.parametrize("slope", [False, True])
def test_mixed_matches_dense(spark, slope):
    pdf = fixture(slope)
    df = spark.createDataFrame(pdf)
    des = MX.build_design(df, "y", "grp", ["x1"], "cat", z="zflag" if slope else None)
    fit = MX.fit_mixed(des)
    X = np.column_stack([np.ones(len(pdf)), (pdf.cat == "b").astype(float), (pdf.cat == "c").astype(float), pdf.x1])
    z = pdf.zflag.to_numpy() if slope else np.ones(len(pdf))
    g = pdf.grp.to_numpy()
    y = pdf.y.to_numpy()
    lt = golden(lambda t: dense_criteria(X, y, z, g, math.exp(t))[0], -12, 6)
    reml, ml, beta, scale, vinv = dense_criteria(X, y, z, g, math.exp(lt))
    assert des.terms == ["Intercept", "C(cat)[T.b]", "C(cat)[T.c]", "x1"]
    assert fit.reml_neg2_loglik == pytest.approx(reml, abs=1e-6)
    assert fit.theta == pytest.approx(math.exp(lt), rel=2e-3)
    np.testing.assert_allclose(fit.beta, beta, atol=1e-5)
    assert fit.scale == pytest.approx(scale, rel=1e-4)
    # BLUP u_g = theta z_g' V_g^-1 r_g
    th = math.exp(lt)
    r = y - X @ beta
    u = {row["g"]: row["u"] for row in fit.blups.collect()}
    for lab in np.unique(g):
        idx = np.where(g == lab)[0]
        expect = th * z[idx] @ vinv[np.ix_(idx, idx)] @ r[idx]
        assert u[lab] == pytest.approx(expect, abs=1e-5)
    # residuals = y - Xb - z u
    res = fit.fitted().toPandas()
    assert len(res) == len(pdf)
    assert res.resid.abs().max() < 10


def test_collinear_term_dropped(spark):
    pdf = fixture(False)
    pdf["x2"] = pdf.x1 * 2.0
    des = MX.build_design(spark.createDataFrame(pdf), "y", "grp", ["x1", "x2"], "cat")
    fit = MX.fit_mixed(des)
    assert math.isnan(fit.beta[-1]) and not math.isnan(fit.beta[-2])
