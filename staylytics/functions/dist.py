"""Distribution tails evaluated on the driver from a handful of scalars.

Only test statistics (F, q) reach the driver; the data never does.
scipy is not available, so the two tails are computed here:

* F survival function through the regularised incomplete beta function
  (continued fraction, modified Lentz); the prefactor is formed in log
  space, so a huge F gives p = 0 (underflow), never NaN.
* Studentised range distribution by Gauss-Legendre quadrature of its
  defining double integral (range of k normals, divided by an
  independent chi/sqrt(df) scale).
"""

from __future__ import annotations

import math

import numpy as np


def _betacf(a: float, b: float, x: float, max_iter: int = 500, eps: float = 1e-15) -> float:
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, max_iter + 1):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < eps:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    log_front = (math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                 + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(log_front) * _betacf(a, b, x) / a
    return 1.0 - math.exp(log_front) * _betacf(b, a, 1.0 - x) / b


def f_sf(f: float, d1: float, d2: float) -> float:
    """P(F > f) for an F(d1, d2) variable."""
    if f is None or math.isnan(f):
        return float("nan")
    if f <= 0:
        return 1.0
    if math.isinf(f):
        return 0.0
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


_GL_Z = np.polynomial.legendre.leggauss(160)
_GL_S = np.polynomial.legendre.leggauss(120)


def _norm_cdf(x):
    return 0.5 * (1.0 + np.vectorize(math.erf)(x / math.sqrt(2.0)))


def _range_cdf_unit(w: np.ndarray, k: int) -> np.ndarray:
    """P(range of k iid N(0,1) <= w) for each w (vectorised over w)."""
    nodes, weights = _GL_Z
    lo, hi = -9.0, 9.0
    z = 0.5 * (hi - lo) * nodes + 0.5 * (hi + lo)
    wz = 0.5 * (hi - lo) * weights
    phi = np.exp(-0.5 * z * z) / math.sqrt(2 * math.pi)
    cz = _norm_cdf(z)
    w = np.atleast_1d(w)[:, None]
    inner = np.clip(cz[None, :] - _norm_cdf(z[None, :] - w), 0.0, 1.0)
    return np.clip(k * np.sum(wz * phi * inner ** (k - 1), axis=1), 0.0, 1.0)


def _stirling_rest(a: float) -> float:
    """ln gamma(a) - ((a - 1/2) ln a - a + ln(2 pi) / 2): the difference itself, or its series where that is exact."""
    if a < 30:
        return math.lgamma(a) - ((a - 0.5) * math.log(a) - a + 0.5 * math.log(2 * math.pi))
    return (1 / 12 - (1 / 360 - (1 / 1260 - 1 / 1680 / a ** 2) / a ** 2) / a ** 2) / a


def studentized_range_cdf(q: float, k: int, df: float) -> float:
    if q <= 0:
        return 0.0
    if df is None or math.isinf(df):
        return float(_range_cdf_unit(np.array([q]), k)[0])
    # s = sqrt(chi2_df / df): density concentrated around 1 with sd ~ 1/sqrt(2 df)
    sd = 1.0 / math.sqrt(2.0 * df)
    lo, hi = max(1e-9, 1.0 - 14 * sd), 1.0 + 14 * sd
    if df < 30:
        lo, hi = 1e-9, 1.0 + 30 * sd
    nodes, weights = _GL_S
    s = 0.5 * (hi - lo) * nodes + 0.5 * (hi + lo)
    ws = 0.5 * (hi - lo) * weights
    # ln density with a = df / 2: ln 2 + a ln a - ln gamma(a) + (2a - 1) ln s - a s^2, in terms that stay small
    a, u = 0.5 * df, s - 1.0
    log_f = (math.log(2.0) + 0.5 * math.log(a / (2 * math.pi)) - _stirling_rest(a) - np.log(s)
             + a * (2 * (np.log1p(u) - u) - u * u))
    return float(np.clip(np.sum(ws * np.exp(log_f) * _range_cdf_unit(q * s, k)), 0.0, 1.0))


def studentized_range_sf(q: float, k: int, df: float) -> float:
    return max(0.0, 1.0 - studentized_range_cdf(q, k, df))


def studentized_range_ppf(p: float, k: int, df: float) -> float:
    """q with P(Q <= q) = p, by bisection."""
    lo, hi = 0.0, 1.0
    while studentized_range_cdf(hi, k, df) < p:
        hi *= 2.0
    for _ in range(80):
        mid = 0.5 * (lo + hi)
        if studentized_range_cdf(mid, k, df) < p:
            lo = mid
        else:
            hi = mid
    return 0.5 * (lo + hi)
