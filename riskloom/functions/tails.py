"""Distribution tails for p-values, applied to summary rows only (one row per
feature), as Arrow-batched pandas UDFs. Asymptotic forms throughout: normal
for Mann–Whitney, Student t, F, chi-square via regularised incomplete
beta/gamma, and the Kolmogorov series for KS.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

def _beta_terms(a: float, b: float, x: float) -> float:
    """x^a (1-x)^b / (a B(a, b)) over 1 + d1/(1 + d2/(1 + ...)), evaluated from
    its last term back; the number of terms grows with the root of a and b."""
    value = 1.0
    for j in range(100 + int(4 * math.sqrt(max(a, b))), 0, -1):
        m = j // 2
        if j % 2:
            d = -(a + m) * (a + b + m) / ((a + 2 * m) * (a + 2 * m + 1))
        else:
            d = m * (b - m) / ((a + 2 * m - 1) * (a + 2 * m))
        value = 1.0 + d * x / value
    front = math.lgamma(a + b) - math.lgamma(a + 1) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    return math.exp(front) / value


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b), from the side that converges."""
    if x <= 0.0 or x >= 1.0:
        return float(x >= 1.0)
    if x * (a + b + 2) < a + 1:
        return _beta_terms(a, b, x)
    return 1.0 - _beta_terms(b, a, 1.0 - x)


def gammaincc(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x): one minus the power series
    below the mean, the continued fraction (from its last term back) above."""
    if x <= 0.0:
        return 1.0
    front = a * math.log(x) - x - math.lgamma(a)
    steps = 100 + int(6 * math.sqrt(a + x))
    if x < a + 1:
        powers = np.cumprod(x / (a + np.arange(1, steps + 1)))
        return max(0.0, 1.0 - math.exp(front) * (1.0 + powers.sum()) / a)
    value = x + 2 * steps + 1 - a
    for i in range(steps, 0, -1):
        value = x + 2 * i - 1 - a - i * (i - a) / value
    return math.exp(front) / value


def norm_two_sided(z: float) -> float:
    return min(1.0, math.erfc(abs(z) / math.sqrt(2.0)))


def t_two_sided(t: float, df: float) -> float:
    if df <= 0 or math.isnan(t):
        return float("nan")
    return betainc(df / 2.0, 0.5, df / (df + t * t))


def f_sf(f: float, d1: float, d2: float) -> float:
    if f <= 0 or math.isnan(f) or d1 <= 0 or d2 <= 0:
        return float("nan") if math.isnan(f) else 1.0
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def chi2_sf(x: float, k: float) -> float:
    if math.isinf(x):
        return 0.0
    if k <= 0 or math.isnan(x):
        return float("nan")
    return gammaincc(k / 2.0, x / 2.0)


def kolmogorov_sf(d: float, n0: float, n1: float) -> float:
    """Asymptotic two-sample KS p-value (Kolmogorov series, Stephens' factor)."""
    if n0 <= 0 or n1 <= 0 or math.isnan(d):
        return float("nan")
    en = math.sqrt(n0 * n1 / (n0 + n1))
    lam = (en + 0.12 + 0.11 / en) * d
    if lam < 1e-3:
        return 1.0
    s = 0.0
    for k in range(1, 200):
        term = 2.0 * (-1) ** (k - 1) * math.exp(-2.0 * k * k * lam * lam)
        s += term
        if abs(term) < 1e-16:
            break
    return min(1.0, max(0.0, s))


def _vec(fn, *cols):
    out = []
    for vals in zip(*cols):
        if any(v is None or (isinstance(v, float) and math.isnan(v)) for v in vals):
            out.append(float("nan"))
        else:
            out.append(fn(*[float(v) for v in vals]))
    return pd.Series(out, dtype="float64")


@F.pandas_udf(T.DoubleType())
def p_norm(z: pd.Series) -> pd.Series:
    return _vec(norm_two_sided, z)


@F.pandas_udf(T.DoubleType())
def p_t(t: pd.Series, df: pd.Series) -> pd.Series:
    return _vec(t_two_sided, t, df)


@F.pandas_udf(T.DoubleType())
def p_f(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return _vec(f_sf, f, d1, d2)


@F.pandas_udf(T.DoubleType())
def p_chi2(x: pd.Series, k: pd.Series) -> pd.Series:
    return _vec(chi2_sf, x, k)


@F.pandas_udf(T.DoubleType())
def p_ks(d: pd.Series, n0: pd.Series, n1: pd.Series) -> pd.Series:
    return _vec(kolmogorov_sf, d, n0, n1)


def nan_to_null(c):
    return F.nanvl(c, F.lit(None).cast("double"))


__all__ = ["p_norm", "p_t", "p_f", "p_chi2", "p_ks", "betainc", "gammaincc", "norm_two_sided",
           "t_two_sided", "f_sf", "chi2_sf", "kolmogorov_sf", "np"]
