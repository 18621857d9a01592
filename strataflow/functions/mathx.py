"""Small special functions (no scipy available) and their Pandas-UDF forms.

They are applied only to small summary tables (one row per group pair or
per column), never to data rows, so Arrow-batched UDFs are plenty.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _betacf(a: float, b: float, x: float, max_iter: int = 1_000_000, eps: float = 3e-15) -> float:
    """Continued fraction for the incomplete beta (modified Lentz), to convergence."""
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
            return h
    raise ArithmeticError(f"incomplete beta did not converge at a={a}, b={b}, x={x}")


def betainc(a: float, b: float, x: float) -> float:
    """Regularized incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbeta = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    front = math.exp(lbeta + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _betacf(a, b, x) / a
    return 1.0 - front * _betacf(b, a, 1.0 - x) / b


def t_two_sided_p(t: float, df: float) -> float:
    """P(|T| >= |t|) for Student's t with ``df`` degrees of freedom; NaN -> 1."""
    if t is None or df is None or not np.isfinite(df) or df <= 0 or (isinstance(t, float) and math.isnan(t)):
        return 1.0
    if math.isinf(t):
        return 0.0
    return betainc(df / 2.0, 0.5, df / (df + t * t))


def t_cdf(t: float, df: float) -> float:
    p = t_two_sided_p(t, df) / 2.0
    return 1.0 - p if t >= 0 else p


def t_ppf(q: float, df: float) -> float:
    """Quantile of Student's t by bisection on the CDF."""
    if df <= 0 or not np.isfinite(df):
        return float("nan")
    if not 0.0 < q < 1.0:
        return math.copysign(math.inf, q - 0.5)
    lo, hi = -1.0, 1.0
    while t_cdf(lo, df) > q:
        lo *= 2.0
    while t_cdf(hi, df) < q:
        hi *= 2.0
    for _ in range(200):
        mid = (lo + hi) / 2.0
        if t_cdf(mid, df) < q:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2.0


def ks_p_asymptotic(d: float, n1: int, n2: int) -> float:
    """Two-sample Kolmogorov-Smirnov p-value, asymptotic Kolmogorov series
    with the usual small-sample correction of the effective n."""
    if n1 <= 0 or n2 <= 0:
        return float("nan")
    en = math.sqrt(n1 * n2 / (n1 + n2))
    lam = (en + 0.12 + 0.11 / en) * d
    if lam <= 0.0:
        return 1.0
    if lam < 1.0:
        # the series of the distribution function, which converges fast for small lambda
        below = sum(math.exp(-((2 * k - 1) * math.pi) ** 2 / (8.0 * lam * lam)) for k in range(1, 20))
        return min(1.0, max(0.0, 1.0 - math.sqrt(2.0 * math.pi) / lam * below))
    return min(1.0, max(0.0, 2.0 * sum((-1) ** (k - 1) * math.exp(-2.0 * k * k * lam * lam) for k in range(1, 20))))


# ------------------------------------------------------------------ Pandas UDFs

@F.pandas_udf(T.DoubleType())
def _t_p_udf(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([t_two_sided_p(None if pd.isna(a) else float(a), None if pd.isna(b) else float(b))
                      for a, b in zip(t, df)])


@F.pandas_udf(T.DoubleType())
def _t_ppf_udf(q: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([t_ppf(float(a), float(b)) if pd.notna(b) and b > 0 else float("nan") for a, b in zip(q, df)])


@F.pandas_udf(T.DoubleType())
def _ks_p_udf(d: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    return pd.Series([ks_p_asymptotic(float(a), int(b), int(c)) for a, b, c in zip(d, n1, n2)])


def t_p_value(t: Column, df: Column) -> Column:
    """Two-sided Student-t p-value column (Arrow-batched UDF)."""
    return _t_p_udf(t, df)


def t_quantile(q: Column, df: Column) -> Column:
    return _t_ppf_udf(q, df)


def ks_p_value(d: Column, n1: Column, n2: Column) -> Column:
    return _ks_p_udf(d, n1, n2)
