"""Distribution tails for test statistics.

Spark has no t or normal CDF, so the two-sided p-values are a pandas UDF.  It is
only ever applied to aggregated rows (one per test or per simulation), never to
raw events, so the Python hop costs nothing at scale.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TINY = 1e-300


def _betacf(a: np.ndarray, b: np.ndarray, x: np.ndarray, max_iter: int = 20000, eps: float = 4e-16 * 4) -> np.ndarray:
    """Continued fraction of the incomplete beta (modified Lentz), vectorised."""
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c = np.ones_like(x)
    d = 1.0 - qab * x / qap
    d = np.where(np.abs(d) < _TINY, _TINY, d)
    d = 1.0 / d
    h = d.copy()
    for m in range(1, max_iter + 1):
        m2 = 2.0 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < _TINY, _TINY, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < _TINY, _TINY, c)
        d = 1.0 / d
        h = h * d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < _TINY, _TINY, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < _TINY, _TINY, c)
        d = 1.0 / d
        delta = d * c
        h = h * delta
        if np.all(np.abs(delta - 1.0) < eps):
            return h
    raise ArithmeticError(f"incomplete beta: no convergence after {max_iter} terms")


def _lgamma(v: np.ndarray) -> np.ndarray:
    return np.array([math.lgamma(float(z)) for z in v], dtype=float)


def betainc_reg(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta I_x(a, b) for arrays (NaN where undefined)."""
    a, b, x = (np.asarray(v, dtype=float) for v in (a, b, x))
    out = np.full(x.shape, np.nan)
    ok = np.isfinite(a) & np.isfinite(b) & np.isfinite(x) & (a > 0) & (b > 0) & (x >= 0) & (x <= 1)
    if not ok.any():
        return out
    a, b, x = a[ok], b[ok], x[ok]
    with np.errstate(divide="ignore", invalid="ignore"):
        lbt = _lgamma(a + b) - _lgamma(a) - _lgamma(b) + a * np.log(x) + b * np.log1p(-x)
        bt = np.exp(lbt)
        direct = x < (a + 1.0) / (a + b + 2.0)
        res = np.empty_like(x)
        if direct.any():
            i = direct
            res[i] = bt[i] * _betacf(a[i], b[i], x[i]) / a[i]
        if (~direct).any():
            i = ~direct
            res[i] = 1.0 - bt[i] * _betacf(b[i], a[i], 1.0 - x[i]) / b[i]
    out[ok] = np.clip(res, 0.0, 1.0)
    return out


#: from here on the normal expansion of the t tail is exact to double precision
LARGE_DOF = 1e4


def _t_sf2_large(t: np.ndarray, nu: np.ndarray) -> np.ndarray:
    """Two-sided t tail for many degrees of freedom: the normal tail at a corrected point.

    z0 = sqrt((nu - 1/2) log(1 + t^2 / nu)) and the first two terms of its expansion in
    1 / (48 (nu - 1/2)^2); what is left out is of the order nu^-6 relative.
    """
    a = nu - 0.5
    b = 48.0 * a * a
    z = np.sqrt(a * np.log1p(t * t / nu))
    z2 = z * z
    z = z + z * (z2 + 3.0) / b - z * (((4.0 * z2 + 33.0) * z2 + 240.0) * z2 + 855.0) / (10.0 * b * (b + 0.8 * z2 * z2 + 100.0))
    return normal_sf2(z)


def t_sf2(t: np.ndarray, nu: np.ndarray) -> np.ndarray:
    """Two-sided tail P(|T_nu| >= |t|) = I_{nu/(nu+t^2)}(nu/2, 1/2)."""
    t, nu = np.abs(np.asarray(t, dtype=float)), np.asarray(nu, dtype=float)
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        x = nu / (nu + t * t)
        x = np.where(np.isinf(t) & np.isfinite(nu), 0.0, x)
    large = np.isfinite(nu) & np.isfinite(t) & (nu >= LARGE_DOF)
    out = betainc_reg(np.where(large, 1.0, nu) / 2.0, np.full_like(nu, 0.5), x)
    if large.any():
        out[large] = _t_sf2_large(t[large], nu[large])
    return out


def normal_sf2(z: np.ndarray) -> np.ndarray:
    """2 * P(Z >= z) = erfc(z / sqrt 2) (not folded: negative z gives > 1)."""
    z = np.asarray(z, dtype=float)
    return np.array([math.erfc(v / math.sqrt(2.0)) if np.isfinite(v) else np.nan for v in z], dtype=float)


def _series(v: np.ndarray) -> pd.Series:
    s = pd.Series(v, dtype="float64")
    return s.where(np.isfinite(s), None)


@F.pandas_udf(T.DoubleType())
def _t_two_sided_p(t: pd.Series, nu: pd.Series) -> pd.Series:
    return _series(t_sf2(t.to_numpy(dtype=float, na_value=np.nan), nu.to_numpy(dtype=float, na_value=np.nan)))


@F.pandas_udf(T.DoubleType())
def _normal_sf2(z: pd.Series) -> pd.Series:
    return _series(normal_sf2(z.to_numpy(dtype=float, na_value=np.nan)))


def t_two_sided_p(t: Column, nu: Column) -> Column:
    """Two-sided p-value of Student's t with ``nu`` degrees of freedom (NULL-safe)."""
    return F.when(t.isNotNull() & nu.isNotNull(), _t_two_sided_p(t, nu))


def normal_two_sided_p(z: Column) -> Column:
    """``min(1, 2 * P(Z >= z))`` as scipy reports it for an upper-tail statistic."""
    return F.when(z.isNotNull(), F.least(F.lit(1.0), _normal_sf2(z)))
