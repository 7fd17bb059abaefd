"""Distribution tails as Arrow functions, for which there are no SQL functions."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _beta_cf(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    safe = lambda v: np.where(np.abs(v) < tiny, tiny, v)
    c, d = np.ones_like(x), 1 / safe(1 - (a + b) * x / (a + 1))
    h = d.copy()
    for m in range(1, 300):
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / safe(1 + top * d)
            c = safe(1 + top / c)
            h = h * c * d
        if np.abs(c * d - 1).max(initial=0) < 1e-15:
            break
    return h


_lgamma = np.vectorize(math.lgamma, otypes=[float])


def incomplete_beta(a: np.ndarray, b: float, x: np.ndarray) -> np.ndarray:
    """Regularized, for arrays a and x."""
    x = np.clip(x, 0.0, 1.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        front = lambda p, q, y: np.exp(_lgamma(p + q) - _lgamma(p) - _lgamma(q) + p * np.log(y) + q * np.log1p(-y)) / p
        bb, swap = np.full_like(a, b), x > (a + 1) / (a + b + 2)
        # whichever side converges fast: I_x(a, b) = 1 - I_{1-x}(b, a)
        p, q, y = np.where(swap, bb, a), np.where(swap, a, bb), np.where(swap, 1 - x, x)
        got = front(p, q, y) * _beta_cf(p, q, y)
    out = np.where(swap, 1 - got, got)
    return np.where(x <= 0, 0.0, np.where(x >= 1, 1.0, out))


@F.pandas_udf(DoubleType())
def t_two_sided(rho: pd.Series, n: pd.Series) -> pd.Series:
    """Two-sided p of a correlation of n pairs by Student's t, n - 2 degrees of freedom; null where undefined."""
    r, k = rho.to_numpy(float), n.to_numpy(float)
    ok = ~np.isnan(r) & (k > 2)
    out = np.full(len(r), np.nan)
    if ok.any():
        # p = I_{1 - r^2}(df/2, 1/2)
        out[ok] = incomplete_beta((k[ok] - 2) / 2, 0.5, np.clip(1 - r[ok] ** 2, 0, 1))
    return pd.Series(out).where(ok, None)


@F.pandas_udf(DoubleType())
def normal_two_sided(z: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or x != x else math.erfc(abs(x) / math.sqrt(2)) for x in z.tolist()], dtype="Float64").astype(float)
