"""Student t distribution tail for the two-sample test.

The two-sided p-value of t with df degrees of freedom is the regularised
incomplete beta I_x(df/2, 1/2) at x = df / (df + t^2), evaluated with its
continued fraction (NIST Digital Library of Mathematical Functions, 8.17.22).
Used through a pandas UDF on the one-row test result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F, types as T

def _partial_numerator(k: int, a: float, b: float, x: float) -> float:
    """k-th coefficient of the continued fraction of I_x(a, b), from 1 on (DLMF 8.17.23)."""
    m, odd = divmod(k, 2)
    if odd:
        return -x * (a + m) * (a + b + m) / ((a + 2 * m) * (a + 2 * m + 1))
    return x * m * (b - m) / ((a + 2 * m - 1) * (a + 2 * m))


def _fraction(a: float, b: float, x: float, tolerance: float = 1e-14) -> float:
    """1 / (1 + d1 / (1 + d2 / ...)), evaluated from its end; the depth doubles until the value stands."""
    depth, last = 16, math.inf
    while True:
        value = 1.0
        for k in range(depth, 0, -1):
            value = 1.0 + _partial_numerator(k, a, b, x) / value
        if abs(value - last) <= tolerance * abs(value) or depth >= 1 << 16:
            return 1.0 / value
        depth, last = 2 * depth, value


def betainc_regularized(a: float, b: float, x: float) -> float:
    """I_x(a, b) by the fraction where it converges fast, else by 1 - I_{1-x}(b, a)."""
    if x <= 0.0 or x >= 1.0:
        return float(x >= 1.0)
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - betainc_regularized(b, a, 1.0 - x)
    log_beta = math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)
    return math.exp(a * math.log(x) + b * math.log1p(-x) - log_beta) / a * _fraction(a, b, x)


def t_two_sided_p(t: float, df: float) -> float:
    if t is None or df is None or math.isnan(t) or df <= 0:
        return float("nan")
    if math.isinf(t):
        return 0.0
    return betainc_regularized(df / 2.0, 0.5, df / (df + t * t))


@F.pandas_udf(T.DoubleType())
def t_p_value(t: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided p-value column from t and degrees-of-freedom columns."""
    return pd.Series([t_two_sided_p(float(a), float(b)) if pd.notna(a) and pd.notna(b) else np.nan
                      for a, b in zip(t, df)], dtype="float64")
