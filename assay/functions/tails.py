"""Student-t tails."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType


def _log_gamma(v: np.ndarray) -> np.ndarray:
    """Log gamma of each value; few values differ in a batch."""
    few, place = np.unique(v, return_inverse=True)
    return np.array([math.lgamma(x) for x in few])[place]


def incomplete_beta(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta of whole batches by the modified Lentz continued fraction."""
    x = np.clip(x, 0.0, 1.0)
    flip = x > (a + 1.0) / (a + b + 2.0)
    p, q, y = np.where(flip, b, a), np.where(flip, a, b), np.where(flip, 1.0 - x, x)
    inside = (y > 0.0) & (y < 1.0)
    safe = np.where(inside, y, 0.5)
    front = _log_gamma(p + q) - _log_gamma(p) - _log_gamma(q) + p * np.log(safe) + q * np.log1p(-safe)
    tiny = 1e-300
    away = lambda v: np.where(np.abs(v) > tiny, v, tiny)
    c, d = np.ones_like(safe), 1.0 / away(1.0 - (p + q) * safe / (p + 1.0))
    total = d.copy()
    for m in range(1, 500):
        for step in (
            m * (q - m) * safe / ((p + 2 * m - 1) * (p + 2 * m)),
            -(p + m) * (p + q + m) * safe / ((p + 2 * m) * (p + 2 * m + 1)),
        ):
            d = 1.0 / away(1.0 + step * d)
            c = away(1.0 + step / c)
            total *= c * d
        if np.all(np.abs(c * d - 1.0) < 1e-14):
            break
    value = np.where(inside, np.exp(front) * total / p, np.where(y >= 1.0, 1.0, 0.0))
    return np.where(flip, 1.0 - value, value)


@pandas_udf(DoubleType())
def pearson_p_value(r: pd.Series, n: pd.Series) -> pd.Series:
    """Two-sided p-value of a correlation over n pairs; the input is one row per column pair."""
    corr, pairs = r.to_numpy(float, na_value=np.nan), n.to_numpy(float, na_value=np.nan)
    usable = np.isfinite(corr) & (pairs >= 3)
    freedom = np.where(usable, pairs, 3.0) - 2.0
    left = np.maximum(0.0, 1.0 - np.where(usable, corr, 0.0) ** 2)
    return pd.Series(np.where(usable, incomplete_beta(freedom / 2.0, np.full(len(freedom), 0.5), left), np.nan))


def paired_t_p_value(t: Column, df: Column) -> Column:
    """Two-sided p-value for 1 to 4 degrees of freedom in closed form, all in the JVM."""
    theta = F.atan(F.abs(t) / F.sqrt(df.cast("double")))
    sin, cos = F.sin(theta), F.cos(theta)
    inside = (
        F.when(df == 1, 2 * theta / math.pi)
        .when(df == 2, sin)
        .when(df == 3, (theta + sin * cos) * 2 / math.pi)
        .when(df == 4, sin * (1 + cos * cos / 2))
    )
    return 1 - inside
