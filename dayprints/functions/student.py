"""Two-sided Student t quantiles, as a vectorised column function."""

from __future__ import annotations

import math
from statistics import NormalDist

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _central(t: float, df: int) -> float:
    """P(-t < T < t) by the finite series in cos(atan(t / sqrt(df)))."""
    angle = math.atan(t / math.sqrt(df))
    c2 = math.cos(angle) ** 2
    first = 2 if df % 2 else 1
    term, total = (math.cos(angle) if df % 2 else 1.0), 0.0
    for j in range(first, df, 2):
        total += term
        term *= c2 * j / (j + 1)
    total = total * math.sin(angle)
    return (angle + total) * 2 / math.pi if df % 2 else total


def t_quantile(df: int, level: float = 0.95) -> float:
    """The t with central probability ``level``; nan below one degree of freedom."""
    if df < 1:
        return math.nan
    z = NormalDist().inv_cdf((1 + level) / 2)
    if df > 2000:  # the expansion in 1 / df; its next term is below 1e-15 at usual levels
        terms = (z, (z**3 + z) / 4, (5 * z**5 + 16 * z**3 + 3 * z) / 96,
                 (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
                 (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160)
        return sum(term / df**k for k, term in enumerate(terms))
    low, high = 0.0, 1.0
    while _central(high, df) < level:
        high *= 2
    while high - low > 1e-13 * high:
        mid = (low + high) / 2
        low, high = (mid, high) if _central(mid, df) < level else (low, mid)
        if mid in (low, high) and high - low <= math.ulp(high):
            break
    return (low + high) / 2


def half_width(std: Column, n: Column, level: float = 0.95) -> Column:
    """Half width of the t interval of a mean; null for fewer than two values."""
    def quantiles(counts: pd.Series) -> pd.Series:
        known = {c: t_quantile(int(c) - 1, level) for c in counts.unique()}
        return counts.map(known).astype("float64")

    quantile = F.pandas_udf(quantiles, "double")
    return F.when(n > 1, quantile(n) * std / F.sqrt(n))
