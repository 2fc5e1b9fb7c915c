"""Tails of Student's t and chi-squared as plain column expressions, by Simpson's rule over a window at the peak."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

PANELS = 400


def simpson(f, low: Column, high: Column) -> Column:
    """Integral of f, a function of columns, from low to high."""
    h = (high - low) / PANELS
    weighted = F.transform(F.sequence(F.lit(0), F.lit(PANELS)), lambda i: F.when((i == 0) | (i == PANELS), 1.0).when(i % 2 == 1, 4.0).otherwise(2.0) * f(low + h * i))
    return F.aggregate(weighted, F.lit(0.0), lambda a, x: a + x) * h / 3


def t_two_sided(t: Column, df: Column) -> Column:
    """Two-sided p of Student's t: the share of cos^(df - 1) beyond the angle of t."""
    theta, width = F.atan(F.abs(t) / F.sqrt(df)), F.lit(12.0) / F.sqrt(df)
    half = F.lit(math.pi / 2)
    g = lambda x: F.pow(F.greatest(F.cos(x), F.lit(0.0)), df - 1)
    return F.when(F.isnan(t), F.lit(float("nan"))).when(F.abs(t) == float("inf"), 0.0).otherwise(simpson(g, theta, F.least(half, theta + width)) / simpson(g, F.lit(0.0), F.least(half, width)))


def chi_squared_tail(x: Column, k: Column) -> Column:
    """p of chi-squared with k degrees of freedom, integrated over its square root."""
    root = F.sqrt(x)
    upper = root + 14 + F.sqrt(k)
    g = lambda u: F.pow(u, k - 1) * F.exp(-u * u / 2)
    return simpson(g, root, upper) / simpson(g, F.lit(0.0), upper)


def welch(n1: Column, m1: Column, v1: Column, n2: Column, m2: Column, v2: Column) -> tuple[Column, Column]:
    """t and degrees of freedom. If neither group varies, t is infinite or NaN and the degrees are 1."""
    a, b = v1 / n1, v2 / n2
    flat = a + b == 0
    t = F.when(flat, F.when(m1 == m2, F.lit(float("nan"))).when(m1 > m2, F.lit(float("inf"))).otherwise(F.lit(float("-inf")))).otherwise((m1 - m2) / F.sqrt(F.when(flat, 1.0).otherwise(a + b)))
    df = F.when(flat, 1.0).otherwise(F.pow(a + b, 2) / F.when(flat, 1.0).otherwise(a * a / (n1 - 1) + b * b / (n2 - 1)))
    return t, df
