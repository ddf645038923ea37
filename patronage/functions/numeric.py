"""Numeric column expressions, and the special functions the value models need."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def half_even(value: Column, digits: int) -> Column:
    """Round to ``digits`` places, ties to the even digit, by scaling in doubles."""
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def money_sum(amount: Column) -> Column:
    """Exact sum of two-decimal amounts as a double; 0 where every amount is null."""
    total = F.sum(amount.cast(MONEY))
    return F.coalesce(total.cast("double"), F.lit(0.0))


def money_mean(amount: Column) -> Column:
    """Mean of two-decimal amounts, from the exact sum."""
    return F.try_divide(F.sum(amount.cast(MONEY)).cast("double"), F.count(amount))


def whole_days(later: Column, earlier: Column) -> Column:
    """Days from ``earlier`` to ``later``, rounded down, also when negative."""
    # Through micros, so that part days below zero go down and not towards zero.
    gap = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return F.floor(gap / F.lit(86_400_000_000)).cast("long")


def month_number(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def log_gamma(z: np.ndarray) -> np.ndarray:
    """ln Γ(z) for z > 0: the argument is moved up by eight, then Stirling's series."""
    z = np.asarray(z, dtype=float)
    rising = np.prod([z + step for step in range(8)], axis=0)
    w = z + 8.0
    inv2 = 1.0 / (w * w)
    series = 1 / 12 + inv2 * (-1 / 360 + inv2 * (1 / 1260 + inv2 * (-1 / 1680 + inv2 / 1188)))
    return (w - 0.5) * np.log(w) - w + 0.5 * math.log(2 * math.pi) + series / w - np.log(rising)


def digamma(z: np.ndarray) -> np.ndarray:
    """The derivative of ln Γ(z) for z > 0, by the same shift and series."""
    z = np.asarray(z, dtype=float)
    rising = np.sum([1.0 / (z + step) for step in range(8)], axis=0)
    w = z + 8.0
    inv2 = 1.0 / (w * w)
    series = inv2 * (1 / 12 - inv2 * (1 / 120 - inv2 * (1 / 252 - inv2 * (1 / 240 - inv2 / 132))))
    return np.log(w) - 0.5 / w - series - rising
