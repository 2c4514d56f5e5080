"""Numeric column expressions shared by the jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def share(part: Column | str, whole: Column | str) -> Column:
    """``part / whole`` as double, NULL when the whole is zero or NULL."""
    part = F.col(part) if isinstance(part, str) else part
    whole = F.col(whole) if isinstance(whole, str) else whole
    return F.try_divide(part.cast("double"), whole.cast("double"))


def at_least(value: Column, threshold: Column | float) -> Column:
    """``value >= threshold`` compared at 9 decimals.

    The thresholds are decimal numbers (0.10, 0.02 ...) and the values are
    differences of ratios, so plain double arithmetic would miss exact hits
    such as 0.5 - 0.4 >= 0.1.
    """
    threshold = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return F.round(value - threshold, 9) >= 0


def two_decimals(x: Column) -> Column:
    """Text with two decimals, rounding the exact binary value, exact ties to even.

    ``format_string`` rounds the shortest decimal text of a double half up, which
    turns 0.125 into 0.13 and 1.005 (a little less in binary) into 1.01.  Where
    ``1000 * x`` is next to a tie, split multiplication gives the exact distance
    and so the side of the tie the binary value lies on.
    """
    tie = F.rint(x * 1000.0)
    big = x * 134217729.0  # 2^27 + 1 splits a double into two 26-bit halves
    hi = big - (big - x)
    distance = (hi * 1000.0 - tie) + (x - hi) * 1000.0
    near = (F.pmod(tie, F.lit(10.0)) == 5.0) & (F.abs(distance) < 1e-6)
    below = F.floor(tie / 10.0)
    up = F.when(distance > 0, 1).when(distance < 0, 0).otherwise(F.pmod(below, F.lit(2)))
    # format_string prints the word null for NULL
    return F.when(x.isNotNull(), F.format_string("%.2f", F.when(near, (below + up) / 100.0).otherwise(x)))
