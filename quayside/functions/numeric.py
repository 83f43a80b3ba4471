"""The two rounding rules and order-independent averages.

* ``round_even``: scale, round half to even, unscale -- what NumPy/pandas ``.round(d)``
  does in the transforms.
* ``round_half_up``: decimal half-away-from-zero -- what the KPI SQL's ``ROUND`` does;
  Spark's ``round`` on a double rounds its decimal representation HALF_UP.
* ``exact_avg``: an average whose value does not depend on summation order. KPI inputs
  are already rounded to ``scale`` decimals, so they are summed as exact integers and
  divided once; every engine and every partitioning gets the same bits.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_even(c: Column, digits: int) -> Column:
    f = float(10 ** digits)
    return F.rint(c * F.lit(f)) / F.lit(f)


def round_half_up(c: Column, digits: int) -> Column:
    return F.round(c, digits)


def exact_avg(c: Column, scale: int = 0) -> Column:
    """Mean of values carrying at most ``scale`` decimals, computed exactly then rounded once."""
    f = 10 ** scale
    units = F.rint(c.cast("double") * F.lit(float(f))).cast("long")
    return F.sum(units).cast("double") / (F.count(c) * F.lit(f)).cast("double")

