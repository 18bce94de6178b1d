"""Order-independent means and half-even rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mean(value: Column) -> Column:
    """Mean over an exact decimal sum.

    A sum of doubles depends on the order in which tasks finish, so a retried
    stage could change a published digit; six decimals hold every measure.
    """
    total = F.sum(value.cast("decimal(18,6)")).cast("double")
    return F.try_divide(total, F.count(value).cast("double"))


def round_even(value: Column, digits: int) -> Column:
    """Round the scaled binary value half to even, as numeric array libraries do."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale
