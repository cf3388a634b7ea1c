"""Rounding that does not depend on summation order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Digits kept beyond the wanted scale before the final rounding.
GUARD_DIGITS = 6


def stable_round(value: Column, scale: int) -> Column:
    """Half-up rounding after dropping floating-point noise.

    A distributed sum of doubles differs in its last bits with the merge order;
    rounding it directly lets 12.35 become 12.3 or 12.4 from run to run.
    """
    return F.round(F.round(value, scale + GUARD_DIGITS), scale)
