"""Small column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Similarities and profile weights are summed as whole numbers of these scales, so that
# totals do not depend on the order in which partitions arrive. A similarity has no lower
# bound, so its scale is that of a double's mantissa: 2^-52 is still an edge.
SCORE_SCALE = 1_000_000_000
EDGE_BITS = 52


def ratio(num: Column, den: Column) -> Column:
    """Double division; null instead of an ANSI error when ``den`` is 0."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def percent(num: Column, den: Column) -> Column:
    return ratio(num, den) * F.lit(100.0).cast("double")


def half_even(col: Column, digits: int = 0) -> Column:
    """Banker's rounding, the rule of Python and numpy."""
    return F.bround(col, digits)


def whole(col: Column) -> Column:
    """Half-even rounding to a long."""
    return F.bround(col, 0).cast("bigint")


def fixed_point(col: Column, scale: int = SCORE_SCALE) -> Column:
    """Non-negative double to a long of ``scale``."""
    return F.floor(col * F.lit(float(scale)) + F.lit(0.5).cast("double")).cast("bigint")


def dbl(value: float) -> Column:
    """A double literal (plain Python floats are already doubles, ints are not)."""
    return F.lit(float(value))


def scalar(df: DataFrame, agg: Column) -> Column:
    """One aggregate over a whole frame as an uncorrelated scalar subquery."""
    return df.agg(agg.alias("v")).scalar()


def checked_k(k: int, low: int = 1, high: int = 20) -> int:
    if not low <= k <= high:
        raise ValueError(f"k must lie in {low}..{high}, got {k}")
    return k
