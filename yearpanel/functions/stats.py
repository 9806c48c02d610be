"""Aggregate expressions that stay defined on degenerate groups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Decimals of a figure that are added as whole numbers.
EXACT_DECIMALS = 6
#: Exponents of two: figures below the first have no high part, figures from the second on are not
#: split, and the third is the unit of the fine part.
HIGH_UNIT, SPLIT, FINE_UNIT = 32, 84, 80
#: Bits of a limb that whole numbers are added in, and the limbs of a number of millionths.
LIMB_BITS, LIMBS = 18, 3


def exact_sum(value: Column) -> Column:
    """The sum of doubles, the same in whatever order they are added.

    A figure is split, without rounding, into a multiple of 2 ** 32, a whole number of millionths
    and a fine part in units of 2 ** -80. Each part is added exactly. Figures below 2 ** 32 have
    no high part, and figures with up to six decimals no fine part. Millionths are added in three
    limbs of 18 bits, which fit into longs for 2 ** 45 rows; the other parts as decimals.

    What is finer than 2 ** -80 (no figure from 1e-8 on has such bits), figures from 2 ** 84 on,
    NaN and infinities are added as doubles: nothing is cut. The sum is the exact one but for one
    unit in the last place. All parts combine on the map side. A group without a figure has no sum.
    """
    inside = F.abs(value) < 2.0**SPLIT  # false for NaN, which is larger than all numbers
    high = F.when(inside & (F.abs(value) >= 2.0**HIGH_UNIT), (value / 2.0**HIGH_UNIT).cast("bigint"))
    low = value - F.coalesce(high * 2.0**HIGH_UNIT, F.lit(0.0))
    scale = 10**EXACT_DECIMALS
    whole = F.when(inside, F.rint(low * scale).cast("bigint"))
    rest = low - F.coalesce(whole / scale, F.lit(0.0))
    fine = F.when(inside & (rest != 0), F.rint(rest * 2.0**FINE_UNIT).cast("bigint"))
    left = rest - F.coalesce(fine / 2.0**FINE_UNIT, F.lit(0.0))

    def added(part: Column, digits: int) -> Column:
        return F.coalesce(F.sum(part.cast(f"decimal({digits},0)")), F.lit(0).cast("decimal(28,0)"))

    millionths = F.lit(0).cast("decimal(36,0)")
    for k in range(LIMBS):
        limb = F.shiftright(whole, LIMB_BITS * k)
        if k < LIMBS - 1:  # the last one has the sign
            limb = limb.bitwiseAND((1 << LIMB_BITS) - 1)
        limb = F.coalesce(F.sum(limb), F.lit(0)).cast("decimal(20,0)")
        millionths = millionths + limb * F.lit(1 << LIMB_BITS * k).cast("decimal(11,0)")
    exact = millionths.cast("decimal(32,0)") * F.lit("0.000001").cast("decimal(6,6)")
    highs = added(high, 18) * F.lit(1 << HIGH_UNIT).cast("decimal(10,0)")
    fines = added(fine, 19).cast("double") / 2.0**FINE_UNIT
    return (exact + highs).cast("double") + fines + F.sum(left)


def pearson(x: str, y: str, nulls_as_zero: bool = False) -> Column:
    """Pearson correlation of two columns.

    Rows with a missing side are left out, or count as zero on request. A constant side, a
    single row or no row at all gives null instead of the division error that ``corr`` raises
    in ANSI mode. All three aggregates combine on the map side.
    """
    a, b = F.col(x), F.col(y)
    if nulls_as_zero:
        a, b = F.coalesce(a, F.lit(0.0)), F.coalesce(b, F.lit(0.0))
    else:
        complete = a.isNotNull() & b.isNotNull()
        a, b = F.when(complete, a), F.when(complete, b)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def slope(y: str, x: str) -> Column:
    """Least-squares slope of ``y`` on ``x``; a group of a single row has slope 0."""
    return F.coalesce(F.regr_slope(F.col(y), F.col(x)), F.lit(0.0))
