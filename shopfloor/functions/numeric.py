"""Numeric helpers that make results independent of evaluation order and engine.

* ``round2``: rounding a binary double at a decimal tie is engine-specific
  (``12.345`` is stored as 12.34499999…).  Passing through a 10-place decimal
  first snaps such values to their decimal meaning, then rounds half-up.
* ``sum_exact``: a double SUM depends on the order partial sums are combined
  in, i.e. on partitioning.  Summing ``decimal(28,10)`` is exact and therefore
  identical for every partitioning and retry.
* ``avg_exact``: AVG of a DECIMAL column rounded half-up to 6 places, as
  double.  Written as SUM / COUNT in decimal arithmetic: Spark's optimizer
  evaluates ``avg`` of a small-precision decimal as a floating-point mean of
  unscaled values, which rounds exact ties (e.g. 94.2276875) the wrong way.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(38,10)"
SUM_INPUT = "decimal(28,10)"
PLAIN_BELOW, NEAR_TIE = 1e6, 1e-6  # where hundredths of a double are sure of their side of a tie


def round2(col: Column) -> Column:
    """Round half-up to 2 decimals on the decimal value of ``col``; double out.

    NaN becomes NULL.  Infinity and values beyond decimal(38,10) are rounded as
    doubles; they stay visible and never turn into NULL.  Decimal arithmetic, which is slow, is
    for values near a tie alone: elsewhere no error of the multiplication (below 1e-8 for
    these values) nor the rounding to 10 places (5e-9 of a hundredth) reaches another hundredth, and the
    nearest one divided by 100 is the double of that decimal.
    """
    value = col.cast("double")
    hundredths = value * 100.0
    plain = (F.abs(value) < PLAIN_BELOW) & (F.abs(F.abs(hundredths - F.rint(hundredths)) - 0.5) > NEAR_TIE)
    exact = F.round(col.try_cast(EXACT), 2).cast("double")
    beyond = F.when(~F.isnan(value), F.round(value, 2))
    return F.when(plain, F.rint(hundredths) / 100.0 + 0.0).otherwise(F.coalesce(exact, beyond))  # + 0.0: no negative zero


def sum_exact(col: Column) -> Column:
    """Order-independent SUM of a double column (exact to 10 places).

    If any value does not fit the exact type (Infinity, NaN, 1e18 and more), the
    plain double sum of all values is returned, so that none is left out.
    """
    exact = col.try_cast(SUM_INPUT)
    unfit = F.max(F.when(col.isNotNull() & exact.isNull(), F.lit(True)))
    return F.when(unfit.isNull(), F.sum(exact).cast("double")).otherwise(F.sum(col.cast("double")))


def avg_exact(col: Column, scale: int = 6) -> Column:
    """Mean of a DECIMAL column (NULLs skipped), half-up to ``scale`` places, double out.

    SUM of a decimal is exact, and decimal division keeps 20+ fractional
    digits, so the final rounding sees the true mean; NULL when no values.
    """
    return F.round(F.try_divide(F.sum(col), F.count(col)), scale).cast("double")


def clamp_negative(col: Column) -> Column:
    """Negative → 0, NULL stays NULL, type preserved."""
    return F.when(col < 0, F.lit(0).cast("int")).otherwise(col)


def nan_to_null(col: Column) -> Column:
    """Text ``NaN`` in a double column becomes NULL (NaN compares greater than every number)."""
    return F.nanvl(col, F.lit(None).cast("double"))
