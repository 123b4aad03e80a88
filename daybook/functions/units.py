"""Minor units → coins, exactly (X4, §8 Q2).

Amounts are kept as integer minor units (``decimal(38,0)``) while they are
summed and compared; scaling by 10^-n happens once, on results.  Spark's
decimal multiply/divide would drop digits past 6 decimals at precision 38, so
the scale is applied by re-reading the digits with an exponent, which is exact.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

UNITS = DecimalType(38, 0)


def units(c) -> Column:
    """Cast an integer amount to exact minor units."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(UNITS)


def scale_units(c, n: int) -> Column:
    """Exact ``units * 10^-n`` as decimal(38, n); NULL stays NULL."""
    c = F.col(c) if isinstance(c, str) else c
    if n == 0:
        return c.cast(DecimalType(38, 0))
    digits = c.cast(UNITS).cast("string")
    return F.concat(digits, F.lit(f"E-{n}")).cast(DecimalType(38, n))


_EXACT_DOUBLE_INT = 2**53


def units_to_double(c, n: int) -> Column:
    """Double value of ``units * 10^-n`` (the value a median is taken over).

    Below 2^53 the integer converts to double exactly and one IEEE division
    by 10^n (itself exact) is correctly rounded, i.e. equal to converting the
    exact decimal; larger values take the exact decimal path.
    """
    c = F.col(c) if isinstance(c, str) else c
    fast = c.cast("double") / F.lit(float(10**n))
    return F.when(F.abs(c) < F.lit(_EXACT_DOUBLE_INT), fast).otherwise(scale_units(c, n).cast("double"))
