"""Order-independent sums of DOUBLE columns.

A distributed floating-point sum depends on the order in which partial results
arrive, so the same query may rank two donors differently after a task retry.
Here a value is cut into base-1,000,000 digits that are summed as LONGs:

    x = high * 1e12 + mid * 1e6 + low + micro / 1e6 + rest

A value with up to six decimals is taken as that decimal, so ``rest`` is zero and the
sum is exact.  Any other value keeps in ``rest``, a DOUBLE below a millionth, what the
digits leave over: nothing is lost, and only the last bits of a sum of rests can
depend on order.  Digits are below a million, so a group of 9e12 rows cannot
overflow.  NaN, infinities and magnitudes of 1e18 and more are summed apart as DOUBLE.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

PARTS = ("high", "mid", "low", "micro", "rest", "odd")

_LIMIT = 1e18
_BASE = 1_000_000


def exact_parts(c: Column | str, prefix: str) -> list[Column]:
    """Partial sums named ``<prefix>_<part>`` for each of ``PARTS``.

    They may be summed again after a further grouping; ``exact_total`` turns
    the final sums into the total.
    """
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    regular = F.abs(x) < F.lit(_LIMIT)
    whole = F.floor(x)
    micro = F.floor((x - whole) * F.lit(float(_BASE)) + F.lit(0.5))
    # the double next to whole.micro: one exact integer divided once, or, where that integer
    # would be too large, a sum in which nothing cancels
    scaled = (whole.cast("double") * F.lit(float(_BASE)) + micro) / F.lit(float(_BASE))
    decimal = F.when(F.abs(x) < F.lit(9e9), scaled).otherwise(
        whole + micro / F.lit(float(_BASE)))
    rest = F.when(decimal == x, F.lit(0.0)).otherwise(
        (x - whole) - micro / F.lit(float(_BASE)))
    above = F.floor(whole / F.lit(_BASE))
    high = F.floor(above / F.lit(_BASE))
    digits = {"high": high, "mid": above - high * _BASE, "low": whole - above * _BASE,
              "micro": micro, "rest": rest}
    return [
        *(F.sum(F.when(regular, d)).alias(f"{prefix}_{p}") for p, d in digits.items()),
        F.sum(F.when(~regular, x)).alias(f"{prefix}_odd"),
    ]


def exact_total(high: Column, mid: Column, low: Column, micro: Column, rest: Column,
                odd: Column) -> Column:
    """Combine part sums into a DOUBLE; NULL when every input value was NULL."""
    def digit(c: Column, weight: str) -> Column:
        return c.cast("decimal(20,0)") * F.lit(Decimal(weight))

    digits = (digit(high, "1000000000000") + digit(mid, "1000000") + digit(low, "1")
              + digit(micro, "0.000001")).cast("double") + rest
    return F.when(odd.isNull(), digits).otherwise(odd + F.coalesce(digits, F.lit(0.0)))


def exact_sum(c: Column | str) -> Column:
    """``SUM(c)`` as DOUBLE with a result that does not depend on row order."""
    return exact_total(*exact_parts(c, "x"))


def exact_avg(c: Column | str) -> Column:
    """``AVG(c)`` built on ``exact_sum``."""
    x = F.col(c) if isinstance(c, str) else c
    return exact_sum(x) / F.nullif(F.count(x), F.lit(0))
