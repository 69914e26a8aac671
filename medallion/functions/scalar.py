"""Scalar expressions.  All are built-in Spark functions, so they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MS_PER_DAY = 86_400_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """Empty string becomes NULL; whitespace is kept."""
    return F.nullif(_col(c), F.lit(""))


def safe_ratio(num: Column | str, den: Column | str, scale: float = 1.0) -> Column:
    """``num / den * scale`` as DOUBLE, NULL when the denominator is zero."""
    ratio = _col(num).cast("double") / F.nullif(_col(den).cast("double"), F.lit(0.0))
    return ratio if scale == 1.0 else ratio * F.lit(float(scale))


def rate_of(predicate: Column) -> Column:
    """Share of rows in the group for which the predicate is true."""
    return safe_ratio(F.count_if(predicate), F.count(F.lit(1)))


def round_n(c: Column | str, n: int) -> Column:
    """Round half away from zero on the *scaled* double.

    ``round(double, n)`` in Spark works on the printed decimal and differs from
    SQL engines that scale in binary; scaling first agrees with those.
    """
    k = F.lit(float(10 ** n))
    return F.round(_col(c).cast("double") * k) / k


def month_of(d: Column | str) -> Column:
    """First day of the month, as DATE."""
    return F.trunc(_col(d), "month")


def days_between(start: Column | str, end: Column | str) -> Column:
    """Whole days from ``start`` to ``end`` (negative when end is earlier)."""
    return F.datediff(_col(end), _col(start)).cast("bigint")


def epoch_ms_to_date(ms: Column | str) -> Column:
    """UTC calendar day of an epoch-millisecond number, whatever the session zone.

    NULL for what is no day of the years 1 to 9999, NaN and infinities included.
    """
    day = _col(ms) / F.lit(MS_PER_DAY)
    known = (day >= F.lit(-719_162)) & (day < F.lit(2_932_897))
    return F.when(known, F.date_from_unix_date(F.floor(day).cast("int")))


def epoch_ms_to_timestamp(ms: Column | str) -> Column:
    """The instant; NULL outside the years 1 to 9999, NaN and infinities included."""
    known = (_col(ms) >= F.lit(-62_135_596_800_000)) & (_col(ms) < F.lit(253_402_300_800_000))
    return F.when(known, F.timestamp_millis(_col(ms).cast("bigint")))


def percent_text(fraction: Column | str) -> Column:
    """0.873 -> ``87%`` (ties to even)."""
    return F.concat(F.rint(_col(fraction) * 100).cast("bigint").cast("string"), F.lit("%"))
