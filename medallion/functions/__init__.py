"""Column helpers shared by all plans."""

from medallion.functions.exact import PARTS, exact_avg, exact_parts, exact_sum, exact_total
from medallion.functions.scalar import (
    blank_to_null,
    days_between,
    epoch_ms_to_date,
    epoch_ms_to_timestamp,
    month_of,
    percent_text,
    rate_of,
    round_n,
    safe_ratio,
)

__all__ = [
    "blank_to_null", "days_between", "epoch_ms_to_date", "epoch_ms_to_timestamp",
    "PARTS", "exact_avg", "exact_parts", "exact_sum", "exact_total", "month_of",
    "percent_text", "rate_of", "round_n", "safe_ratio",
]
