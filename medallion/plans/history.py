"""Payment history: every payment numbered per beneficiary, newest first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.operators import number_rows


def payment_rank(payments: DataFrame, hot_rows: int = 5_000_000) -> DataFrame:
    return number_rows(
        payments.select("payment_id", "beneficiary_id", "payment_date", "amount"),
        ["beneficiary_id"], "payment_date", "payment_id", "payment_rank", hot_rows)


def payment_rank_top(payments: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` payments by beneficiary and rank."""
    return payment_rank(payments).orderBy(
        F.col("beneficiary_id").asc_nulls_last(), "payment_rank").limit(n)
