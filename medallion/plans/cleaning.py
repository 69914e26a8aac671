"""Bronze -> silver: blanks to NULL, types by column name, duplicate rows out.

All expressions sit in one ``select``.  Rows are made comparable before they
are compared, so two rows that differ only in ``''`` against NULL are one row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.functions import blank_to_null, epoch_ms_to_date, epoch_ms_to_timestamp, round_n
from medallion.operators import distinct_by_digest

# The name patterns that decide a column's silver type.
DATE_SUFFIXES = ("_date", "_verification")
TYPE_BY_NAME = {
    "last_updated": "timestamp",
    "is_eligible": "boolean",
    "is_disabled": "boolean",
    "is_unaccompanied_minor": "boolean",
    "has_disability": "boolean",
    "quantity": "int",
    "reorder_level": "int",
    "metric_value": "int",
    "amount": "bigint",
    "poverty_score": "double",
    "vulnerability_score": "double",
    "amount_committed": "double",
    "amount_disbursed": "double",
    "amount_usd": "double",
    "amount_pkr": "double",
}


def silver_type(column: str) -> str | None:
    """Target type for a column name, None when the column stays as it is."""
    return "date" if column.endswith(DATE_SUFFIXES) else TYPE_BY_NAME.get(column)


def _clean_column(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    is_text = isinstance(field.dataType, T.StringType)
    if is_text:
        c = blank_to_null(c)
    target = silver_type(field.name)
    if target is None or field.dataType.simpleString() == target:
        return c.alias(field.name)
    is_number = isinstance(field.dataType, T.NumericType)
    if is_number and target == "date":
        c = epoch_ms_to_date(c)
    elif is_number and target == "timestamp":
        c = epoch_ms_to_timestamp(c)
    else:
        if is_text and target in ("int", "bigint"):
            c = c.try_cast("decimal(38,10)")  # "12.0" is a whole number too
        c = c.try_cast(target)
    return c.alias(field.name)


def normalise(df: DataFrame) -> DataFrame:
    """Blank strings to NULL and typed columns; values that do not parse become NULL."""
    return df.select(*(_clean_column(f) for f in df.schema.fields))


def clean(df: DataFrame, by_digest: bool = False) -> DataFrame:
    """The whole cleaning step.  Copies collapse on the map side before the shuffle.

    ``by_digest`` is for wide stored tables with few copies: rows are known by 128 bits
    first, and only those that may be repeated are shuffled whole.  Same rows either way.
    """
    rows = normalise(df)
    return distinct_by_digest(rows) if by_digest else rows.dropDuplicates()


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Columns ``table_name, row_count``, one row per table."""
    frames = [
        df.agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def reconcile(bronze_counts: DataFrame, silver_counts: DataFrame) -> DataFrame:
    """Rows per layer, rows removed, and the removed share in percent."""
    bronze = bronze_counts.withColumnRenamed("row_count", "bronze_rows")
    silver = silver_counts.withColumnRenamed("row_count", "silver_rows")
    removed = F.col("bronze_rows") - F.col("silver_rows")
    return bronze.join(silver, "table_name").select(
        "table_name", "bronze_rows", "silver_rows",
        removed.alias("dedup_delta"),
        round_n(removed / F.nullif("bronze_rows", F.lit(0)) * 100, 2).alias("dedup_pct"))


def invariants(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: what must hold after cleaning (no copies, no blanks, no growth)."""
    blanks = F.lit(0)
    for f in after.schema.fields:
        if isinstance(f.dataType, T.StringType):
            blanks = blanks + F.coalesce((F.col(f"`{f.name}`") == "").cast("int"), F.lit(0))
    distinct = after.groupBy(*(F.col(f"`{c}`") for c in after.columns)).agg(
        F.count(F.lit(1)).alias("_copies"))
    summary = distinct.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows_after"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.sum(blanks * F.col("_copies")), F.lit(0)).alias("blank_strings"))
    rows_before = before.agg(F.count(F.lit(1))).scalar()
    return summary.select(
        rows_before.alias("rows_before"), "rows_after", "duplicate_rows", "blank_strings",
        (F.col("rows_after") <= rows_before).alias("no_growth"))
