"""File writers, one format per dataset.  Each writes a new folder of part files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.sources.avro import stringify_all, write_avro

# Output formats in the order they are dealt to datasets.
FORMATS = ("csv", "parquet", "json", "avro")


def assign_formats(names: Sequence[str]) -> dict[str, str]:
    """Deal the formats to the datasets in turn."""
    return {name: FORMATS[i % len(FORMATS)] for i, name in enumerate(names)}


def dates_to_epoch_ms(df: DataFrame) -> DataFrame:
    """Dates and timestamps as epoch milliseconds, as the ndjson files carry them."""
    def plain(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            c = F.unix_date(c).cast("bigint") * 86_400_000
        elif isinstance(field.dataType, T.TimestampType):
            c = F.unix_millis(c)
        return c.alias(field.name)
    return df.select(*(plain(f) for f in df.schema.fields))


def write_csv_gz(df: DataFrame, path: str) -> None:
    stringify_all(df).write.csv(path, header=True, compression="gzip", escape='"')


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.parquet(path, compression="snappy")


def write_json(df: DataFrame, path: str, compression: str | None = None) -> None:
    dates_to_epoch_ms(df).write.json(path, compression=compression, ignoreNullFields=False)


def write_json_gz(df: DataFrame, path: str) -> None:
    write_json(df, path, compression="gzip")


WRITERS = {"csv": write_csv_gz, "csv.gz": write_csv_gz, "parquet": write_parquet,
           "json": write_json, "json.gz": write_json_gz, "avro": write_avro}


def write_one(df: DataFrame, path: str, fmt: str) -> None:
    if fmt not in WRITERS:
        raise ValueError(f"unknown format {fmt!r}; known formats: {sorted(WRITERS)}")
    WRITERS[fmt](df, path)
