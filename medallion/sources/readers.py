"""File readers.  Schemas are given, never inferred; corrupt input is an error."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from medallion.sources import storage
from medallion.sources.avro import read_avro

Reader = Callable[[SparkSession, str, T.StructType], DataFrame]


def read_csv_gz(spark: SparkSession, path: str, schema: T.StructType,
                spread_above: int = 64 << 20) -> DataFrame:
    """Gzip CSV with a header.

    Gzip cannot be split, so a file is one task.  Rows of large files are spread
    by a rebalance before any further work; many small files are left as they
    are, which saves the shuffle.  As a file is one task anyway, quoted line
    breaks are allowed.
    """
    raw = spark.read.schema(schema).csv(
        path, header=True, multiLine=True, quote='"', escape='"',
        enforceSchema=False, mode="FAILFAST")
    large = storage.mean_file_bytes(spark, path) > spread_above
    return raw.hint("rebalance") if large else raw


def read_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet carries its own schema; other names or types than expected are an error."""
    frame = spark.read.parquet(path)
    found = {f.name: f.dataType.simpleString() for f in frame.schema.fields}
    wanted = {f.name: f.dataType.simpleString() for f in schema.fields}
    if found != wanted:
        wrong = sorted(n for n in {*found, *wanted} if found.get(n) != wanted.get(n))
        raise ValueError(f"{path}: columns {wrong} are not as declared")
    return frame


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Newline-delimited JSON."""
    return spark.read.schema(schema).json(path, mode="FAILFAST")


READERS: dict[str, Reader] = {
    "csv.gz": read_csv_gz,
    "parquet": read_parquet,
    "json": read_json,
    "avro": read_avro,
}


def reader_for(fmt: str) -> Reader:
    if fmt not in READERS:
        raise ValueError(f"unknown format {fmt!r}; known formats: {sorted(READERS)}")
    return READERS[fmt]


def read_csv_dir(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Every ``*.csv`` in a folder, keyed by file name; columns as text.

    Quoted line breaks stay in their field; a row with other than the header's number of
    fields is an error.
    """
    return {
        name[:-len(".csv")]: spark.read.csv(
            f"{folder}/{name}", header=True, multiLine=True, quote='"', escape='"',
            mode="FAILFAST")
        for name in storage.names(spark, folder) if name.endswith(".csv")
    }
