"""Answers from Parquet footers: counts, smallest and largest values without reading data.

Spark pushes such aggregates into the scan of its second data source interface.  That is a
setting of a session, so tables are read here in a session of their own over the same
context; frames from it can be collected, written or united with each other.  Texts and
timestamps have no usable bounds in a footer: their column, and no other, is scanned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from medallion.sources.lake import Lake

_SOURCES = "spark.sql.sources.useV1SourceList"


def footer_session(spark: SparkSession) -> SparkSession:
    session = spark.newSession()
    others = [s for s in spark.conf.get(_SOURCES).split(",") if s.strip() != "parquet"]
    session.conf.set(_SOURCES, ",".join(others))
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        session.conf.set(key, spark.conf.get(key))
    return session


def tables(lake: Lake, layer: str, names: list[str]) -> dict[str, DataFrame]:
    """The latest versions, read so that ``min``, ``max`` and ``count`` come from footers."""
    session = footer_session(lake.spark)
    return {n: session.read.parquet(*lake.snapshot(layer, n).paths) for n in names}
