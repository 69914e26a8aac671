"""Avro files whose fields are all nullable strings.

Spark's own Avro source is used when its module is on the class path.  Without it,
files are read through Hadoop's Avro text input format, whose JSON lines are stored
(gzipped) in the scratch folder and parsed by Spark, all in the JVM; writing needs the module.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.session import scratch_dir


def has_avro_module(spark: SparkSession) -> bool:
    try:
        spark.read.format("avro").schema("probe string").load([])
        return True
    except AnalysisException:
        return False


def _number_text(x: Column) -> Column:
    """A double in plain digits where the sources write it so; NaN is a missing value."""
    size = F.abs(x)
    digits = F.regexp_replace(x.cast("decimal(38,18)").cast("string"), "0+$", "")
    plain = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    wants_plain = ((size >= 1e7) & (size < 1e16)) | ((size >= 1e-4) & (size < 1e-3))
    return F.when(~F.isnan(x), F.when(wants_plain, plain).otherwise(x.cast("string")))


def stringify_all(df: DataFrame) -> DataFrame:
    """Every column as text, NULL kept; booleans read ``True`` and ``False``."""
    def text(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.BooleanType):
            c = F.initcap(c.cast("string"))
        elif isinstance(field.dataType, T.DoubleType):
            c = _number_text(c)
        return c.cast("string").alias(field.name)
    return df.select(*(text(f) for f in df.schema.fields))


def read_avro(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if has_avro_module(spark):
        return spark.read.schema(schema).format("avro").load(path)
    jvm, lines = spark._jvm, scratch_dir(spark, "avro-lines")
    loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
    reader, text, gzip = (loader.loadClass(n) for n in (
        "org.apache.avro.mapred.AvroAsTextInputFormat", "org.apache.hadoop.io.Text",
        "org.apache.hadoop.io.compress.GzipCodec"))
    spark.sparkContext._jsc.hadoopFile(path, reader, text, text).keys().saveAsTextFile(lines, gzip)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(lines)


def write_avro(df: DataFrame, path: str) -> None:
    """Write ``df`` as all-string Avro into the new folder ``path``."""
    if not has_avro_module(df.sparkSession):
        raise RuntimeError("writing Avro needs Spark's Avro module: start the session with "
                           "the package org.apache.spark:spark-avro")
    stringify_all(df).write.format("avro").save(path)
