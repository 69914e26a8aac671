"""Small-file operations on whatever file system the path belongs to.

Only metadata goes through here: existence, sizes, version markers, manifests.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def size_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files below a folder."""
    fs, where = _at(spark, path)
    return fs.getContentSummary(where).getLength()


def mean_file_bytes(spark: SparkSession, path: str) -> float:
    """Average size of the files at or below a path."""
    fs, where = _at(spark, path)
    summary = fs.getContentSummary(where)
    return summary.getLength() / max(summary.getFileCount(), 1)


def names(spark: SparkSession, folder: str) -> list[str]:
    fs, where = _at(spark, folder)
    if not fs.exists(where):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(where))


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as tasks need it."""
    fs, where = _at(spark, path)
    return fs.makeQualified(where).toString()


def make_folder(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.mkdirs(where)


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, where = _at(spark, source)
    if not fs.rename(where, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"could not move {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, False)


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _at(spark, path)
    stream = fs.open(where)
    try:
        data = spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)
    finally:
        stream.close()
    return bytes(data).decode("utf-8")


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool) -> None:
    """Write a small file; without ``overwrite`` an existing one is an error."""
    fs, where = _at(spark, path)
    stream = fs.create(where, overwrite)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
