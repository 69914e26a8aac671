"""Session defaults for running the library."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Each of these is a runtime-tunable Spark setting.  AQE turns the shuffle width
# into a starting point only: partitions are merged up to the advisory size and
# skewed join partitions are split, so the same settings serve 1 GB and 100 TB.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def get_spark(app_name: str = "medallion", master: str | None = None,
              input_bytes: int | None = None, **conf: object) -> SparkSession:
    """Build (or reuse) a session with the library defaults plus ``conf``.

    ``input_bytes``, the size of the largest input, sets how many shuffle
    partitions AQE starts from: it can merge partitions but not add any.
    ``conf`` keys use double underscores for dots:
    ``get_spark(spark__sql__shuffle__partitions=4000)``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    if input_bytes is not None:
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum",
                                 str(shuffle_width(input_bytes)))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def shuffle_width(input_bytes: int, bytes_per_task: int = 128 << 20,
                  floor: int = 8) -> int:
    """Shuffle partitions so that one task handles about ``bytes_per_task``."""
    return max(floor, -(-input_bytes // bytes_per_task))


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``.  A
    machine-local folder is used only in local mode and only when that is unset.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.mkdtemp(prefix=f"{purpose}-")


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries run meanwhile remove their shuffle files when they are done, not when the
    driver next collects garbage.  The setting is the session's."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def settle(df: DataFrame, purpose: str = "settled") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    For results that several branches of one plan need: the branches read the
    stored rows, so the input behind them is scanned once, a lost executor costs
    a re-read and not a recomputation, and the planner knows the true size.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path, mode="overwrite")
    return df.sparkSession.read.schema(df.schema).parquet(path)
