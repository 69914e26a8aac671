"""Versioned tables: every write is a new immutable snapshot.

``<root>/<layer>/<table>/v000003/`` holds the data and
``_versions/000003`` makes it visible.  A write that fails leaves no marker, a
reader never sees half a table, and overwriting a table that is being read is
safe because the old snapshot stays.  Creating the marker fails if it exists, so
of two concurrent writers of one version one gets an error.

A table can be written in the order of a column.  Its files then hold separate ranges, and
``<root>/<layer>/<table>/_zones/000003`` keeps each file's smallest and largest value, so
that a range of the column is read from the files that can hold it, and its bounds and row
counts are known without reading data.

A version can also be appended to: the next one is made of the folders of the version
before and one more, and ``added`` reads what came since an earlier version alone.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from medallion.operators.selection import between_inclusive
from medallion.sources import storage


@dataclass(frozen=True)
class Snapshot:
    """One version: its rows, the folders that hold them (oldest first), the column that
    orders the files, the buckets (column and number), and what the writer noted."""

    version: int
    row_count: int
    paths: tuple[str, ...]
    sorted_by: str | None = None
    buckets: tuple[str, int] | None = None
    made_from: dict[str, int] = field(default_factory=dict)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


class Lake:
    """Tables under one root folder, addressed by layer and name."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _table(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def versions(self, layer: str, name: str) -> list[int]:
        return sorted(int(n) for n in
                      storage.names(self.spark, f"{self._table(layer, name)}/_versions"))

    def write(self, df: DataFrame, layer: str, name: str, sort_by: str | None = None,
              files: int | None = None, buckets: tuple[str, int] | None = None,
              made_from: dict[str, int] | None = None) -> Snapshot:
        """Publish ``df`` as the next version; rows are counted by the write itself.

        ``sort_by`` deals the rows into files by ranges of that column; how many is left
        to Spark unless ``files`` says.  ``buckets`` (column, number) deals them by hash, so
        that joins and groupings on the column need no exchange; not for a column with a
        dominant value, which would fill one bucket.  ``made_from`` notes input versions.
        """
        if sort_by is not None and buckets is not None:
            raise ValueError("a table is dealt by ranges or by buckets, not both")
        version = self._next(layer, name)
        if buckets is None:
            count, path = self._store(df, layer, name, version, sort_by, files)
        else:
            count, path = self._store_buckets(df, layer, name, version, buckets)
        return self._publish(layer, name, Snapshot(
            version, count, (path,), sort_by, buckets, made_from or {}))

    def append(self, df: DataFrame, layer: str, name: str) -> Snapshot:
        """Publish the latest version plus the rows of ``df``; only these are written."""
        last, version = self.snapshot(layer, name), self._next(layer, name)
        if last.buckets is not None:
            raise ValueError(f"{layer}.{name} is bucketed and cannot be appended to")
        count, path = self._store(df, layer, name, version, last.sorted_by, None)
        return self._publish(layer, name, Snapshot(
            version, last.row_count + count, (*last.paths, path), last.sorted_by))

    def _next(self, layer: str, name: str) -> int:
        table = self._table(layer, name)
        folders = [int(n[1:]) for n in storage.names(self.spark, table) if n.startswith("v")]
        return max([*folders, *self.versions(layer, name), -1]) + 1

    def _store(self, df: DataFrame, layer: str, name: str, version: int,
               sort_by: str | None, files: int | None) -> tuple[int, str]:
        path = f"{self._table(layer, name)}/v{version:06d}"
        if sort_by is not None:
            df = df.repartitionByRange(*([files] if files else []), F.col(sort_by))
            df = df.sortWithinPartitions(sort_by)
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
        if sort_by is not None:
            zones = self.spark.read.parquet(path).groupBy(
                F.col("_metadata.file_name").alias("file")).agg(
                F.min(sort_by).alias("low"), F.max(sort_by).alias("high"),
                F.count(F.lit(1)).alias("rows"))
            zones.write.parquet(self._zones(layer, name, version))
        return seen.get["rows"], path

    def _store_buckets(self, df: DataFrame, layer: str, name: str, version: int,
                       buckets: tuple[str, int]) -> tuple[int, str]:
        path, (column, number) = f"{self._table(layer, name)}/v{version:06d}", buckets
        seen = Observation()
        # dealt as the buckets are: one file per bucket
        dealt = df.repartition(number, F.col(column)).observe(
            seen, F.count(F.lit(1)).alias("rows"))
        dealt.write.bucketBy(number, column).sortBy(column).option("path", path).format(
            "parquet").saveAsTable(self._catalog_name(path))
        return seen.get["rows"], path

    @staticmethod
    def _catalog_name(path: str) -> str:
        """A bucketed folder is read through the session's catalog, which holds its layout."""
        return f"lake_{hashlib.md5(path.encode()).hexdigest()}"

    def _bucketed(self, snapshot: Snapshot) -> DataFrame:
        path, (column, number) = snapshot.paths[0], snapshot.buckets
        name = self._catalog_name(path)
        if not self.spark.catalog.tableExists(name):  # written by another session
            schema = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}"
                               for f in self.spark.read.parquet(path).schema.fields)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet "
                f"CLUSTERED BY ({_quoted(column)}) SORTED BY ({_quoted(column)}) "
                f"INTO {number} BUCKETS LOCATION '{path}'")
        return self.spark.table(name)

    def _zones(self, layer: str, name: str, version: int) -> str:
        return f"{self._table(layer, name)}/_zones/{version:06d}"

    def _publish(self, layer: str, name: str, snapshot: Snapshot) -> Snapshot:
        marker = {"row_count": snapshot.row_count, "sorted_by": snapshot.sorted_by,
                  "buckets": snapshot.buckets, "made_from": snapshot.made_from,
                  "folders": [p.rsplit("/", 1)[1] for p in snapshot.paths]}
        storage.write_text(
            self.spark, f"{self._table(layer, name)}/_versions/{snapshot.version:06d}",
            json.dumps(marker), overwrite=False)
        return snapshot

    def snapshot(self, layer: str, name: str, version: int | None = None) -> Snapshot:
        known = self.versions(layer, name)
        if not known:
            raise LookupError(f"no table {layer}.{name} under {self.root}")
        wanted = known[-1] if version is None else version
        if wanted not in known:
            raise LookupError(f"{layer}.{name} has no version {wanted}; versions: {known}")
        table = self._table(layer, name)
        meta = json.loads(storage.read_text(self.spark, f"{table}/_versions/{wanted:06d}"))
        folders = meta.get("folders", [f"v{wanted:06d}"])
        return Snapshot(wanted, meta["row_count"], tuple(f"{table}/{f}" for f in folders),
                        meta.get("sorted_by"),
                        tuple(meta["buckets"]) if meta.get("buckets") else None,
                        meta.get("made_from") or {})

    def read(self, layer: str, name: str, version: int | None = None) -> DataFrame:
        """The latest version, or an earlier one by number (0 is the first)."""
        snapshot = self.snapshot(layer, name, version)
        if snapshot.buckets is not None:
            return self._bucketed(snapshot)
        return self.spark.read.parquet(*snapshot.paths)

    def added(self, layer: str, name: str, since: int,
              version: int | None = None) -> DataFrame | None:
        """The rows that appends brought after version ``since``; None when the table was
        written anew in between, so that a difference says nothing."""
        new, old = self.snapshot(layer, name, version), self.snapshot(layer, name, since)
        if new.paths[:len(old.paths)] != old.paths:
            return None
        more = new.paths[len(old.paths):]
        return (self.spark.read.parquet(*more) if more
                else self.spark.read.parquet(*new.paths).where("false"))

    def zones(self, layer: str, name: str, version: int | None = None) -> DataFrame:
        """``folder``, ``file``, ``low``, ``high`` and ``rows`` of each file of a table
        that was written in order."""
        snapshot = self.snapshot(layer, name, version)
        if snapshot.sorted_by is None:
            raise LookupError(f"{layer}.{name} was not written in the order of a column")
        folders = [p.rsplit("/", 1)[1] for p in snapshot.paths]
        return reduce(DataFrame.unionByName, (
            self.spark.read.parquet(self._zones(layer, name, int(f[1:]))).select(
                F.lit(f).alias("folder"), "*") for f in folders))

    def bounds(self, layer: str, name: str, version: int | None = None) -> DataFrame:
        """One row ``low``, ``high``, ``rows`` of the ordering column, from the zones alone."""
        return self.zones(layer, name, version).agg(
            F.min("low").alias("low"), F.max("high").alias("high"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))

    def read_range(self, layer: str, name: str, low: object | None = None,
                   high: object | None = None, version: int | None = None) -> DataFrame:
        """Rows whose ordering column lies in a closed range (an open end is no bound; NULL
        is in no range).  Only files that can hold such rows are opened: their names, which
        the range bounds, are looked up in the zones first."""
        snapshot, zones = self.snapshot(layer, name, version), self.zones(layer, name, version)
        keep = F.col("low").isNotNull()
        if low is not None:
            keep = keep & (F.col("high") >= F.lit(low))
        if high is not None:
            keep = keep & (F.col("low") <= F.lit(high))
        table = self._table(layer, name)
        files = [f"{table}/{r['folder']}/{r['file']}"
                 for r in zones.where(keep).select("folder", "file").toLocalIterator()]
        whole = self.spark.read.parquet(*snapshot.paths)
        if not files:
            return whole.where("false")
        rows = self.spark.read.schema(whole.schema).parquet(*files)
        return between_inclusive(rows, snapshot.sorted_by, low, high)

    def register(self, layer: str, name: str) -> None:
        """Make the latest version queryable in SQL under its table name."""
        self.read(layer, name).createOrReplaceTempView(name)
