"""Files -> bronze tables, with a manifest of what was loaded."""

from __future__ import annotations

import datetime as dt
import json
import logging
import uuid
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.plans.cleaning import clean
from medallion.sources import storage
from medallion.sources.lake import Lake
from medallion.sources.readers import reader_for
from medallion.specs import SOURCES, SourceSpec

log = logging.getLogger(__name__)

# Datasets are independent: several are in flight so that the tail of one load
# does not leave executors idle.
PARALLEL_JOBS = 4

MANIFEST_SCHEMA = ("dataset_name string, row_count bigint, file_size_bytes bigint, "
                   "ingestion_timestamp string, source_format string")


@dataclass(frozen=True)
class ManifestEntry:
    dataset_name: str
    row_count: int
    file_size_bytes: int
    ingestion_timestamp: str
    source_format: str


def ingest_dataset(spark: SparkSession, source: SourceSpec, path: str,
                   lake: Lake) -> ManifestEntry | None:
    """Load one file as the next bronze version; None (and a log entry) on failure.

    Spark reads lazily, so a corrupt file fails in the write: both are guarded.
    """
    try:
        frame = reader_for(source.format)(spark, path, source.schema)
        snapshot = lake.write(frame, "bronze", source.name)
        return ManifestEntry(
            source.name, snapshot.row_count, storage.size_bytes(spark, path),
            dt.datetime.now(dt.timezone.utc).isoformat(), source.format)
    except Exception:
        log.exception("ingest failed for %s (%s)", source.name, path)
        return None


def resolve(spark: SparkSession, data_dir: str, datasets: Iterable[str] | None = None,
            sources: Mapping[str, SourceSpec] = SOURCES) -> dict[str, str]:
    """Paths of the wanted datasets; every problem is reported before any work."""
    if not storage.exists(spark, data_dir):
        raise FileNotFoundError(f"data folder {data_dir} does not exist")
    wanted = list(sources if datasets is None else datasets)
    unknown = sorted(set(wanted) - set(sources))
    if unknown:
        raise ValueError(f"unknown datasets {unknown}; known: {sorted(sources)}")
    paths = {n: f"{data_dir.rstrip('/')}/{sources[n].file}" for n in wanted}
    missing = [p for p in paths.values() if not storage.exists(spark, p)]
    if missing:
        raise FileNotFoundError(f"missing source files: {missing}")
    return paths


def ingest(spark: SparkSession, data_dir: str, lake: Lake,
           datasets: Iterable[str] | None = None,
           sources: Mapping[str, SourceSpec] = SOURCES) -> list[str]:
    """Load the datasets; returns the names that failed, empty when complete.

    One failing dataset does not stop the others.  The manifest keeps the entries
    of datasets that were not part of this run, and names those whose latest load
    failed.
    """
    paths = resolve(spark, data_dir, datasets, sources)
    with ThreadPoolExecutor(PARALLEL_JOBS) as pool:
        loaded = pool.map(
            lambda n: ingest_dataset(spark, sources[n], paths[n], lake), paths)
        entries = {e.dataset_name: asdict(e) for e in loaded if e is not None}
    failed = sorted(set(paths) - set(entries))
    _publish(spark, lake, entries, failed)
    return failed


def _publish(spark: SparkSession, lake: Lake, entries: dict[str, dict],
             failed: list[str]) -> None:
    """Add a numbered manifest; of two runs at once the later builds on the earlier.

    The file is written aside and renamed, and a rename onto an existing file fails, so
    no reader sees half a manifest and no run's entries are lost.
    """
    folder = _manifest_folder(lake)
    storage.make_folder(spark, folder)
    for _ in range(100):
        number, before = _latest(spark, lake)
        manifest = {
            "entries": {**before["entries"], **entries},
            "failed": sorted((set(before["failed"]) - set(entries)) | set(failed))}
        aside = f"{folder}/.{uuid.uuid4().hex}"
        storage.write_text(spark, aside, json.dumps(manifest, indent=2), overwrite=False)
        try:
            storage.move(spark, aside, f"{folder}/{number + 1:06d}.json")
            return
        except OSError:
            storage.remove(spark, aside)
    raise OSError(f"the manifest in {folder} keeps changing")


def _manifest_folder(lake: Lake) -> str:
    return f"{lake.root}/bronze/_manifest"


def _latest(spark: SparkSession, lake: Lake) -> tuple[int, dict]:
    folder = _manifest_folder(lake)
    numbers = [int(n.removesuffix(".json")) for n in storage.names(spark, folder)
               if n.endswith(".json") and not n.startswith(".")]
    if not numbers:
        return -1, {"entries": {}, "failed": []}
    number = max(numbers)
    return number, json.loads(storage.read_text(spark, f"{folder}/{number:06d}.json"))


def read_manifest(spark: SparkSession, lake: Lake) -> dict[str, dict]:
    return _latest(spark, lake)[1]["entries"]


def manifest_frame(spark: SparkSession, lake: Lake) -> DataFrame:
    """The manifest as a DataFrame; one row per dataset ever loaded."""
    entries = read_manifest(spark, lake).values()
    order = [f.split()[0] for f in MANIFEST_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(e[c] for c in order) for e in entries],
                                 MANIFEST_SCHEMA)


def missing_datasets(spark: SparkSession, lake: Lake,
                     expected: Iterable[str] = SOURCES) -> DataFrame:
    """Expected datasets that were never loaded or whose latest load failed."""
    names = spark.createDataFrame([(n,) for n in expected], "dataset_name string")
    failed = _latest(spark, lake)[1]["failed"]
    loaded = manifest_frame(spark, lake).where(~F.col("dataset_name").isin(failed))
    return names.join(loaded, "dataset_name", "left_anti")


def build_silver(lake: Lake, datasets: Iterable[str] = SOURCES) -> dict[str, int]:
    """Clean each bronze table into the next silver version; returns row counts."""
    names = list(datasets)
    with ThreadPoolExecutor(PARALLEL_JOBS) as pool:
        done = pool.map(lambda n: lake.write(clean(lake.read("bronze", n)), "silver", n), names)
        return {n: snapshot.row_count for n, snapshot in zip(names, done)}
