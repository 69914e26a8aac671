"""Readers, writers, versioned tables and ingestion."""

from __future__ import annotations

import csv
import gzip
import json
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from plans import plan_of

from medallion.sources import ingest as loading
from medallion.sources import readers, storage, writers
from medallion.sources.avro import has_avro_module, read_avro, stringify_all, write_avro
from medallion.sources.lake import Lake
from medallion.specs import SOURCES
from workload import avro_fixture
from workload.avro_fixture import write_avro_files

NAMES = list(SOURCES)


@pytest.fixture(scope="module")
def data_dir(spark, inputs, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sources"))
    for name, source in SOURCES.items():
        avro_fixture.write_one(inputs.entity(name), f"{folder}/{source.file}", source.format)
    return folder


def test_unknown_formats_are_named():
    for pick in (readers.reader_for, lambda f: writers.write_one(None, "x", f)):
        with pytest.raises(ValueError, match="avro.*csv.*json.*parquet"):
            pick("xml")


def test_formats_are_dealt_in_turn():
    assert list(writers.assign_formats("abcdef").values()) == [
        "csv", "parquet", "json", "avro", "csv", "parquet"]


@pytest.mark.parametrize("name", NAMES)
def test_each_source_reads_back_whole(spark, inputs, data_dir, name):
    source = SOURCES[name]
    df = readers.reader_for(source.format)(spark, f"{data_dir}/{source.file}", source.schema)
    assert df.columns == source.schema.names
    assert df.count() == inputs.entity(name).count()
    assert df.where(f"{source.key} is null").count() == 0


def test_csv_quotes_line_breaks_and_blanks(spark, tmp_path):
    path = str(tmp_path / "complaints.csv.gz")
    schema = SOURCES["complaints"].schema
    values = dict.fromkeys(schema.names, "x") | {
        "description": 'said "no",\nthen left', "resolution_date": "", "cnic": "0012"}
    with gzip.open(path, "wt", newline="") as f:
        out = csv.DictWriter(f, schema.names)
        out.writeheader()
        out.writerow(values)
    row = readers.read_csv_gz(spark, path, schema).first()
    assert row.description == 'said "no",\nthen left'
    assert row.resolution_date is None
    assert row.cnic == "0012"


def test_ndjson_keeps_nulls_and_epoch_dates(spark, inputs, data_dir):
    part = next(f for f in os.listdir(f"{data_dir}/surveys.json") if f.endswith(".json"))
    with open(f"{data_dir}/surveys.json/{part}") as f:
        record = json.loads(f.readline())
    assert isinstance(record["survey_date"], int)
    assert set(record) == set(SOURCES["surveys"].schema.names)


def test_avro_edges(spark, tmp_path):
    sizes = (63, 64, 8191, 8192, 1_048_575, 1_048_576)  # where the length code grows
    rows = [("é\"x'\n", None), ("", "a" * 5000), (None, None)]
    rows += [(str(n), "x" * n) for n in sizes] + [(str(i), "v") for i in range(9000)]
    df = spark.createDataFrame(rows, "a string, b string")
    path = str(tmp_path / "t.avro")
    write_avro_files(df.repartition(3), path)
    back = read_avro(spark, path, df.schema)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))
    assert [n for n in storage.names(spark, path) if n.endswith(".avro")] != []
    with pytest.raises(Exception):
        write_avro_files(df, path)


def test_numbers_as_text_read_like_the_source_writes_them(spark):
    values = [0.0, 1.5, -12.25, 9999999.0, 1e7, 12345678.9, -1234567890123.25, 9.9e15,
              0.001, 0.00012, 0.5]
    df = spark.createDataFrame([(v, True) for v in values], "v double, b boolean")
    rows = stringify_all(df).collect()
    assert [r.v for r in rows] == [str(v) for v in values]
    assert {r.b for r in rows} == {"True"}
    huge = spark.createDataFrame([(1e300, True), (float("inf"), True)], "v double, b boolean")
    assert [r.v for r in stringify_all(huge).collect()] == ["1.0E300", "Infinity"]
    missing = spark.createDataFrame([(float("nan"), None), (None, None)], "v double, b boolean")
    assert [tuple(r) for r in stringify_all(missing).collect()] == [(None, None)] * 2


def test_csv_folder_gives_one_table_per_file(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.csv").write_text("k,v\n1,x\n2,\n")
    (tmp_path / "notes.txt").write_text("no table")
    tables = readers.read_csv_dir(spark, str(tmp_path))
    assert {n: t.count() for n, t in tables.items()} == {"a": 2, "b": 2}


# --- versioned tables ---------------------------------------------------------

@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 99), st.integers(0, 99)), min_size=1, max_size=50))
def test_write_read_keeps_rows(spark, lake, rows):
    df = spark.createDataFrame(rows, "id int, value int")
    snapshot = lake.write(df, "bronze", "t")
    assert snapshot.row_count == len(rows)
    assert sorted(map(tuple, lake.read("bronze", "t").collect())) == sorted(rows)


def test_versions_and_time_travel(spark, lake):
    for n in (1, 2, 3):
        assert lake.write(spark.range(n), "bronze", "t").version == n - 1
    assert lake.versions("bronze", "t") == [0, 1, 2]
    assert lake.read("bronze", "t").count() == 3
    assert lake.read("bronze", "t", version=0).count() == 1
    assert lake.snapshot("bronze", "t", 1).row_count == 2
    with pytest.raises(LookupError, match="no version 7"):
        lake.read("bronze", "t", version=7)
    with pytest.raises(LookupError, match="no table"):
        lake.read("bronze", "other")


def test_overwriting_a_table_from_itself(spark, lake):
    lake.write(spark.range(4), "silver", "t")
    lake.write(lake.read("silver", "t").where("id > 1"), "silver", "t")
    assert lake.read("silver", "t").count() == 2


def test_failed_write_stays_invisible(spark, lake):
    lake.write(spark.range(4), "silver", "t")
    bad = spark.range(4).selectExpr("assert_true(id < 2) as x")
    with pytest.raises(Exception):
        lake.write(bad, "silver", "t")
    assert lake.versions("silver", "t") == [0]
    assert lake.write(spark.range(5), "silver", "t").version > 0
    assert lake.read("silver", "t").count() == 5


def test_sql_name(spark, lake):
    lake.write(spark.range(4), "silver", "some_table")
    lake.register("silver", "some_table")
    assert spark.sql("select count(*) n from some_table").first().n == 4


# --- ingestion --------------------------------------------------------------------

def tiny_sources(folder, valid):
    """One ndjson file per dataset; invalid ones hold a broken record."""
    from pyspark.sql import types as T
    from medallion.specs import SourceSpec
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])
    specs = {}
    for i, ok in enumerate(valid):
        name = f"d{i}"
        with open(f"{folder}/{name}.json", "w") as f:
            f.write("".join(json.dumps({"id": n, "v": "x"}) + "\n" for n in range(i + 1)))
            f.write("" if ok else "{broken\n")
        specs[name] = SourceSpec(name, f"{name}.json", "json", "id", schema, "id")
    return specs


@pytest.mark.property
@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.booleans(), min_size=9, max_size=9))
def test_one_failure_does_not_stop_the_rest(spark, tmp_path_factory, valid):
    folder = str(tmp_path_factory.mktemp("mixed"))
    specs = tiny_sources(folder, valid)
    lake = Lake(spark, f"{folder}/lake")
    failed = loading.ingest(spark, folder, lake, sources=specs)
    assert failed == [f"d{i}" for i, ok in enumerate(valid) if not ok]
    manifest = loading.read_manifest(spark, lake)
    assert {n: e["row_count"] for n, e in manifest.items()} == {
        f"d{i}": i + 1 for i, ok in enumerate(valid) if ok}
    missing = loading.missing_datasets(spark, lake, list(specs))
    assert sorted(r.dataset_name for r in missing.collect()) == failed


def test_manifest_has_its_fields_and_true_counts(spark, lake, data_dir):
    assert loading.ingest(spark, data_dir, lake) == []
    rows = {r.dataset_name: r for r in loading.manifest_frame(spark, lake).collect()}
    assert set(rows) == set(NAMES)
    for name, row in rows.items():
        assert row.row_count == lake.read("bronze", name).count()
        assert row.source_format == SOURCES[name].format
        assert row.file_size_bytes == storage.size_bytes(spark, f"{data_dir}/{SOURCES[name].file}")
        assert row.ingestion_timestamp.endswith("+00:00")


def test_running_twice_equals_running_once(spark, lake, data_dir):
    for _ in range(3):
        loading.ingest(spark, data_dir, lake, ["payments"])
    assert list(loading.read_manifest(spark, lake)) == ["payments"]
    assert lake.read("bronze", "payments").count() == 1500
    assert lake.read("bronze", "payments", 0).count() == 1500


def test_single_dataset_keeps_other_manifest_entries(spark, lake, data_dir):
    loading.ingest(spark, data_dir, lake, ["payments", "surveys"])
    before = loading.read_manifest(spark, lake)
    loading.ingest(spark, data_dir, lake, ["surveys"])
    after = loading.read_manifest(spark, lake)
    assert after["payments"] == before["payments"]
    assert after["surveys"]["ingestion_timestamp"] > before["surveys"]["ingestion_timestamp"]


def test_bad_requests_fail_before_any_work(spark, lake, data_dir, tmp_path):
    with pytest.raises(FileNotFoundError, match="does not exist"):
        loading.ingest(spark, str(tmp_path / "nowhere"), lake)
    with pytest.raises(ValueError, match="unknown datasets.*known.*payments"):
        loading.ingest(spark, data_dir, lake, ["payment"])
    with pytest.raises(FileNotFoundError, match="missing source files"):
        loading.ingest(spark, str(tmp_path), lake)
    assert not storage.exists(spark, lake.root)


def test_files_to_gold(spark, lake, data_dir, inputs):
    from medallion.plans.gold import build_gold
    loading.ingest(spark, data_dir, lake)
    counts = loading.build_silver(lake)
    assert set(counts) == set(NAMES)
    versions = build_gold(lake)
    assert set(versions) == {"mart_payment_kpis", "mart_donor_budget_vs_actual",
                             "mart_refugee_assistance_summary", "mart_protection_caseload",
                             "mart_survey_metric_trends"}
    direct = inputs.models["mart_payment_kpis"]
    stored = lake.read("gold", "mart_payment_kpis")
    assert stored.exceptAll(direct).count() == 0 and direct.count() == stored.count()
    assert dict(lake.read("silver", "inventory").dtypes)["last_updated"] == "timestamp"
    assert dict(lake.read("silver", "surveys").dtypes)["survey_date"] == "date"


def test_rows_of_large_gzip_files_are_spread(spark, data_dir):
    source = SOURCES["complaints"]
    path = f"{data_dir}/{source.file}"
    large = readers.read_csv_gz(spark, path, source.schema, spread_above=10)
    small = readers.read_csv_gz(spark, path, source.schema)
    assert "RoundRobinPartitioning" in plan_of(large)
    assert "Exchange" not in plan_of(small)
    assert large.count() == small.count() == 1500


def test_parquet_of_another_shape_is_a_failed_load(spark, lake, data_dir, tmp_path):
    folder = str(tmp_path / "wrong")
    spark.range(3).write.parquet(f"{folder}/{SOURCES['payments'].file}")
    assert loading.ingest(spark, data_dir, lake, ["payments"]) == []
    assert loading.ingest(spark, folder, lake, ["payments"]) == ["payments"]
    missing = loading.missing_datasets(spark, lake, ["payments"])
    assert [r.dataset_name for r in missing.collect()] == ["payments"]
    assert list(loading.read_manifest(spark, lake)) == ["payments"]
    assert loading.ingest(spark, data_dir, lake, ["payments"]) == []
    assert loading.missing_datasets(spark, lake, ["payments"]).count() == 0


def test_csv_folder_keeps_line_breaks_and_rejects_surplus_fields(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "good.csv").write_text('a,b\n1,"two\nlines"\n3,4\n')
    good = readers.read_csv_dir(spark, str(folder))["good"]
    assert [tuple(r) for r in good.collect()] == [("1", "two\nlines"), ("3", "4")]
    (folder / "bad.csv").write_text("a,b\n4,5,6\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        readers.read_csv_dir(spark, str(folder))["bad"].collect()


def test_versions_sort_as_numbers(spark, lake):
    for n in (0, 999_999, 1_000_000):
        storage.write_text(spark, f"{lake.root}/bronze/t/_versions/{n:06d}", "{}", False)
    assert lake.versions("bronze", "t") == [0, 999_999, 1_000_000]


def test_avro_reading_stays_in_the_jvm(spark, inputs, tmp_path):
    path = str(tmp_path / "a")
    write_avro_files(inputs.entity("inventory"), path)
    back = read_avro(spark, path, stringify_all(inputs.entity("inventory")).schema)
    assert "PythonRDD" not in back._jdf.queryExecution().toRdd().toDebugString()


def test_writing_avro_without_the_module_says_so(spark, tmp_path):
    if has_avro_module(spark):
        pytest.skip("the module is present")
    with pytest.raises(RuntimeError, match="Avro module"):
        write_avro(spark.range(1), str(tmp_path / "a"))
