"""Every operator and model of the library, run over the driver's test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.functions import (
    days_between,
    exact_sum,
    month_of,
    rate_of,
    round_n,
    safe_ratio,
)
from medallion.operators import (
    distinct_counts,
    distinct_state,
    distinct_values,
    exact_quantiles,
    histogram,
    histogram_by,
    ntile_global,
    number_values,
    rank_rows,
    value_range,
)
from medallion.plans import cleaning, history, kpis, marts, quality, reports, upkeep
from medallion.plans.gold import SORTED_BY, Models, build_gold
from medallion.session import scratch_dir, settle, shuffles_freed
from medallion.sources import footers, readers, writers
from medallion.sources import ingest as loading
from medallion.sources.avro import read_avro, stringify_all
from medallion.sources.lake import Lake
from medallion.specs import MODELS, SOURCES
from workload import avro_fixture
from workload.bindings import ENTITY_SQL, entity
from workload.oracle import CHECKED, COPIES, FRESH_AS_OF

Query = Callable[[SparkSession, str], DataFrame]


class Inputs:
    """Entities and models over one folder of test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.models = Models(self.entity)
        self._entities: dict[str, DataFrame] = {}

    def entity(self, name: str) -> DataFrame:
        if name not in self._entities:
            self._entities[name] = entity(self.spark, self.sf_dir, name)
        return self._entities[name]

    def stg(self, table: str) -> DataFrame:
        return self.models[f"stg_{table}"]

    def gold(self, name: str) -> DataFrame:
        """A mart as reports see it: written once, then read as a table."""
        lake = self.lake("gold")
        lake.write(self.models[name], "gold", name)
        return lake.read("gold", name)

    def bronze(self, name: str) -> DataFrame:
        """The entity with some of its rows repeated."""
        rows = self.entity(name)
        return rows.unionByName(rows.where(COPIES[name])) if name in COPIES else rows

    def scratch(self, purpose: str) -> str:
        return scratch_dir(self.spark, purpose)

    def lake(self, purpose: str) -> Lake:
        return Lake(self.spark, self.scratch(purpose))


def _settled(df: DataFrame, *columns: str) -> DataFrame:
    """Means of doubles rounded to nine places, below which engines may differ."""
    return df.withColumns({c: round_n(c, 9) for c in columns})


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --- models and KPIs -------------------------------------------------------------

MODEL_KEYS = {
    "stg_beneficiaries": "stg_beneficiaries",
    "stg_payments": "stg_payments",
    "stg_surveys": "stg_surveys",
    "stg_inventory": "stg_inventory",
    "stg_complaints": "stg_complaints",
    "stg_donor_reports": "stg_donor_reports",
    "stg_refugees": "stg_afghan_refugees",
    "stg_assistance": "stg_refugee_assistance",
    "stg_protection": "stg_refugee_protection",
    "int_beneficiaries_payments": "int_beneficiaries_payments",
    "int_refugees_assistance": "int_refugees_assistance",
    "int_donor_program": "int_donor_program_aggregates",
    "int_survey_trends": "int_survey_trends",
    "mart_donor_budget": "mart_donor_budget_vs_actual",
    "mart_refugee_assistance": "mart_refugee_assistance_summary",
    "mart_protection": "mart_protection_caseload",
    "mart_survey_trends": "mart_survey_metric_trends",
}


def _payment_mart(i: Inputs) -> DataFrame:
    return _settled(i.models["mart_payment_kpis"], "rolling_3m_avg_success_rate")


def _hot_place(i: Inputs) -> DataFrame:
    """Inventory with a third of its items in one place, many of them out of stock."""
    hot = F.length("item_name") % 3 == 0
    return i.stg("inventory").withColumns({
        **{c: F.when(hot, "HOT").otherwise(F.col(c)) for c in kpis.PLACE},
        "quantity": F.when(hot, F.col("quantity") % 2).otherwise(F.col("quantity"))})


KPI_KEYS: dict[str, Callable[[Inputs], DataFrame]] = {
    "kpi_budget_vs_actual": lambda i: kpis.budget_vs_actual(i.stg("donor_reports")),
    "kpi_payment_success": lambda i: kpis.payment_success_rates(
        i.stg("payments"), i.stg("beneficiaries")),
    "kpi_vulnerability": lambda i: kpis.refugee_vulnerability(i.stg("afghan_refugees")),
    "kpi_protection": lambda i: kpis.protection_caseload(i.stg("refugee_protection")),
    "kpi_complaint_resolution": lambda i: kpis.complaint_resolution(i.stg("complaints")),
    "kpi_inventory_reorder": lambda i: kpis.inventory_reorder_alerts(i.stg("inventory")),
    "kpi_inventory_reorder_hot_place": lambda i: kpis.inventory_reorder_alerts_in_pieces(
        _hot_place(i), pieces=12),
    "kpi_return_intention": lambda i: kpis.refugee_return_intention(i.stg("afghan_refugees")),
    "kpi_invariants": lambda i: quality.kpi_invariants(
        i.models["mart_donor_budget_vs_actual"], i.models["mart_payment_kpis"],
        kpis.refugee_vulnerability(i.stg("afghan_refugees")),
        i.models["mart_protection_caseload"]),
}


# --- operators ---------------------------------------------------------------------

def _ratio_safe(i: Inputs) -> DataFrame:
    return i.stg("inventory").select(
        "item_id", safe_ratio("reorder_level", "quantity").alias("cover"),
        safe_ratio("reorder_level", "quantity", 100).alias("cover_pct"),
        (F.col("reorder_level") - F.col("quantity")).alias("shortfall"))


def _agg_conditional(i: Inputs) -> DataFrame:
    resolved = F.col("status") == "Resolved"
    return i.stg("complaints").groupBy("district").agg(
        F.count_if(resolved).alias("resolved"),
        F.count_if(~F.col("status").isin("Resolved", "Rejected")).alias("pending"),
        rate_of(resolved).alias("resolved_rate"))


def _agg_exact_sum(i: Inputs) -> DataFrame:
    """Sums of values with more than six decimals."""
    lines = i.spark.read.parquet(f"{i.sf_dir}/lineitem.parquet")
    events = i.spark.read.parquet(f"{i.sf_dir}/events.parquet")

    def total(df: DataFrame, measure: str, part: str, value: Column, places: int) -> DataFrame:
        return df.groupBy(F.col(part).alias("part")).agg(
            round_n(exact_sum(value), places).alias("total")).select(
            F.lit(measure).alias("measure"), "part", "total")

    return _union([
        total(lines, "price", "l_returnflag", F.col("l_extendedprice") / 7, 2),
        total(events, "value", "event_type", F.col("value"), 4),
        total(lines, "tiny", "l_linestatus", F.col("l_quantity") * F.lit(1e-9), 9)])


def _hot_program(i: Inputs) -> DataFrame:
    """Payments with one bank in a third of the rows, and amounts that tie."""
    amount = F.col("amount")
    return i.stg("payments").select(
        "payment_id", F.when(amount % 3 == 0, "HOT").otherwise(F.col("bank_code")).alias("bank"),
        F.when(amount % 7 != 0, F.floor(amount / 500).cast("double")).alias("size"))


def _distinct_refugees(i: Inputs) -> DataFrame:
    """Refugees per district, per programme and in all, from one stored state."""
    rows = i.stg("refugee_assistance")
    numbers = number_values(rows, "refugee_id")
    state = settle(distinct_state(rows, ["host_district", "program"], "refugee_id", numbers))
    def level(name: str, column: Column, groups: list[str]) -> DataFrame:
        return distinct_counts(state, groups, "refugees").select(
            F.lit(name).alias("level"), column.alias("name"), "refugees")
    return _union([level("district", F.col("host_district"), ["host_district"]),
                   level("program", F.col("program"), ["program"]),
                   level("all", F.lit("all"), [])])


def _payment_quantiles(i: Inputs) -> DataFrame:
    shares = (0.0, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0)
    found = exact_quantiles(i.stg("payments"), ["payment_mode"], "amount", shares,
                            piece_rows=500)
    return found.select("payment_mode", "n", *(
        round_n(F.col("quantiles")[k], 6).alias(f"q{round(p * 100)}")
        for k, p in enumerate(shares)))


def _scalar_dates(i: Inputs) -> DataFrame:
    staged = i.stg("complaints").select("complaint_id", "complaint_date", "resolution_date")
    in_ms = writers.dates_to_epoch_ms(staged.select(
        "*", F.col("complaint_date").alias("complaint_ms"),
    ).select("complaint_id", "complaint_ms"))
    dates = staged.select(
        "complaint_id", month_of("complaint_date").alias("complaint_month"),
        days_between("complaint_date", "resolution_date").alias("days_open"))
    return dates.join(in_ms, "complaint_id")


def _scalar_nulls(i: Inputs) -> DataFrame:
    return i.entity("beneficiaries").select(
        "beneficiary_id", F.nullif("phone", F.lit("")).alias("phone"),
        F.coalesce(F.nullif("tehsil", F.lit("")), F.lit("-")).alias("tehsil"),
        F.least("age", "family_size").alias("smaller"),
        F.when(F.col("is_disabled"), 1).otherwise(0).alias("disabled_flag"))


OPERATOR_KEYS: dict[str, Callable[[Inputs], DataFrame]] = {
    "ntile_global": lambda i: ntile_global(  # the input is a join, so it is stored first
        settle(i.stg("refugee_assistance").select("assistance_id", "amount_usd"), "ntile"),
        100, "amount_usd", "assistance_id", "tile"),
    "ntile_by_date": lambda i: ntile_global(
        i.stg("payments").select("payment_id", "payment_date"),
        20, "payment_date", "payment_id", "tile"),
    "ntile_by_amount": lambda i: ntile_global(
        i.stg("payments").select("payment_id", "amount"), 50, "amount", "payment_id", "tile"),
    "ntile_by_text": lambda i: ntile_global(
        i.stg("beneficiaries").select("beneficiary_key", "name"),
        25, "name", "beneficiary_key", "tile"),
    "win_payment_rank": lambda i: history.payment_rank(i.stg("payments")),
    "win_payment_rank_hot_keys": lambda i: history.payment_rank(i.stg("payments"), hot_rows=12),
    "agg_exact_sum": lambda i: _agg_exact_sum(i),
    "win_rank_hot_key": lambda i: rank_rows(_hot_program(i), ["bank"], "size", "place"),
    "distinct_refugees": _distinct_refugees,
    "quantiles_payments": _payment_quantiles,
    "mart_donor_budget_many_donors": lambda i: marts.mart_donor_budget_many_donors(
        i.models["int_donor_program_aggregates"]),
    "win_payment_rank_top10": lambda i: history.payment_rank_top(i.stg("payments")),
    "hist_amount": lambda i: histogram(i.stg("payments"), "amount", 50),
    "hist_by_group": lambda i: histogram_by(
        i.stg("afghan_refugees"), "arrival_wave", "vulnerability_score", 30),
    "ratio_safe": _ratio_safe,
    "agg_conditional": _agg_conditional,
    "inventory_critical_long": lambda i: kpis.critical_items(i.stg("inventory")),
    "scalar_dates": _scalar_dates,
    "scalar_nulls": _scalar_nulls,
}


# --- cleaning ------------------------------------------------------------------------

def _clean_monotonic(i: Inputs) -> DataFrame:
    before = i.bronze("payments")
    return cleaning.invariants(before, cleaning.clean(before)).select(
        "rows_before", "rows_after", "no_growth")


def _clean_invariants(i: Inputs) -> DataFrame:
    """One table after the other, so that the shuffle files of one are there at a time."""
    with shuffles_freed(i.spark):
        return _union([
            settle(cleaning.invariants(b, cleaning.clean(b)).select(
                F.lit(n).alias("table_name"), "*"), "invariants")
            for n, b in ((n, i.bronze(n)) for n in ENTITY_SQL)])


def _counts(i: Inputs, cleaned: bool) -> DataFrame:
    tables = {n: i.bronze(n) for n in ENTITY_SQL}
    return cleaning.row_counts(
        {n: cleaning.clean(b) for n, b in tables.items()} if cleaned else tables)


def _bad_casts(i: Inputs) -> DataFrame:
    """Text that does not parse, and rows that differ only in '' against NULL."""
    n = F.col("event_id")
    rows = i.spark.read.parquet(f"{i.sf_dir}/events.parquet")
    text = rows.select(
        n, F.when(n % 7 == 0, "").otherwise(
            F.concat(F.lit("n"), (n % 4).cast("string"))).alias("item_name"),
        F.when(n % 5 == 0, "twelve").otherwise(
            F.concat((n % 1000).cast("string"), F.lit(".0"))).alias("quantity"),
        F.when(n % 3 == 0, "1e").otherwise((n * 3).cast("string")).alias("amount"),
        F.when(n % 11 == 0, "soon").otherwise(F.col("ts").cast("string")).alias("last_updated"))
    twins = text.where(n % 7 == 0).withColumn("item_name", F.lit(None).cast("string"))
    return cleaning.clean(text.unionByName(twins))


def _epoch_out_of_range(i: Inputs) -> DataFrame:
    n = F.col("event_id")
    rows = i.spark.read.parquet(f"{i.sf_dir}/events.parquet")
    day = F.lit(1704067200000) + (n % 300) * 86_400_000
    return cleaning.clean(rows.select(
        n, F.when(n % 4 == 0, day.cast("double")).when(n % 4 == 1, F.lit(float("nan")))
        .when(n % 4 == 2, F.lit(1e30)).otherwise(F.lit(float("-inf"))).alias("visit_date"),
        F.when(n % 3 == 0, F.lit(1704067200000) + n * 1000)
        .when(n % 3 == 1, F.lit(9 * 10 ** 18)).otherwise(F.lit(-9 * 10 ** 18))
        .alias("last_updated")))


def _third_equal(i: Inputs) -> DataFrame:
    """Payments of which a third are one and the same row, and some others stand twice."""
    rows = i.bronze("payments")
    equal = F.col("amount") % 3 == 0
    same = {"string": F.lit("same"), "bigint": F.lit(0).cast("bigint"),
            "date": F.lit("1995-01-01").cast("date")}
    return rows.select(*(F.when(equal, same[t]).otherwise(F.col(c)).alias(c)
                         for c, t in rows.dtypes))


CLEANING_KEYS: dict[str, Callable[[Inputs], DataFrame]] = {
    "clean_dedup": lambda i: cleaning.clean(i.bronze("payments")),
    "clean_dedup_digest": lambda i: cleaning.clean(_third_equal(i), by_digest=True),
    "clean_empty_to_null": lambda i: cleaning.clean(i.entity("beneficiaries")),
    "clean_cast_types": lambda i: cleaning.clean(stringify_all(i.entity("beneficiaries"))),
    "clean_epoch_ms": lambda i: cleaning.clean(
        writers.dates_to_epoch_ms(i.entity("surveys"))),
    "clean_bad_casts": _bad_casts,
    "clean_epoch_out_of_range": _epoch_out_of_range,
    "clean_monotonic": _clean_monotonic,
    "clean_invariants": _clean_invariants,
    "layer_row_counts": lambda i: _counts(i, cleaned=False),
    "layer_reconcile": lambda i: cleaning.reconcile(
        _counts(i, cleaned=False), _counts(i, cleaned=True)),
}


# --- files, tables, ingest -----------------------------------------------------------

def _file_roundtrip(name: str, fmt: str) -> Callable[[Inputs], DataFrame]:
    def run(i: Inputs) -> DataFrame:
        path = f"{i.scratch('file')}/{SOURCES[name].file}"
        avro_fixture.write_one(i.entity(name), path, fmt)
        return readers.reader_for(fmt)(i.spark, path, SOURCES[name].schema)
    return run


def _csv_dir(i: Inputs) -> DataFrame:
    folder = i.scratch("csvdir")
    keys = {"complaints": "complaint_id", "refugee_protection": "case_id"}
    for name in keys:
        writers.write_csv_gz(i.entity(name), f"{folder}/{name}.csv")
    return _union([
        df.agg(F.count(F.lit(1)).alias("row_count"),
               F.count_distinct(F.col(keys[name])).alias("key_count"))
        .select(F.lit(name).alias("file_name"), "row_count", "key_count")
        for name, df in readers.read_csv_dir(i.spark, folder).items()])


def _bronze_roundtrip(i: Inputs) -> DataFrame:
    lake = i.lake("bronze")
    for _ in range(2):  # writing again replaces, it does not add
        lake.write(i.entity("payments"), "bronze", "payments")
    return lake.read("bronze", "payments")


def _silver_roundtrip(i: Inputs) -> DataFrame:
    lake = i.lake("silver")
    lake.write(i.bronze("complaints"), "bronze", "complaints")
    loading.build_silver(lake, ["complaints"])
    return lake.read("silver", "complaints")


def _time_travel(i: Inputs) -> DataFrame:
    lake = i.lake("travel")
    lake.write(i.entity("beneficiaries"), "bronze", "beneficiaries")
    lake.write(i.entity("beneficiaries").where("is_eligible"), "bronze", "beneficiaries")
    return lake.read("bronze", "beneficiaries", version=0)


def _gold_roundtrip(i: Inputs) -> DataFrame:
    lake = i.lake("gold")
    for name in ENTITY_SQL:
        lake.write(i.entity(name), "silver", name)
    build_gold(lake)
    return lake.read("gold", "mart_donor_budget_vs_actual")


# Text formats are written compressed: plain ndjson takes many times the space of the tables.
PACKED = {"json": "json.gz"}


def _sink_roundtrip(i: Inputs) -> DataFrame:
    """One format after the other, so that the shuffle files of one are there at a time."""
    with shuffles_freed(i.spark):
        return _sinks_read(i, settle(i.entity("refugee_assistance")), i.scratch("sinks"))


def _sinks_read(i: Inputs, rows: DataFrame, folder: str) -> DataFrame:
    text = stringify_all(rows).schema
    for fmt in writers.FORMATS:
        avro_fixture.write_one(rows, f"{folder}/{fmt}", PACKED.get(fmt, fmt))
    back = {
        "csv": i.spark.read.schema(text).csv(f"{folder}/csv", header=True, escape='"'),
        "parquet": i.spark.read.parquet(f"{folder}/parquet"),
        "json": i.spark.read.schema(
            writers.dates_to_epoch_ms(rows).schema).json(f"{folder}/json"),
        "avro": read_avro(i.spark, f"{folder}/avro", text),
    }
    return _union([
        settle(df.agg(F.count(F.lit(1)).alias("row_count"),
                      exact_sum(F.col("amount_usd").cast("double")).alias("usd_total"),
                      F.count_distinct(F.col("assistance_id")).alias("key_count"))
               .select(F.lit(fmt).alias("format"), "*"), f"{fmt}-read")
        for fmt, df in back.items()])


def _write_sources(i: Inputs, names: list[str]) -> str:
    folder = i.scratch("sources")

    def write(name: str) -> None:
        source = SOURCES[name]
        avro_fixture.write_one(i.entity(name), f"{folder}/{source.file}",
                               PACKED.get(source.format, source.format))

    with ThreadPoolExecutor(loading.PARALLEL_JOBS) as pool:
        list(pool.map(write, names))
    return folder


def _ingest(i: Inputs, names: list[str]) -> Lake:
    lake = i.lake("lake")
    with shuffles_freed(i.spark):
        loading.ingest(i.spark, _write_sources(i, names), lake, names)
    return lake


def _ingest_all(i: Inputs) -> DataFrame:
    lake = _ingest(i, list(SOURCES))
    return cleaning.row_counts({n: lake.read("bronze", n) for n in SOURCES})


def _ingest_manifest(i: Inputs) -> DataFrame:
    names = ["beneficiaries", "payments", "surveys", "inventory"]
    lake = _ingest(i, names)
    stored = cleaning.row_counts({n: lake.read("bronze", n) for n in names})
    stored = stored.toDF("dataset_name", "stored_rows")
    return loading.manifest_frame(i.spark, lake).join(stored, "dataset_name").select(
        "dataset_name", "row_count", "source_format", "stored_rows",
        (F.col("row_count") == F.col("stored_rows")).alias("matches"))


def _missing_after_reload(i: Inputs) -> DataFrame:
    """A good load, then a corrupt file under the same name."""
    names = ["payments", "surveys"]
    lake, folder = i.lake("lake"), _write_sources(i, names)
    loading.ingest(i.spark, folder, lake, names)
    again = i.scratch("corrupt")
    avro_fixture.write_one(
        i.entity("surveys").select(F.concat(F.lit("{"), "survey_id").alias("value")),
        f"{again}/{SOURCES['surveys'].file}", "csv")
    loading.ingest(i.spark, again, lake, ["surveys"])
    return loading.missing_datasets(i.spark, lake, names)


def _layers(i: Inputs, names: Iterable[str]) -> Lake:
    """Silver tables of the entities."""
    lake = i.lake("silver")
    for name in names:
        lake.write(i.entity(name), "silver", name)
    return lake


def _pruned_lake(i: Inputs) -> Lake:
    """Two marts in files of separate months."""
    lake = i.lake("zones")
    for name, column in SORTED_BY.items():
        if name != "mart_survey_metric_trends":
            lake.write(i.models[name], "gold", name, column, files=8)
    return lake


def _bucketed(i: Inputs, model: str, buckets: dict[str, str]) -> DataFrame:
    """An intermediate model over silver tables dealt by the column that they join on."""
    lake = i.lake("buckets")
    for table, column in buckets.items():
        lake.write(i.entity(table), "silver", table, buckets=(column, 8))
    return Models(lambda table: lake.read("silver", table))[model]


def _appended(i: Inputs, mart: str, fact: str, day: str) -> DataFrame:
    """A mart made from the rows before a day and kept up when the later ones are appended."""
    lake, rows = i.lake("upkeep"), i.entity(fact)
    for table in upkeep.KEPT[mart].others:
        lake.write(i.entity(table), "silver", table)
    early = F.coalesce(F.col(day) < "1998-01-01", F.lit(True))
    lake.write(rows.where(early), "silver", fact)
    upkeep.keep_up(lake, mart)
    lake.append(rows.where(~early), "silver", fact)
    upkeep.keep_up(lake, mart)
    return lake.read("gold", mart)


def _lake_sql(i: Inputs) -> DataFrame:
    """A silver table under its own name in SQL."""
    lake = _layers(i, ["payments"])
    lake.register("silver", "payments")
    return i.spark.sql("SELECT payment_mode, count(*) AS payments, max(amount) AS largest "
                       "FROM payments WHERE payment_status = 'Success' GROUP BY payment_mode")


def _footer_counts(i: Inputs) -> DataFrame:
    lake = _layers(i, ENTITY_SQL)
    return cleaning.row_counts(footers.tables(lake, "silver", list(ENTITY_SQL)))


def _footer_freshness(i: Inputs) -> DataFrame:
    lake = _layers(i, SOURCES)
    stored = footers.tables(lake, "silver", list(SOURCES))
    return quality.freshness(
        {n: (stored[n], s.freshness_column) for n, s in SOURCES.items()},
        dt.datetime.fromisoformat(FRESH_AS_OF))


LAKE_KEYS: dict[str, Callable[[Inputs], DataFrame]] = {
    "lake_bounds": lambda i: _pruned_lake(i).bounds("gold", "mart_payment_kpis"),
    "lake_sql": _lake_sql,
    "layer_row_counts_footers": _footer_counts,
    "dq_freshness_footers": _footer_freshness,
    "int_beneficiaries_payments_bucketed": lambda i: _bucketed(
        i, "int_beneficiaries_payments",
        {"beneficiaries": "beneficiary_id", "payments": "beneficiary_id"}),
    "int_refugees_assistance_bucketed": lambda i: _bucketed(
        i, "int_refugees_assistance",
        {"afghan_refugees": "refugee_id", "refugee_assistance": "refugee_id"}),
    "mart_payment_kpis_appended": lambda i: _settled(
        _appended(i, "mart_payment_kpis", "payments", "payment_date"),
        "rolling_3m_avg_success_rate"),
    "mart_donor_budget_appended": lambda i: _appended(
        i, "mart_donor_budget_vs_actual", "donor_reports", "disbursement_date"),
    "mart_protection_appended": lambda i: _appended(
        i, "mart_protection_caseload", "refugee_protection", "incident_date"),
    "dash_latest_cases": lambda i: reports.latest_cases(_pruned_lake(i), "purchase"),
}


FILE_KEYS: dict[str, Callable[[Inputs], DataFrame]] = {
    "src_csv_gz": _file_roundtrip("beneficiaries", "csv.gz"),
    "src_parquet": _file_roundtrip("payments", "parquet"),
    "src_ndjson": _file_roundtrip("surveys", "json"),
    "src_avro": _file_roundtrip("inventory", "avro"),
    "src_csv_dir": _csv_dir,
    "bronze_roundtrip": _bronze_roundtrip,
    "silver_roundtrip": _silver_roundtrip,
    "time_travel_v0": _time_travel,
    "gold_roundtrip": _gold_roundtrip,
    "stringify_all": lambda i: stringify_all(i.entity("refugee_assistance")),
    "sink_roundtrip": _sink_roundtrip,
    "ingest_all": _ingest_all,
    "ingest_manifest": _ingest_manifest,
    "ingest_one": lambda i: loading.manifest_frame(i.spark, _ingest(i, ["surveys"])).select(
        "dataset_name", "row_count", "source_format"),
    "ingest_missing_after_reload": _missing_after_reload,
    "ingest_missing": lambda i: loading.missing_datasets(
        i.spark, _ingest(i, ["payments", "surveys"])),
}


# --- quality ---------------------------------------------------------------------------

def _checks(i: Inputs, *kinds: str) -> DataFrame:
    return quality.column_checks(
        {m: i.models[m] for m in CHECKED
         if any(k in kinds for k, _ in quality.declared(MODELS[m]))}, kinds)


def _planted_payments(i: Inputs) -> DataFrame:
    """Payments some of which break a rule."""
    amount = F.col("amount")
    return i.stg("payments").select(
        "payment_id", "beneficiary_id", "payment_date",
        F.when(amount % 97 == 0, -amount).otherwise(amount).alias("amount"),
        F.when(amount % 89 == 0, "Lost").when(amount % 83 == 0, "?")
        .otherwise(F.col("payment_status")).alias("payment_status"))


def _planted_donors(i: Inputs) -> DataFrame:
    return i.models["int_donor_program_aggregates"].withColumn(
        "total_disbursed", F.when(
            F.col("report_count") % 3 == 0, F.col("total_committed") + F.col("report_count"))
        .otherwise(F.col("total_disbursed")))


def _planted_invariants(i: Inputs) -> DataFrame:
    donors = i.models["int_donor_program_aggregates"].withColumn(
        "utilization_pct", F.col("utilization_pct") + F.when(
            F.col("report_count") % 3 == 0, 1.0).otherwise(0.0))
    payments = i.models["mart_payment_kpis"]
    rate = F.when(F.col("success_rate") > 0.5, 2.0).otherwise(F.col("success_rate"))
    return quality.kpi_invariants(
        donors, payments.withColumns({
            "success_rate": rate, "rolling_3m_avg_success_rate": F.lit(0.5)}),
        kpis.refugee_vulnerability(i.stg("afghan_refugees")),
        i.models["mart_protection_caseload"].withColumn(
            "cumulative_cases", -F.col("cumulative_cases")))


QUALITY_KEYS: dict[str, Callable[[Inputs], DataFrame]] = {
    "dq_not_null": lambda i: _checks(i, "not_null").drop("failing_rows"),
    "dq_unique": lambda i: _checks(i, "unique").drop("failing_rows"),
    "dq_accepted_values": lambda i: _checks(i, "accepted_values"),
    "dq_column_checks": lambda i: _checks(i, *quality.KINDS),
    "dq_report": lambda i: quality.report({m: i.models[m] for m in CHECKED}),
    "dq_disbursed_lte_committed": lambda i: quality.disbursed_over_committed(
        i.models["mart_donor_budget_vs_actual"]),
    "dq_amount_positive": lambda i: quality.amount_not_positive(i.stg("payments")),
    "dq_amount_positive_planted": lambda i: quality.amount_not_positive(_planted_payments(i)),
    "dq_accepted_values_planted": lambda i: quality.accepted_values(
        _planted_payments(i), MODELS["stg_payments"]),
    "dq_disbursed_planted": lambda i: quality.disbursed_over_committed(_planted_donors(i)),
    "dq_failing_accepted": lambda i: quality.failing_rows(
        _planted_payments(i), MODELS["stg_payments"], "accepted_values", "payment_status"),
    "dq_failing_not_null": lambda i: quality.failing_rows(
        i.stg("payments"), MODELS["stg_payments"], "not_null", "beneficiary_id"),
    "kpi_invariants_planted": _planted_invariants,
    "dq_failing_rows": lambda i: quality.failing_rows(
        i.stg("donor_reports"), MODELS["stg_donor_reports"], "unique", "report_id"),
    "dq_freshness": lambda i: quality.freshness(
        {n: (i.entity(n), s.freshness_column) for n, s in SOURCES.items()},
        dt.datetime.fromisoformat(FRESH_AS_OF)),
}


# --- dashboard ---------------------------------------------------------------------------

def _payments(i: Inputs, **choice: object) -> DataFrame:
    return reports.payments_in_scope(_pay_mart(i), **choice)


def _pay_mart(i: Inputs) -> DataFrame:
    return _settled(i.gold("mart_payment_kpis"), "rolling_3m_avg_success_rate")


def _donors(i: Inputs) -> DataFrame:
    return i.gold("mart_donor_budget_vs_actual")


def _case_mart(i: Inputs) -> DataFrame:
    return i.gold("mart_protection_caseload")


def _cases(i: Inputs) -> DataFrame:
    return reports.cases_in_scope(_case_mart(i))


def _help(i: Inputs) -> DataFrame:
    return i.gold("mart_refugee_assistance_summary")


def _box(i: Inputs) -> DataFrame:
    box = reports.box_by_modality(_help(i))
    return box.select("modality", "points", *(
        round_n(c, 6).alias(c) for c in box.columns if c not in ("modality", "points")))


DASHBOARD_KEYS: dict[str, Callable[[Inputs], DataFrame]] = {
    "dash_extract_payments": lambda i: reports.extract(_pay_mart(i), "mart_payment_kpis"),
    "dash_extract_donors": lambda i: reports.extract(
        _donors(i), "mart_donor_budget_vs_actual"),
    "dash_extract_protection": lambda i: reports.extract(
        _case_mart(i), "mart_protection_caseload"),
    "dash_extract_assistance": lambda i: reports.extract(
        _help(i), "mart_refugee_assistance_summary"),
    "dash_month_range": lambda i: value_range(_payments(i), "reporting_month"),
    "dash_payments_in_range": lambda i: _settled(reports.payments_from(
        _pruned_lake(i), start=dt.date(1996, 3, 1), end=dt.date(1997, 2, 1)),
        "rolling_3m_avg_success_rate"),
    "dash_payments_program": lambda i: _payments(i, program="MACHINERY"),
    "dash_series_districts": lambda i: reports.payment_series(
        _payments(i, program="MACHINERY"), districts=["NATION_3", "NATION_7"]),
    "dash_budget_program": lambda i: reports.budget_long(_donors(i), program="PROMO"),
    "dash_utilization_program": lambda i: reports.utilization_ranked(
        _donors(i), program="PROMO"),
    "dash_cases_chosen": lambda i: reports.cases_by_risk(reports.cases_in_scope(
        _case_mart(i), incident_type="purchase", start=dt.date(2024, 3, 1),
        end=dt.date(2024, 12, 1), risks=["Critical", "High"])),
    "dash_top_districts_program": lambda i: reports.top_districts(
        _help(i), program="MACHINERY", n=5),
    "dash_distinct_values": lambda i: distinct_values(_payments(i), "district"),
    "dash_success_grid": lambda i: reports.success_grid(_payments(i)),
    "dash_success_grid_wide": lambda i: reports.success_grid_wide(_payments(i)),
    "dash_latest_month": lambda i: reports.latest_month(_payments(i)),
    "dash_payment_series": lambda i: reports.payment_series(_payments(i)),
    "dash_budget_long": lambda i: reports.budget_long(_donors(i)),
    "dash_utilization_ranked": lambda i: reports.utilization_ranked(_donors(i)),
    "dash_scatter": lambda i: reports.scatter(_donors(i)),
    "dash_utilization_grid": lambda i: reports.utilization_grid(_donors(i)),
    "dash_utilization_grid_wide": lambda i: reports.utilization_grid_wide(_donors(i)),
    "dash_cases_by_risk": lambda i: reports.cases_by_risk(_cases(i)),
    "dash_cases_grid": lambda i: reports.cases_grid(_cases(i)),
    "dash_cases_grid_wide": lambda i: reports.cases_grid_wide(_cases(i)),
    "dash_open_vs_total": lambda i: reports.open_vs_total(_cases(i)),
    "dash_case_hierarchy": lambda i: reports.case_hierarchy(_cases(i)),
    "dash_reach_and_spend": lambda i: reports.reach_and_spend(_help(i)),
    "dash_marginals": lambda i: reports.marginals(_help(i)),
    "dash_top_districts": lambda i: reports.top_districts(_help(i)),
    "dash_box_modality": _box,
    "dash_spend_grid": lambda i: reports.spend_grid(_help(i)),
    "dash_spend_grid_wide": lambda i: reports.spend_grid_wide(_help(i)),
}


def _model(name: str) -> Callable[[Inputs], DataFrame]:
    return lambda i: i.models[name]


def queries() -> dict[str, Query]:
    plans: dict[str, Callable[[Inputs], DataFrame]] = {
        **{key: _model(name) for key, name in MODEL_KEYS.items()},
        "mart_payment_kpis": _payment_mart,
        **KPI_KEYS, **OPERATOR_KEYS, **CLEANING_KEYS, **FILE_KEYS, **LAKE_KEYS, **QUALITY_KEYS,
        **DASHBOARD_KEYS,
    }

    def bound(plan: Callable[[Inputs], DataFrame]) -> Query:
        return lambda spark, sf_dir: plan(Inputs(spark, sf_dir))

    return {key: bound(plan) for key, plan in plans.items()}
