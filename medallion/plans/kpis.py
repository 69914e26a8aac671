"""The seven KPI queries, over the staging views."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medallion.functions import days_between, exact_avg, exact_sum, round_n, safe_ratio
from medallion.operators import list_in_order, ntile_global, running_total
from medallion.operators.enrich import join_null_safe
from medallion.plans.marts import monthly_payments


def _in_order(df: DataFrame, *columns: str) -> DataFrame:
    return df.orderBy(*(F.col(c).asc_nulls_last() for c in columns))


def budget_vs_actual(donor_reports: DataFrame) -> DataFrame:
    """Donor totals per programme, ranked by utilisation before it is rounded."""
    totals = donor_reports.groupBy("donor", "program").agg(
        exact_sum("amount_committed").alias("amount_committed"),
        exact_sum("amount_disbursed").alias("amount_disbursed"))
    used = totals.withColumn(
        "_used", safe_ratio("amount_disbursed", "amount_committed", 100))
    by_use = Window.partitionBy("program").orderBy(F.col("_used").desc_nulls_last())
    ranked = used.select(
        "donor", "program", "amount_committed", "amount_disbursed",
        (F.col("amount_committed") - F.col("amount_disbursed")).alias("variance"),
        round_n("_used", 2).alias("utilization_pct"),
        F.rank().over(by_use).cast("bigint").alias("donor_rank"))
    return _in_order(ranked, "program", "donor_rank")


def payment_success_rates(payments: DataFrame, beneficiaries: DataFrame) -> DataFrame:
    """Monthly success rate and its rolling mean; both rounded at the end."""
    rated = monthly_payments(payments, beneficiaries, "month").select(
        "district", "program", "month", "total_payments", "successful_payments",
        round_n("success_rate", 4).alias("success_rate"),
        round_n("rolling", 4).alias("rolling_3m_avg"))
    return _in_order(rated, "district", "program", "month")


def refugee_vulnerability(refugees: DataFrame) -> DataFrame:
    """Statistics per vulnerability decile; refugees without a score come last."""
    scored = refugees.select("refugee_id", "vulnerability_score", "family_size",
                             "has_disability", "is_unaccompanied_minor")
    tiled = ntile_global(scored, 10, "vulnerability_score", "refugee_id", "decile")
    stats = tiled.groupBy("decile").agg(
        F.count(F.lit(1)).alias("refugee_count"),
        round_n(F.min("vulnerability_score"), 2).alias("min_vulnerability_score"),
        round_n(F.max("vulnerability_score"), 2).alias("max_vulnerability_score"),
        round_n(exact_avg("vulnerability_score"), 4).alias("avg_vulnerability_score"),
        round_n(F.avg("family_size"), 2).alias("avg_family_size"),
        round_n(F.avg(F.col("has_disability").cast("int")), 4).alias("disability_rate"),
        round_n(F.avg(F.col("is_unaccompanied_minor").cast("int")), 4)
        .alias("unaccompanied_minor_rate"))
    return _in_order(stats, "decile")


def protection_caseload(protection: DataFrame) -> DataFrame:
    """Daily caseload with the running case count per incident type."""
    daily = protection.groupBy(
        "incident_type", "risk_level", "host_district", "incident_date"
    ).agg(F.count_if(F.col("case_status") != "Closed").alias("open_caseload"),
          F.count(F.lit(1)).alias("case_count"))
    running = running_total(
        daily, ["incident_type"], ["incident_date", "risk_level", "host_district"],
        "case_count", "cumulative_case_count")
    return _in_order(running, "incident_type", "incident_date", "risk_level")


def complaint_resolution(complaints: DataFrame) -> DataFrame:
    """Resolution rate, mean and 90th percentile of days to resolution.

    Complaints are first counted per number of days.  The percentile then works
    on at most one weighted row per day and group, not on raw complaints.
    """
    solved = F.col("status") == "Resolved"
    dated = solved & F.col("resolution_date").isNotNull()
    days = F.when(dated, days_between("complaint_date", "resolution_date"))
    counted = complaints.groupBy("district", "category", days.alias("_days")).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(solved).alias("_solved"))
    has_days = F.col("_days").isNotNull()
    stats = counted.groupBy("district", "category").agg(
        F.sum("_n").alias("total_complaints"),
        F.sum("_solved").alias("resolved_complaints"),
        safe_ratio(F.sum(F.col("_days") * F.col("_n")), F.sum(F.when(has_days, F.col("_n"))))
        .alias("_avg"),
        F.percentile("_days", 0.9, F.col("_n")).alias("_p90"))
    rounded = stats.select(
        "district", "category", "total_complaints", "resolved_complaints",
        round_n(safe_ratio("resolved_complaints", "total_complaints"), 4)
        .alias("resolution_rate"),
        round_n("_avg", 1).alias("avg_resolution_days"),
        round_n("_p90", 1).alias("p90_resolution_days"))
    return _in_order(rounded, "district", "category")


def critical_items(inventory: DataFrame) -> DataFrame:
    """Items that ran out, one row per place and name with the number of such items."""
    gone = inventory.where((F.col("quantity") == 0) & F.col("item_name").isNotNull())
    return gone.groupBy("warehouse", "program", "item_type", "item_name").agg(
        F.count(F.lit(1)).alias("items"))


PLACE = ("warehouse", "program", "item_type")


def _counted_items(inventory: DataFrame) -> DataFrame:
    """Items and low items per place and name that ran out; all other names together."""
    low = F.col("quantity") < F.col("reorder_level")
    ran_out = F.when(F.col("quantity") == 0, F.col("item_name"))
    return inventory.groupBy(*PLACE, ran_out.alias("_name")).agg(
        F.count(F.lit(1)).alias("_items"), F.count_if(low).alias("_low"))


def _alerts(totals: DataFrame) -> DataFrame:
    return _in_order(
        totals.select(*PLACE, "total_items", "items_below_reorder",
                      round_n(safe_ratio("items_below_reorder", "total_items"), 4)
                      .alias("alert_pct"), "critical_items"),
        *PLACE)


_TOTALS = {"total_items": "_items", "items_below_reorder": "_low"}


def inventory_reorder_alerts(inventory: DataFrame) -> DataFrame:
    """Items below reorder level, and the names of items that ran out.

    Items are first counted per name that ran out, all others together.  That
    hash aggregate takes the bulk of the rows; the string aggregate sees one row
    per group plus one per such name, and repeats a name as often as it occurs.
    ``critical_items`` has the same names as rows, and ``inventory_reorder_alerts_in_pieces``
    makes the same text where a place has very many.
    """
    named = _counted_items(inventory).withColumn("_names", F.when(
        F.col("_name").isNotNull(),
        F.array_join(F.array_repeat("_name", F.col("_items").cast("int")), ", ")))
    return _alerts(named.groupBy(*PLACE).agg(
        *(F.sum(c).alias(n) for n, c in _TOTALS.items()),
        F.expr("listagg(_names, ', ') within group (order by _name)").alias("critical_items")))


def inventory_reorder_alerts_in_pieces(inventory: DataFrame,
                                       pieces: int | None = None) -> DataFrame:
    """The same alerts where one place may hold very many names or copies of one name."""
    counted = _counted_items(inventory)
    totals = counted.groupBy(*PLACE).agg(*(F.sum(c).alias(n) for n, c in _TOTALS.items()))
    lists = list_in_order(counted, PLACE, "_name", "_items", "critical_items", pieces=pieces)
    return _alerts(join_null_safe(totals, lists, PLACE, "left"))


def refugee_return_intention(refugees: DataFrame) -> DataFrame:
    """Return intentions per province and arrival wave; the share is a percentage."""
    says = F.col("return_intention")
    counts = refugees.groupBy("province_of_origin", "arrival_wave").agg(
        round_n(exact_avg("vulnerability_score"), 4).alias("avg_vulnerability_score"),
        F.count_if(says == "Yes").alias("intend_to_return"),
        F.count_if(says == "Undecided").alias("undecided"),
        F.count_if(says == "No").alias("intend_to_stay"),
        F.count(F.lit(1)).alias("total"))
    return _in_order(
        counts.withColumn("return_intention_pct",
                          round_n(safe_ratio("intend_to_return", "total", 100), 2)),
        "province_of_origin", "arrival_wave")
