"""DuckDB SQL for every query key, written independently of the Spark plans."""

from __future__ import annotations

import datetime as dt

from medallion.specs import MODELS
from workload.bindings import ENTITY_SQL, entity_sql

ALL_ENTITIES = tuple(ENTITY_SQL)

# bronze tables get these copies added; the cleaning queries take them out again
COPIES = {
    "payments": "payment_status = 'Failed'",
    "complaints": "status = 'Open'",
    "surveys": "is_verified",
}
FRESH_AS_OF = "2024-02-01 00:00:00"


def _money(column: str) -> str:
    return f"CAST(SUM(CAST({column} AS DECIMAL(18,2))) AS DOUBLE)"


def _month(column: str) -> str:
    return f"CAST(DATE_TRUNC('month', {column}) AS DATE)"


def _percent(expr: str) -> str:
    return f"CAST(CAST(ROUND_EVEN({expr} * 100, 0) AS BIGINT) AS VARCHAR) || '%'"


def _plain(model: str, source: str, **renamed: str) -> str:
    cols = ", ".join(f"{renamed[c]} AS {c}" if c in renamed else c
                     for c in MODELS[model].columns)
    return f"SELECT {cols} FROM {source}"


_BLANKS = {c: f"NULLIF({c}, '')" for c in
           ("cnic", "name", "gender", "phone", "district", "tehsil", "union_council",
            "program", "bank_account")}

# name -> (names it reads, SQL)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "stg_beneficiaries": (("beneficiaries",), _plain(
        "stg_beneficiaries", "beneficiaries", beneficiary_key="beneficiary_id", **_BLANKS)),
    "stg_payments": (("payments",), _plain("stg_payments", "payments")),
    "stg_surveys": (("surveys",), _plain(
        "stg_surveys", "surveys", metric_name="metric_type", surveyor="field_worker")),
    "stg_inventory": (("inventory",), _plain("stg_inventory", "inventory")),
    "stg_complaints": (("complaints",), _plain("stg_complaints", "complaints")),
    "stg_donor_reports": (("donor_reports",), _plain(
        "stg_donor_reports", "donor_reports",
        amount_disbursed="LEAST(amount_disbursed, amount_committed)")),
    "stg_afghan_refugees": (("afghan_refugees",), _plain(
        "stg_afghan_refugees", "afghan_refugees")),
    "stg_refugee_assistance": (("refugee_assistance",), _plain(
        "stg_refugee_assistance", "refugee_assistance")),
    "stg_refugee_protection": (("refugee_protection",), _plain(
        "stg_refugee_protection", "refugee_protection", assigned_officer="case_worker")),
    "int_beneficiaries_payments": (("stg_beneficiaries", "stg_payments"), """
        SELECT b.* EXCLUDE (phone, last_payment_date),
               COALESCE(n, 0) AS total_payments,
               CAST(COALESCE(a, 0) AS BIGINT) AS total_amount,
               d AS last_payment_date
        FROM stg_beneficiaries b LEFT JOIN (
            SELECT beneficiary_id, COUNT(*) n, SUM(amount) a, MAX(payment_date) d
            FROM stg_payments GROUP BY 1) p ON p.beneficiary_id = b.beneficiary_key"""),
    "int_refugees_assistance": (("stg_afghan_refugees", "stg_refugee_assistance"), f"""
        SELECT r.*, COALESCE(usd, CAST(0 AS DOUBLE)) AS total_assistance_usd,
               COALESCE(n, 0) AS delivery_count, d AS last_delivery_date
        FROM stg_afghan_refugees r LEFT JOIN (
            SELECT refugee_id, {_money('amount_usd')} usd, COUNT(*) n, MAX(delivery_date) d
            FROM stg_refugee_assistance GROUP BY 1) a ON a.refugee_id = r.refugee_id"""),
    "int_donor_program_aggregates": (("stg_donor_reports",), """
        SELECT *, total_disbursed / NULLIF(total_committed, 0) * 100 AS utilization_pct
        FROM (SELECT donor, program, """ + _money("amount_committed") + """ total_committed,
                     """ + _money("amount_disbursed") + """ total_disbursed,
                     COUNT(report_id) report_count,
                     MIN(disbursement_date) first_disbursement_date,
                     MAX(disbursement_date) last_disbursement_date
              FROM stg_donor_reports GROUP BY donor, program)"""),
    "int_survey_trends": (("stg_surveys", "stg_beneficiaries"), """
        SELECT survey_id, metric_name, metric_value, survey_date, b.district, b.program
        FROM stg_surveys s LEFT JOIN stg_beneficiaries b
          ON s.beneficiary_id = b.beneficiary_key"""),
    "mart_payment_kpis": (("stg_payments", "stg_beneficiaries"), f"""
        SELECT *, AVG(success_rate) OVER (
            PARTITION BY district, program ORDER BY reporting_month
            ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling_3m_avg_success_rate
        FROM (SELECT b.district, b.program, {_month('p.payment_date')} AS reporting_month,
                     COUNT(*) AS total_payments,
                     COUNT(*) FILTER (WHERE payment_status = 'Success')
                         AS successful_payments,
                     COUNT(*) FILTER (WHERE payment_status = 'Success') / COUNT(*)
                         AS success_rate
              FROM stg_payments p LEFT JOIN stg_beneficiaries b
                ON p.beneficiary_id = b.beneficiary_key GROUP BY 1, 2, 3)"""),
    "mart_donor_budget_vs_actual": (("int_donor_program_aggregates",), """
        SELECT donor, program, total_committed, total_disbursed,
               total_committed - total_disbursed AS variance, utilization_pct,
               RANK() OVER (PARTITION BY program ORDER BY utilization_pct DESC NULLS LAST)
                   AS utilization_rank
        FROM int_donor_program_aggregates"""),
    "mart_refugee_assistance_summary": (
        ("stg_afghan_refugees", "stg_refugee_assistance"), f"""
        SELECT a.program, a.modality, a.host_district,
               COUNT(DISTINCT a.refugee_id) AS total_beneficiaries,
               {_money('amount_usd')} AS total_amount_usd,
               {_money('amount_usd')} / NULLIF(COUNT(*), 0) AS avg_amount_usd,
               COUNT(*) AS delivery_count,
               {_money('vulnerability_score')} / NULLIF(COUNT(vulnerability_score), 0)
                   AS avg_vulnerability_score
        FROM stg_refugee_assistance a LEFT JOIN stg_afghan_refugees r
          ON a.refugee_id = r.refugee_id
        GROUP BY 1, 2, 3"""),
    "mart_protection_caseload": (("stg_refugee_protection",), f"""
        SELECT *, CAST(SUM(total_cases) OVER (
            PARTITION BY incident_type
            ORDER BY incident_month NULLS LAST, risk_level NULLS LAST,
                     host_district NULLS LAST
            ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative_cases
        FROM (SELECT incident_type, risk_level, host_district,
                     {_month('incident_date')} AS incident_month,
                     COUNT(*) FILTER (WHERE case_status <> 'Closed') AS open_cases,
                     COUNT(*) AS total_cases
              FROM stg_refugee_protection GROUP BY ALL)"""),
    "mart_survey_metric_trends": (("int_survey_trends",), f"""
        SELECT metric_name, district, program, {_month('survey_date')} AS survey_month,
               AVG(metric_value) AS avg_metric_value, COUNT(*) AS response_count
        FROM int_survey_trends GROUP BY ALL"""),
    "deciles": (("stg_afghan_refugees",), """
        SELECT *, NTILE(10) OVER (ORDER BY vulnerability_score NULLS LAST,
                                  md5(refugee_id), refugee_id) AS decile
        FROM stg_afghan_refugees"""),
    "pay_scope": (("mart_payment_kpis",), """
        SELECT * REPLACE (ROUND(rolling_3m_avg_success_rate, 9) AS rolling_3m_avg_success_rate)
        FROM mart_payment_kpis
        WHERE program = (SELECT MIN(program) FROM mart_payment_kpis)
          AND reporting_month IS NOT NULL"""),
    "donor_scope": (("mart_donor_budget_vs_actual",), """
        SELECT * FROM mart_donor_budget_vs_actual
        WHERE program = (SELECT MIN(program) FROM mart_donor_budget_vs_actual)"""),
    "case_scope": (("mart_protection_caseload",), """
        SELECT * FROM mart_protection_caseload
        WHERE incident_type = (SELECT MIN(incident_type) FROM mart_protection_caseload)
          AND incident_month IS NOT NULL AND risk_level IS NOT NULL"""),
    "help_scope": (("mart_refugee_assistance_summary",), """
        SELECT * FROM mart_refugee_assistance_summary
        WHERE program = (SELECT MIN(program) FROM mart_refugee_assistance_summary)"""),
}


def statement(final: str, *reads: str) -> str:
    """``final`` with every CTE and entity it needs in front."""
    order: list[str] = []

    def need(name: str) -> None:
        if name in order:
            return
        for dep in CTES[name][0] if name in CTES else ():
            need(dep)
        order.append(name)

    for name in reads:
        need(name)
    parts = [f"{n} AS ({CTES[n][1] if n in CTES else entity_sql(n)})" for n in order]
    return f"WITH {', '.join(parts)} {final}" if parts else final


def _all(name: str, rounded: str | None = None) -> str:
    cols = list(MODELS[name].columns)
    if rounded:
        cols = [f"ROUND({c}, 9) AS {c}" if c == rounded else c for c in cols]
    return statement(f"SELECT {', '.join(cols)} FROM {name}", name)


def _bronze(name: str) -> str:
    copies = f" UNION ALL SELECT * FROM {name} WHERE {COPIES[name]}" if name in COPIES else ""
    return f"SELECT * FROM {name}{copies}"


def _as_text(name: str, columns: str) -> str:
    flags = {"is_disabled", "is_eligible"}
    return ", ".join(
        f"CASE WHEN {c} THEN 'True' WHEN NOT {c} THEN 'False' END AS {c}" if c in flags
        else f"CAST({c} AS VARCHAR) AS {c}" for c in columns.split())


def _checks(models: list[str], kinds: set[str]) -> list[str]:
    out = []
    for m in models:
        spec = MODELS[m]
        head = f"'{m}' AS model"
        if "not_null" in kinds:
            out += [f"SELECT 'not_null' AS check_type, {head}, '{c}' AS column_name, "
                    f"COUNT(*) AS failures FROM {m} WHERE {c} IS NULL" for c in spec.not_null]
        if "unique" in kinds:
            out += [f"SELECT 'unique' AS check_type, {head}, '{c}' AS column_name, "
                    f"COUNT(*) AS failures FROM (SELECT {c} FROM {m} WHERE {c} IS NOT NULL "
                    f"GROUP BY {c} HAVING COUNT(*) > 1)" for c in spec.unique]
        if "accepted_values" in kinds:
            for c, values in spec.accepted.items():
                listed = ", ".join(f"'{v}'" for v in values)
                out.append(
                    f"SELECT 'accepted_values' AS check_type, {head}, '{c}' AS column_name, "
                    f"COUNT(DISTINCT {c}) AS failures, COUNT(*) AS failing_rows FROM {m} "
                    f"WHERE {c} NOT IN ({listed})")
    return out


CHECKED = [m for m, s in MODELS.items() if s.not_null or s.unique or s.accepted]
SINGULAR = [
    "SELECT 'singular' AS check_type, 'mart_donor_budget_vs_actual' AS model, "
    "'disbursed_lte_committed' AS column_name, COUNT(*) AS failures "
    "FROM mart_donor_budget_vs_actual WHERE total_disbursed > total_committed + 0.01",
    "SELECT 'singular' AS check_type, 'stg_payments' AS model, "
    "'amount_positive' AS column_name, COUNT(*) AS failures "
    "FROM stg_payments WHERE amount <= 0",
]


def _report() -> str:
    parts = [p.replace(", COUNT(*) AS failing_rows", "") for p in
             _checks(CHECKED, {"not_null", "unique", "accepted_values"})] + SINGULAR
    return statement(
        "SELECT *, failures <> 0 AS should_warn, failures <> 0 AS should_error FROM ("
        + " UNION ALL ".join(parts) + ")", *CHECKED)


def _histogram(source: str, value: str, bins: int, group: str | None = None) -> str:
    """Counts rows between the edges; no bin arithmetic."""
    g, by = (f"{group}, ", f"GROUP BY {group}") if group else ("", "")
    match = f"AND s.{group} = e.{group}" if group else ""
    keep = f"AND {group} IS NOT NULL" if group else ""
    return f"""
        SELECT {'e.' + group + ', ' if group else ''}e.bin, e.bin_start, e.bin_end,
               COUNT(s.x) AS frequency
        FROM (SELECT {g}CAST(i AS BIGINT) AS bin,
                     lo + i * ((hi - lo) / {bins}) AS bin_start,
                     lo + (i + 1) * ((hi - lo) / {bins}) AS bin_end
              FROM (SELECT {g}CASE WHEN a = b THEN a - 0.5 ELSE a END AS lo,
                           CASE WHEN a = b THEN b + 0.5 ELSE b END AS hi
                    FROM (SELECT {g}CAST(MIN({value}) AS DOUBLE) a,
                                 CAST(MAX({value}) AS DOUBLE) b
                          FROM {source} WHERE {value} IS NOT NULL {keep} {by})
                    WHERE a IS NOT NULL), range({bins}) r(i)) e
        LEFT JOIN (SELECT {g}CAST({value} AS DOUBLE) AS x FROM {source}) s
          ON s.x >= e.bin_start AND (s.x < e.bin_end OR e.bin = {bins - 1}) {match}
        GROUP BY ALL"""


def _months(first: str, last: str) -> list[dt.date]:
    y, m = map(int, first.split("-"))
    out = []
    while (y, m) <= tuple(map(int, last.split("-"))):
        out.append(dt.date(y, m, 1))
        y, m = (y, m + 1) if m < 12 else (y + 1, 1)
    return out


def _wide(scope: str, index: str, columns: str, cell: str, values: list[str]) -> str:
    cells = ", ".join(
        cell.format(when=f"CASE WHEN CAST({columns} AS VARCHAR) = '{v}' THEN")
        + f' AS "{v}"' for v in values)
    return statement(
        f"SELECT {index}, {cells} FROM {scope} "
        f"WHERE {index} IS NOT NULL AND {columns} IS NOT NULL GROUP BY {index}", scope)


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    # models
    q.update({key: _all(name) for key, name in {
        "stg_beneficiaries": "stg_beneficiaries", "stg_payments": "stg_payments",
        "stg_surveys": "stg_surveys", "stg_inventory": "stg_inventory",
        "stg_complaints": "stg_complaints", "stg_donor_reports": "stg_donor_reports",
        "stg_refugees": "stg_afghan_refugees", "stg_assistance": "stg_refugee_assistance",
        "stg_protection": "stg_refugee_protection",
        "int_beneficiaries_payments": "int_beneficiaries_payments",
        "int_refugees_assistance": "int_refugees_assistance",
        "int_donor_program": "int_donor_program_aggregates",
        "int_survey_trends": "int_survey_trends",
        "mart_donor_budget": "mart_donor_budget_vs_actual",
        "mart_refugee_assistance": "mart_refugee_assistance_summary",
        "mart_protection": "mart_protection_caseload",
        "mart_survey_trends": "mart_survey_metric_trends",
    }.items()})
    q["mart_payment_kpis"] = _all("mart_payment_kpis", "rolling_3m_avg_success_rate")

    # KPIs
    q["kpi_budget_vs_actual"] = statement("""
        SELECT donor, program, total_committed AS amount_committed,
               total_disbursed AS amount_disbursed, variance,
               ROUND(utilization_pct, 2) AS utilization_pct,
               utilization_rank AS donor_rank
        FROM mart_donor_budget_vs_actual""", "mart_donor_budget_vs_actual")
    q["kpi_payment_success"] = statement("""
        SELECT district, program, reporting_month AS month, total_payments,
               successful_payments, ROUND(success_rate, 4) AS success_rate,
               ROUND(rolling_3m_avg_success_rate, 4) AS rolling_3m_avg
        FROM mart_payment_kpis""", "mart_payment_kpis")
    q["kpi_vulnerability"] = statement(f"""
        SELECT decile, COUNT(*) AS refugee_count,
               ROUND(MIN(vulnerability_score), 2) AS min_vulnerability_score,
               ROUND(MAX(vulnerability_score), 2) AS max_vulnerability_score,
               ROUND({_money('vulnerability_score')} / COUNT(vulnerability_score), 4)
                   AS avg_vulnerability_score,
               ROUND(AVG(family_size), 2) AS avg_family_size,
               ROUND(AVG(CAST(has_disability AS INTEGER)), 4) AS disability_rate,
               ROUND(AVG(CAST(is_unaccompanied_minor AS INTEGER)), 4)
                   AS unaccompanied_minor_rate
        FROM deciles GROUP BY decile""", "deciles")
    q["kpi_protection"] = statement("""
        SELECT *, CAST(SUM(case_count) OVER (
            PARTITION BY incident_type
            ORDER BY incident_date NULLS LAST, risk_level NULLS LAST,
                     host_district NULLS LAST
            ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative_case_count
        FROM (SELECT incident_type, risk_level, host_district, incident_date,
                     COUNT(*) FILTER (WHERE case_status <> 'Closed') AS open_caseload,
                     COUNT(*) AS case_count
              FROM stg_refugee_protection GROUP BY ALL)""", "stg_refugee_protection")
    days = ("CASE WHEN status = 'Resolved' AND resolution_date IS NOT NULL "
            "THEN DATE_DIFF('day', complaint_date, resolution_date) END")
    q["kpi_complaint_resolution"] = statement(f"""
        SELECT district, category, COUNT(*) AS total_complaints,
               COUNT(*) FILTER (WHERE status = 'Resolved') AS resolved_complaints,
               ROUND(COUNT(*) FILTER (WHERE status = 'Resolved') / COUNT(*), 4)
                   AS resolution_rate,
               ROUND(AVG({days}), 1) AS avg_resolution_days,
               ROUND(PERCENTILE_CONT(0.9) WITHIN GROUP (ORDER BY {days}), 1)
                   AS p90_resolution_days
        FROM stg_complaints GROUP BY district, category""", "stg_complaints")
    q["kpi_inventory_reorder"] = statement("""
        SELECT warehouse, program, item_type, COUNT(*) AS total_items,
               COUNT(*) FILTER (WHERE quantity < reorder_level) AS items_below_reorder,
               ROUND(COUNT(*) FILTER (WHERE quantity < reorder_level) / COUNT(*), 4)
                   AS alert_pct,
               STRING_AGG(item_name, ', ' ORDER BY item_name)
                   FILTER (WHERE quantity = 0) AS critical_items
        FROM stg_inventory GROUP BY ALL""", "stg_inventory")
    q["kpi_return_intention"] = statement(f"""
        SELECT *, ROUND(intend_to_return / NULLIF(total, 0) * 100, 2) AS return_intention_pct
        FROM (SELECT province_of_origin, arrival_wave,
                     ROUND({_money('vulnerability_score')} / COUNT(vulnerability_score), 4)
                         AS avg_vulnerability_score,
                     COUNT(*) FILTER (WHERE return_intention = 'Yes') AS intend_to_return,
                     COUNT(*) FILTER (WHERE return_intention = 'Undecided') AS undecided,
                     COUNT(*) FILTER (WHERE return_intention = 'No') AS intend_to_stay,
                     COUNT(*) AS total
              FROM stg_afghan_refugees GROUP BY ALL)""", "stg_afghan_refugees")
    q["kpi_invariants"] = statement("""
        SELECT 'utilisation_identity' AS property, COUNT(*) AS violations
        FROM mart_donor_budget_vs_actual
        WHERE ABS(utilization_pct - total_disbursed / NULLIF(total_committed, 0) * 100) > 0.001
        UNION ALL SELECT 'rates_in_unit_range', COUNT(*) FROM mart_payment_kpis
        WHERE success_rate NOT BETWEEN 0 AND 1
           OR rolling_3m_avg_success_rate NOT BETWEEN 0 AND 1
        UNION ALL SELECT 'deciles_ordered', COUNT(*) FROM (
            SELECT decile, MIN(vulnerability_score) lo,
                   LAG(MAX(vulnerability_score)) OVER (ORDER BY decile) prev
            FROM deciles GROUP BY decile) WHERE prev > lo OR decile NOT BETWEEN 1 AND 10
        UNION ALL SELECT 'cumulative_monotone', COUNT(*) FROM (
            SELECT cumulative_cases c, LAG(cumulative_cases) OVER (
                PARTITION BY incident_type ORDER BY incident_month, risk_level, host_district) p
            FROM mart_protection_caseload) WHERE p > c""",
        "mart_donor_budget_vs_actual", "mart_payment_kpis", "deciles",
        "mart_protection_caseload")

    # operators
    q["ntile_global"] = statement("""
        SELECT assistance_id, amount_usd, NTILE(100) OVER (
            ORDER BY amount_usd NULLS LAST, md5(assistance_id), assistance_id) AS tile
        FROM stg_refugee_assistance""", "stg_refugee_assistance")
    for key, column, tiles in (("ntile_by_date", "payment_date", 20),
                               ("ntile_by_amount", "amount", 50)):
        q[key] = statement(f"""
            SELECT payment_id, {column}, NTILE({tiles}) OVER (
                ORDER BY {column} NULLS LAST, md5(payment_id), payment_id) AS tile
            FROM stg_payments""", "stg_payments")
    ranked = """
        SELECT payment_id, beneficiary_id, payment_date, amount, ROW_NUMBER() OVER (
            PARTITION BY beneficiary_id
            ORDER BY payment_date DESC NULLS LAST, {tie} payment_id) AS payment_rank
        FROM {source}"""
    by_id = ranked.format(tie="md5(payment_id),", source="stg_payments")
    q["win_payment_rank"] = statement(by_id, "stg_payments")
    q["win_payment_rank_hot_keys"] = q["win_payment_rank"]
    q["win_payment_rank_top10"] = statement(
        by_id + " ORDER BY beneficiary_id NULLS LAST, payment_rank LIMIT 10", "stg_payments")
    # not rounded before the sum, so that small amounts count
    q["agg_exact_sum"] = """
        SELECT 'price' AS measure, l_returnflag AS part,
               ROUND(fsum(l_extendedprice / 7), 2) AS total FROM lineitem GROUP BY 2
        UNION ALL
        SELECT 'value', event_type, ROUND(fsum(value), 4) FROM events GROUP BY 2
        UNION ALL
        SELECT 'tiny', l_linestatus, ROUND(fsum(l_quantity * 1e-9), 9)
        FROM lineitem GROUP BY 2"""
    q["hist_amount"] = statement(_histogram("stg_payments", "amount", 50), "stg_payments")
    q["hist_by_group"] = statement(_histogram(
        "stg_afghan_refugees", "vulnerability_score", 30, "arrival_wave"),
        "stg_afghan_refugees")
    q["ratio_safe"] = statement("""
        SELECT item_id, reorder_level / NULLIF(quantity, 0) AS cover,
               reorder_level / NULLIF(quantity, 0) * 100 AS cover_pct,
               reorder_level - quantity AS shortfall FROM stg_inventory""", "stg_inventory")
    q["agg_conditional"] = statement("""
        SELECT district, CAST(SUM(CASE WHEN status = 'Resolved' THEN 1 ELSE 0 END) AS BIGINT)
                   AS resolved,
               COUNT(CASE WHEN status NOT IN ('Resolved', 'Rejected') THEN 1 END) AS pending,
               SUM(CASE WHEN status = 'Resolved' THEN 1 ELSE 0 END) / COUNT(*) AS resolved_rate
        FROM stg_complaints GROUP BY district""", "stg_complaints")
    q["scalar_dates"] = statement(f"""
        SELECT complaint_id, {_month('complaint_date')} AS complaint_month,
               DATE_DIFF('day', complaint_date, resolution_date) AS days_open,
               EPOCH_MS(CAST(complaint_date AS TIMESTAMP)) AS complaint_ms
        FROM stg_complaints""", "stg_complaints")
    q["scalar_nulls"] = statement("""
        SELECT beneficiary_id, NULLIF(phone, '') AS phone,
               COALESCE(NULLIF(tehsil, ''), '-') AS tehsil, LEAST(age, family_size) AS smaller,
               CASE WHEN is_disabled THEN 1 ELSE 0 END AS disabled_flag
        FROM beneficiaries""", "beneficiaries")

    # cleaning
    q["clean_dedup"] = statement("SELECT * FROM payments", "payments")
    q["clean_empty_to_null"] = statement(
        "SELECT * REPLACE (NULLIF(phone, '') AS phone, NULLIF(tehsil, '') AS tehsil) "
        "FROM beneficiaries", "beneficiaries")
    q["clean_cast_types"] = statement(
        "SELECT * REPLACE (NULLIF(phone, '') AS phone, NULLIF(tehsil, '') AS tehsil, "
        "CAST(age AS VARCHAR) AS age, CAST(family_size AS VARCHAR) AS family_size) "
        "FROM beneficiaries", "beneficiaries")
    q["clean_epoch_ms"] = statement("SELECT * FROM surveys", "surveys")
    q["clean_monotonic"] = statement(
        f"SELECT (SELECT COUNT(*) FROM ({_bronze('payments')})) AS rows_before, "
        "COUNT(*) AS rows_after, TRUE AS no_growth "
        f"FROM (SELECT DISTINCT * FROM ({_bronze('payments')}))", "payments")
    q["clean_invariants"] = statement(" UNION ALL ".join(
        f"SELECT '{n}' AS table_name, (SELECT COUNT(*) FROM ({_bronze(n)})) AS rows_before, "
        f"COUNT(*) AS rows_after, CAST(0 AS BIGINT) AS duplicate_rows, "
        f"CAST(0 AS BIGINT) AS blank_strings, TRUE AS no_growth "
        f"FROM (SELECT DISTINCT * FROM ({_bronze(n)}))" for n in ALL_ENTITIES), *ALL_ENTITIES)
    q["layer_row_counts"] = statement(" UNION ALL ".join(
        f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM ({_bronze(n)})"
        for n in ALL_ENTITIES), *ALL_ENTITIES)
    q["layer_reconcile"] = statement(
        "SELECT *, bronze_rows - silver_rows AS dedup_delta, "
        "ROUND((bronze_rows - silver_rows) / bronze_rows * 100, 2) AS dedup_pct FROM ("
        + " UNION ALL ".join(
            f"SELECT '{n}' AS table_name, (SELECT COUNT(*) FROM ({_bronze(n)})) AS bronze_rows, "
            f"(SELECT COUNT(*) FROM (SELECT DISTINCT * FROM ({_bronze(n)}))) AS silver_rows"
            for n in ALL_ENTITIES) + ")", *ALL_ENTITIES)

    # sources, sinks, versioned tables
    text = _as_text("beneficiaries", "registration_date last_payment_date is_disabled "
                                     "is_eligible")
    q["src_csv_gz"] = statement(
        f"SELECT * REPLACE (NULLIF(phone, '') AS phone, NULLIF(tehsil, '') AS tehsil, {text}) "
        "FROM beneficiaries", "beneficiaries")
    q["src_parquet"] = statement("SELECT * FROM payments", "payments")
    q["src_ndjson"] = statement(
        "SELECT * REPLACE (EPOCH_MS(CAST(survey_date AS TIMESTAMP)) AS survey_date, "
        "CAST(metric_value AS BIGINT) AS metric_value) FROM surveys", "surveys")
    q["src_avro"] = statement(
        "SELECT " + _as_text("inventory", "item_id item_name item_type quantity unit warehouse "
                             "last_updated reorder_level program supplier")
        + " FROM inventory", "inventory")
    q["src_csv_dir"] = statement(" UNION ALL ".join(
        f"SELECT '{n}' AS file_name, COUNT(*) AS row_count, COUNT(DISTINCT {k}) AS key_count "
        f"FROM {n}" for n, k in (("complaints", "complaint_id"),
                                 ("refugee_protection", "case_id"))),
        "complaints", "refugee_protection")
    q["bronze_roundtrip"] = statement("SELECT * FROM payments", "payments")
    q["silver_roundtrip"] = statement("SELECT * FROM complaints", "complaints")
    q["time_travel_v0"] = statement("SELECT * FROM beneficiaries", "beneficiaries")
    q["gold_roundtrip"] = _all("mart_donor_budget_vs_actual")
    q["stringify_all"] = statement(
        "SELECT " + _as_text("refugee_assistance", "assistance_id refugee_id program modality "
                             "amount_usd amount_pkr delivery_date delivery_point status "
                             "implementing_org host_district")
        + " FROM refugee_assistance", "refugee_assistance")
    q["sink_roundtrip"] = statement(" UNION ALL ".join(
        f"SELECT '{f}' AS format, COUNT(*) AS row_count, {_money('amount_usd')} AS usd_total, "
        f"COUNT(DISTINCT assistance_id) AS key_count FROM refugee_assistance"
        for f in ("csv", "parquet", "json", "avro")), "refugee_assistance")
    q["ingest_all"] = statement(" UNION ALL ".join(
        f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {n}" for n in ALL_ENTITIES),
        *ALL_ENTITIES)
    formats = {"beneficiaries": "csv.gz", "payments": "parquet", "surveys": "json",
               "inventory": "avro"}
    q["ingest_manifest"] = statement(" UNION ALL ".join(
        f"SELECT '{n}' AS dataset_name, COUNT(*) AS row_count, '{f}' AS source_format, "
        f"COUNT(*) AS stored_rows, TRUE AS matches FROM {n}" for n, f in formats.items()),
        *formats)
    q["ingest_one"] = statement(
        "SELECT 'surveys' AS dataset_name, COUNT(*) AS row_count, 'json' AS source_format "
        "FROM surveys", "surveys")
    q["ingest_missing"] = "SELECT * FROM (VALUES " + ", ".join(
        f"('{n}')" for n in ALL_ENTITIES if n not in ("payments", "surveys")
    ) + ") t(dataset_name)"

    # quality
    q["dq_not_null"] = statement(" UNION ALL ".join(_checks(CHECKED, {"not_null"})), *CHECKED)
    keyed = [m for m in CHECKED if MODELS[m].unique]
    parts = []
    for m in CHECKED:
        parts += [c.replace("COUNT(*) AS failures", "COUNT(*) AS failures, COUNT(*) AS failing_rows")
                  for c in _checks([m], {"not_null"})]
        parts += _checks([m], {"accepted_values"})
        parts += [f"SELECT 'unique', '{m}', '{c}', COUNT(*), CAST(COALESCE(SUM(n), 0) AS BIGINT) "
                  f"FROM (SELECT COUNT(*) AS n FROM {m} WHERE {c} IS NOT NULL "
                  f"GROUP BY {c} HAVING COUNT(*) > 1)" for c in MODELS[m].unique]
    q["dq_column_checks"] = statement(" UNION ALL ".join(parts), *CHECKED)
    q["dq_unique"] = statement(" UNION ALL ".join(_checks(keyed, {"unique"})), *keyed)
    listed = [m for m in CHECKED if MODELS[m].accepted]
    q["dq_accepted_values"] = statement(
        " UNION ALL ".join(_checks(listed, {"accepted_values"})), *listed)
    q["dq_report"] = _report()
    q["dq_disbursed_lte_committed"] = statement(
        "SELECT donor, program, total_committed, total_disbursed "
        "FROM mart_donor_budget_vs_actual WHERE total_disbursed > total_committed + 0.01",
        "mart_donor_budget_vs_actual")
    q["dq_amount_positive"] = statement(
        "SELECT payment_id, beneficiary_id, amount, payment_date FROM stg_payments "
        "WHERE amount <= 0", "stg_payments")
    q["dq_failing_rows"] = statement(
        "SELECT * FROM stg_donor_reports WHERE report_id IN (SELECT report_id "
        "FROM stg_donor_reports GROUP BY 1 HAVING COUNT(*) > 1)", "stg_donor_reports")
    # rows that break a rule, planted by the row's own number
    bad_pay = ("SELECT payment_id, beneficiary_id, payment_date, CASE WHEN amount % 97 = 0 "
               "THEN -amount ELSE amount END AS amount, CASE WHEN amount % 89 = 0 THEN 'Lost' "
               "WHEN amount % 83 = 0 THEN '?' ELSE payment_status END AS payment_status "
               "FROM stg_payments")
    q["dq_amount_positive_planted"] = statement(
        "SELECT payment_id, beneficiary_id, amount, payment_date "
        f"FROM ({bad_pay}) WHERE amount <= 0", "stg_payments")
    q["dq_accepted_values_planted"] = statement(
        "SELECT 'accepted_values' AS check_type, 'stg_payments' AS model, 'payment_status' "
        "AS column_name, COUNT(DISTINCT payment_status) AS failures, COUNT(*) AS failing_rows "
        f"FROM ({bad_pay}) WHERE payment_status IN ('Lost', '?')", "stg_payments")
    q["dq_failing_accepted"] = statement(
        f"SELECT * FROM ({bad_pay}) WHERE payment_status IN ('Lost', '?')", "stg_payments")
    q["dq_failing_not_null"] = statement(
        "SELECT * FROM stg_payments WHERE beneficiary_id IS NULL", "stg_payments")
    q["dq_disbursed_planted"] = statement(
        "SELECT donor, program, total_committed, total_disbursed FROM ("
        "SELECT donor, program, total_committed, CASE WHEN report_count % 3 = 0 "
        "THEN total_committed + report_count ELSE total_disbursed END AS total_disbursed "
        "FROM int_donor_program_aggregates) WHERE total_disbursed > total_committed + 0.01",
        "int_donor_program_aggregates")
    q["kpi_invariants_planted"] = statement("""
        SELECT 'utilisation_identity' AS property, COUNT(*) AS violations
        FROM int_donor_program_aggregates WHERE report_count % 3 = 0 AND total_committed <> 0
        UNION ALL SELECT 'rates_in_unit_range', COUNT(*) FROM mart_payment_kpis
        WHERE success_rate > 0.5
        UNION ALL SELECT 'deciles_ordered', 0
        UNION ALL SELECT 'cumulative_monotone', COUNT(*) FROM (
            SELECT -cumulative_cases c, LAG(-cumulative_cases) OVER (
                PARTITION BY incident_type ORDER BY incident_month, risk_level, host_district) p
            FROM mart_protection_caseload) WHERE p > c""",
        "int_donor_program_aggregates", "mart_payment_kpis", "mart_protection_caseload")
    q["clean_bad_casts"] = """
        SELECT DISTINCT event_id,
               CASE WHEN event_id % 7 = 0 THEN NULL ELSE 'n' || CAST(event_id % 4 AS VARCHAR) END
                   AS item_name,
               CASE WHEN event_id % 5 = 0 THEN NULL
                    ELSE CAST(event_id % 1000 AS INTEGER) END AS quantity,
               CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id * 3 END AS amount,
               CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(ts AS TIMESTAMP) END AS last_updated
        FROM events"""
    q["clean_epoch_out_of_range"] = """
        SELECT event_id,
               CASE WHEN event_id % 4 = 0 THEN DATE '2024-01-01' + CAST(event_id % 300 AS INTEGER)
               END AS visit_date,
               CASE WHEN event_id % 3 = 0 THEN make_timestamp(
                   CAST((1704067200000 + event_id * 1000) * 1000 AS BIGINT)) END AS last_updated
        FROM events"""
    q["inventory_critical_long"] = statement("""
        SELECT warehouse, program, item_type, item_name, COUNT(*) AS items
        FROM stg_inventory WHERE quantity = 0 AND item_name IS NOT NULL GROUP BY ALL""",
        "stg_inventory")
    q["ingest_missing_after_reload"] = "SELECT 'surveys' AS dataset_name"
    columns = {"beneficiaries": "registration_date", "payments": "payment_date",
               "surveys": "survey_date", "inventory": "last_updated",
               "complaints": "complaint_date", "donor_reports": "disbursement_date",
               "afghan_refugees": "registration_date", "refugee_assistance": "delivery_date",
               "refugee_protection": "incident_date"}
    q["dq_freshness"] = statement(
        "SELECT table_name, STRFTIME(m, '%Y-%m-%d %H:%M:%S') AS newest, age_hours, "
        "CASE WHEN age_hours IS NULL OR age_hours > 48 THEN 'error' "
        "WHEN age_hours > 24 THEN 'warn' ELSE 'pass' END AS status FROM (SELECT *, "
        f"DATE_DIFF('second', m, TIMESTAMP '{FRESH_AS_OF}') / 3600 AS age_hours FROM ("
        + " UNION ALL ".join(f"SELECT '{n}' AS table_name, CAST(MAX({c}) AS TIMESTAMP) AS m "
                             f"FROM {n}" for n, c in columns.items()) + "))", *columns)

    # dashboard
    q["dash_extract_payments"] = q["mart_payment_kpis"]
    q["dash_extract_donors"] = q["mart_donor_budget"]
    q["dash_extract_protection"] = q["mart_protection"]
    q["dash_extract_assistance"] = q["mart_refugee_assistance"]
    q["dash_month_range"] = statement(
        "SELECT MIN(reporting_month) AS low, MAX(reporting_month) AS high FROM pay_scope",
        "pay_scope")
    q["dash_payments_in_range"] = statement(
        "SELECT * FROM pay_scope WHERE reporting_month BETWEEN DATE '1996-03-01' "
        "AND DATE '1997-02-01'", "pay_scope")
    q["dash_distinct_values"] = statement(
        "SELECT DISTINCT district FROM pay_scope WHERE district IS NOT NULL", "pay_scope")
    q["dash_success_grid"] = statement(
        "SELECT district, reporting_month, AVG(success_rate) AS success_rate FROM pay_scope "
        "WHERE district IS NOT NULL GROUP BY ALL", "pay_scope")
    q["dash_latest_month"] = statement(
        f"SELECT reporting_month, district, success_rate, {_percent('success_rate')} AS label "
        "FROM pay_scope WHERE reporting_month = (SELECT MAX(reporting_month) FROM pay_scope)",
        "pay_scope")
    q["dash_payment_series"] = statement(
        "SELECT district, reporting_month, success_rate, rolling_3m_avg_success_rate, "
        "total_payments FROM pay_scope WHERE district IN (SELECT DISTINCT district "
        "FROM pay_scope WHERE district IS NOT NULL ORDER BY 1 LIMIT 6)", "pay_scope")
    q["dash_budget_long"] = statement(
        "SELECT donor, program, 'Committed' AS metric, total_committed AS amount "
        "FROM donor_scope UNION ALL SELECT donor, program, 'Disbursed', total_disbursed "
        "FROM donor_scope", "donor_scope")
    q["dash_utilization_ranked"] = statement(
        "SELECT donor, program, utilization_pct, utilization_rank, "
        f"{_percent('utilization_pct')} AS label FROM donor_scope", "donor_scope")
    q["dash_scatter"] = statement(
        "SELECT donor, program, total_committed, total_disbursed, utilization_pct, variance, "
        "utilization_rank, (SELECT GREATEST(MAX(total_committed), MAX(total_disbursed)) "
        "FROM donor_scope) AS axis_max FROM donor_scope", "donor_scope")
    q["dash_utilization_grid"] = statement(
        "SELECT donor, program, AVG(utilization_pct) AS utilization_pct "
        "FROM mart_donor_budget_vs_actual WHERE donor IS NOT NULL AND program IS NOT NULL "
        "GROUP BY ALL", "mart_donor_budget_vs_actual")
    q["dash_cases_by_risk"] = statement(
        "SELECT incident_month, risk_level, CAST(SUM(open_cases) AS BIGINT) AS open_cases, "
        "CAST(SUM(total_cases) AS BIGINT) AS total_cases FROM case_scope GROUP BY ALL",
        "case_scope")
    q["dash_cases_grid"] = statement(
        "SELECT host_district, incident_month, CAST(SUM(total_cases) AS BIGINT) AS total_cases "
        "FROM case_scope WHERE host_district IS NOT NULL GROUP BY ALL", "case_scope")
    q["dash_open_vs_total"] = statement(
        "SELECT incident_month, CAST(SUM(open_cases) AS BIGINT) AS open_cases, "
        "CAST(SUM(total_cases) AS BIGINT) AS total_cases FROM case_scope GROUP BY ALL",
        "case_scope")
    latest = ("(SELECT * FROM case_scope WHERE incident_month = "
              "(SELECT MAX(incident_month) FROM case_scope))")
    q["dash_case_hierarchy"] = statement(
        "SELECT level, risk_level, host_district, CAST(n AS BIGINT) AS total_cases, "
        f"n / (SELECT SUM(total_cases) FROM {latest}) AS share FROM ("
        "SELECT 'risk' AS level, risk_level, NULL AS host_district, SUM(total_cases) AS n "
        f"FROM {latest} GROUP BY risk_level UNION ALL "
        "SELECT 'district', risk_level, host_district, SUM(total_cases) "
        f"FROM {latest} GROUP BY risk_level, host_district)", "case_scope")
    q["dash_reach_and_spend"] = statement(
        "SELECT modality, host_district, total_beneficiaries, total_amount_usd, "
        "delivery_count, avg_amount_usd, avg_vulnerability_score FROM help_scope",
        "help_scope")
    q["dash_marginals"] = statement(" UNION ALL ".join(
        f"SELECT '{c}' AS axis, * FROM ({_histogram('help_scope', c, 20)})"
        for c in ("total_beneficiaries", "total_amount_usd")), "help_scope")
    q["dash_top_districts"] = statement(
        f"SELECT host_district, {_money('total_amount_usd')} AS total_amount_usd "
        "FROM help_scope GROUP BY 1 ORDER BY 2 DESC NULLS LAST, 1 NULLS LAST LIMIT 12",
        "help_scope")
    q["dash_box_modality"] = statement(
        "SELECT modality, COUNT(avg_amount_usd) AS points, " + ", ".join(
            f"ROUND(QUANTILE_CONT(avg_amount_usd, {p}), 6) AS {n}" for p, n in
            ((0.0, "minimum"), (0.25, "lower_quartile"), (0.5, "median"),
             (0.75, "upper_quartile"), (1.0, "maximum")))
        + " FROM help_scope GROUP BY modality", "help_scope")
    q["dash_spend_grid"] = statement(
        f"SELECT host_district, modality, {_money('total_amount_usd')} AS total_amount_usd "
        "FROM help_scope WHERE host_district IS NOT NULL AND modality IS NOT NULL GROUP BY ALL",
        "help_scope")
    q["dash_spend_grid_wide"] = _wide(
        "help_scope", "host_district", "modality", "SUM({when} total_amount_usd END)",
        ["AF", "AO", "NF", "NO", "RF", "RO"])
    q["dash_cases_grid_wide"] = _wide(
        "case_scope", "host_district", "incident_month",
        "CAST(SUM({when} total_cases END) AS BIGINT)",
        [str(m) for m in _months("2024-01", "2025-07")])
    q["dash_success_grid_wide"] = _wide(
        "pay_scope", "district", "reporting_month", "AVG({when} success_rate END)",
        [str(m) for m in _months("1995-01", "2001-07")])
    q["dash_utilization_grid_wide"] = _wide(
        "mart_donor_budget_vs_actual", "donor", "program", "AVG({when} utilization_pct END)",
        ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"])
    q.update(_later(q))
    return q


def _distinct(table: str, level: str, column: str, group: str) -> str:
    return (f"SELECT '{level}' AS level, {column} AS name, COUNT(DISTINCT refugee_id) AS refugees "
            f"FROM {table} {group}")


def _later(q: dict[str, str]) -> dict[str, str]:
    """Queries over stored tables, pieces and explicit choices."""
    out = {
        "mart_donor_budget_many_donors": q["mart_donor_budget"],
        "mart_donor_budget_appended": q["mart_donor_budget"],
        "mart_payment_kpis_appended": q["mart_payment_kpis"],
        "mart_protection_appended": q["mart_protection"],
        "int_beneficiaries_payments_bucketed": q["int_beneficiaries_payments"],
        "int_refugees_assistance_bucketed": q["int_refugees_assistance"],
        "dq_freshness_footers": q["dq_freshness"],
    }
    same = {"amount": "0", "payment_date": "DATE '1995-01-01'"}
    cells = ", ".join(
        f"CASE WHEN amount % 3 = 0 THEN {same.get(c, chr(39) + 'same' + chr(39))} ELSE {c} END AS {c}"
        for c in ("payment_id", "beneficiary_id", "amount", "payment_date", "payment_mode",
                  "payment_status", "bank_code", "transaction_ref", "disbursement_center"))
    out["clean_dedup_digest"] = statement(
        f"SELECT DISTINCT {cells} FROM ({_bronze('payments')})", "payments")
    out["win_rank_hot_key"] = statement(
        "SELECT payment_id, bank, size, RANK() OVER (PARTITION BY bank "
        "ORDER BY size DESC NULLS LAST) AS place FROM (SELECT payment_id, "
        "CASE WHEN amount % 3 = 0 THEN 'HOT' ELSE bank_code END AS bank, "
        "CASE WHEN amount % 7 <> 0 THEN FLOOR(amount / 500) END AS size FROM stg_payments)",
        "stg_payments")
    rows = "stg_refugee_assistance"
    out["distinct_refugees"] = statement(" UNION ALL ".join((
        _distinct(rows, "district", "host_district", "GROUP BY 2"),
        _distinct(rows, "program", "program", "GROUP BY 2"),
        _distinct(rows, "all", "'all'", ""))), rows)
    out["quantiles_payments"] = statement(
        "SELECT payment_mode, COUNT(amount) AS n, " + ", ".join(
            f"ROUND(QUANTILE_CONT(CAST(amount AS DOUBLE), {p}), 6) AS q{round(p * 100)}"
            for p in (0.0, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0))
        + " FROM stg_payments GROUP BY payment_mode", "stg_payments")
    out["lake_bounds"] = statement(
        "SELECT MIN(reporting_month) AS low, MAX(reporting_month) AS high, COUNT(*) AS rows "
        "FROM mart_payment_kpis", "mart_payment_kpis")
    out["lake_sql"] = statement(
        "SELECT payment_mode, COUNT(*) AS payments, MAX(amount) AS largest FROM payments "
        "WHERE payment_status = 'Success' GROUP BY payment_mode", "payments")
    out["layer_row_counts_footers"] = statement(" UNION ALL ".join(
        f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {n}"
        for n in ALL_ENTITIES), *ALL_ENTITIES)
    out["ntile_by_text"] = statement(
        "SELECT beneficiary_key, name, NTILE(25) OVER (ORDER BY name NULLS LAST, "
        "md5(beneficiary_key), beneficiary_key) AS tile FROM stg_beneficiaries",
        "stg_beneficiaries")
    places = "CASE WHEN length(item_name) % 3 = 0 THEN 'HOT' ELSE {c} END AS {c}"
    out["kpi_inventory_reorder_hot_place"] = statement(
        "SELECT warehouse, program, item_type, COUNT(*) AS total_items, "
        "COUNT(*) FILTER (WHERE quantity < reorder_level) AS items_below_reorder, "
        "ROUND(COUNT(*) FILTER (WHERE quantity < reorder_level) / COUNT(*), 4) AS alert_pct, "
        "STRING_AGG(item_name, ', ' ORDER BY item_name) FILTER (WHERE quantity = 0) "
        "AS critical_items FROM (SELECT item_name, reorder_level, "
        + ", ".join(places.format(c=c) for c in ("warehouse", "program", "item_type"))
        + ", CASE WHEN length(item_name) % 3 = 0 THEN quantity % 2 ELSE quantity END AS quantity "
        "FROM stg_inventory) GROUP BY ALL", "stg_inventory")
    cases = "mart_protection_caseload"
    out["dash_latest_cases"] = statement(
        f"SELECT * FROM {cases} WHERE incident_type = 'purchase' AND incident_month = "
        f"(SELECT MAX(incident_month) FROM {cases})", cases)
    out["dash_cases_chosen"] = statement(
        "SELECT incident_month, risk_level, CAST(SUM(open_cases) AS BIGINT) AS open_cases, "
        f"CAST(SUM(total_cases) AS BIGINT) AS total_cases FROM {cases} "
        "WHERE incident_type = 'purchase' AND risk_level IN ('Critical', 'High') AND "
        "incident_month BETWEEN DATE '2024-03-01' AND DATE '2024-12-01' GROUP BY ALL", cases)
    pay = ("(SELECT * REPLACE (ROUND(rolling_3m_avg_success_rate, 9) AS "
           "rolling_3m_avg_success_rate) FROM mart_payment_kpis "
           "WHERE program = 'MACHINERY' AND reporting_month IS NOT NULL)")
    out["dash_payments_program"] = statement(f"SELECT * FROM {pay}", "mart_payment_kpis")
    out["dash_series_districts"] = statement(
        "SELECT district, reporting_month, success_rate, rolling_3m_avg_success_rate, "
        f"total_payments FROM {pay} WHERE district IN ('NATION_3', 'NATION_7')",
        "mart_payment_kpis")
    donors = "mart_donor_budget_vs_actual"
    out["dash_budget_program"] = statement(" UNION ALL ".join(
        f"SELECT donor, program, '{label}' AS metric, {c} AS amount FROM {donors} "
        "WHERE program = 'PROMO'" for label, c in
        (("Committed", "total_committed"), ("Disbursed", "total_disbursed"))), donors)
    out["dash_utilization_program"] = statement(
        "SELECT donor, program, utilization_pct, utilization_rank, "
        f"{_percent('utilization_pct')} AS label FROM {donors} WHERE program = 'PROMO'", donors)
    help_ = "mart_refugee_assistance_summary"
    out["dash_top_districts_program"] = statement(
        f"SELECT host_district, {_money('total_amount_usd')} AS total_amount_usd FROM {help_} "
        "WHERE program = 'MACHINERY' GROUP BY 1 ORDER BY 2 DESC NULLS LAST, 1 NULLS LAST LIMIT 5",
        help_)
    return out
