"""The nine programme entities as views over the TPC-H-like test tables.

The text runs unchanged in Spark and DuckDB; table names are placeholders.
FIXTURES.md section 4 explains the bindings.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

TABLES = ("nation", "customer", "part", "orders", "lineitem", "events")

ENTITY_SQL: dict[str, str] = {
    "beneficiaries": """
SELECT 'B' || CAST(c_custkey AS STRING) AS beneficiary_id,
       CAST(3000000000000 + c_custkey AS STRING) AS cnic,
       c_name AS name,
       CASE WHEN c_custkey % 10 < 7 THEN 'Female' ELSE 'Male' END AS gender,
       CAST(18 + c_custkey % 48 AS INT) AS age,
       CASE WHEN c_custkey % 13 = 0 THEN '' ELSE '03' || CAST(c_custkey % 90 + 10 AS STRING) END AS phone,
       n_name AS district,
       CASE WHEN c_custkey % 11 = 0 THEN '' ELSE 'T' || CAST(c_custkey % 40 AS STRING) END AS tehsil,
       'UC-' || CAST(c_custkey % 100 + 1 AS STRING) AS union_council,
       c_mktsegment AS program,
       DATE '2021-01-01' + CAST(c_custkey % 1000 AS INT) AS registration_date,
       CAST(c_custkey * 37 % 10000 AS DOUBLE) / 100 AS poverty_score,
       CAST(2 + c_custkey % 11 AS INT) AS family_size,
       c_custkey % 20 = 0 AS is_disabled,
       c_custkey % 7 <> 0 AS is_eligible,
       CASE WHEN c_custkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS bank_account,
       DATE '2023-06-01' + CAST(c_custkey % 365 AS INT) AS last_payment_date
FROM {customer} LEFT JOIN {nation} ON c_nationkey = n_nationkey
""",
    "payments": """
SELECT 'P' || CAST(o_orderkey AS STRING) AS payment_id,
       CASE WHEN o_orderkey % 97 = 0 THEN NULL
            WHEN o_orderkey % 89 = 0 THEN 'B-none'
            ELSE 'B' || CAST(o_custkey AS STRING) END AS beneficiary_id,
       CAST(FLOOR(o_totalprice) AS BIGINT) AS amount,
       CAST(o_orderdate AS DATE) AS payment_date,
       CASE o_orderkey % 4 WHEN 0 THEN 'Bank Transfer' WHEN 1 THEN 'Cash' WHEN 2 THEN 'Mobile Wallet' ELSE 'ATM Card' END AS payment_mode,
       CASE o_orderstatus WHEN 'F' THEN 'Success' WHEN 'O' THEN 'Failed' ELSE 'Pending' END AS payment_status,
       'BANK' || CAST(o_custkey % 20 + 1 AS STRING) AS bank_code,
       'T' || CAST(o_orderkey * 7 AS STRING) AS transaction_ref,
       o_orderpriority AS disbursement_center
FROM {orders}
""",
    "surveys": """
SELECT 'S' || CAST(event_id AS STRING) AS survey_id,
       'B' || CAST(user_id AS STRING) AS beneficiary_id,
       CAST(ts AS DATE) + CAST(event_id % 540 AS INT) AS survey_date,
       CASE user_id % 3 WHEN 0 THEN 'BUILDING' WHEN 1 THEN 'MACHINERY' ELSE 'FURNITURE' END AS program,
       event_type AS metric_type,
       CAST(FLOOR(value) AS INT) AS metric_value,
       'W' || CAST(user_id % 9 AS STRING) AS field_worker,
       'NATION_' || CAST(user_id % 25 AS STRING) AS district,
       CAST(event_id % 50 + 50 AS DOUBLE) / 100 AS data_quality_score,
       event_id % 5 <> 0 AS is_verified
FROM {events}
""",
    "inventory": """
SELECT 'I' || CAST(p_partkey AS STRING) AS item_id,
       p_name AS item_name,
       p_type AS item_type,
       CAST(CASE WHEN p_partkey % 17 = 0 THEN 0 ELSE p_partkey * 7 % 500 END AS INT) AS quantity,
       CASE p_size % 3 WHEN 0 THEN 'kg' WHEN 1 THEN 'pcs' ELSE 'doses' END AS unit,
       p_brand AS warehouse,
       CAST('2024-01-01 00:00:00' AS TIMESTAMP) AS last_updated,
       CAST(50 + p_size * 5 AS INT) AS reorder_level,
       CASE p_partkey % 4 WHEN 0 THEN 'PR0' WHEN 1 THEN 'PR1' WHEN 2 THEN 'PR2' ELSE 'PR3' END AS program,
       'SUP' || CAST(p_partkey % 12 AS STRING) AS supplier
FROM {part}
""",
    "complaints": """
SELECT 'C' || CAST(o_orderkey AS STRING) AS complaint_id,
       CAST(3000000000000 + o_custkey AS STRING) AS cnic,
       CAST(o_orderdate AS DATE) AS complaint_date,
       o_orderpriority AS category,
       'text ' || CAST(o_orderkey AS STRING) AS description,
       CASE o_orderkey % 4 WHEN 0 THEN 'Open' WHEN 1 THEN 'In Progress' WHEN 2 THEN 'Resolved' ELSE 'Rejected' END AS status,
       CASE WHEN o_orderkey % 10 < 3 THEN NULL
            ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey * 13 % 130 - 10 AS INT) END AS resolution_date,
       'A' || CAST(o_custkey % 30 AS STRING) AS assigned_to,
       n_name AS district
FROM {orders} LEFT JOIN {customer} ON o_custkey = c_custkey LEFT JOIN {nation} ON c_nationkey = n_nationkey
""",
    "donor_reports": """
SELECT 'R' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) AS report_id,
       'DONOR_' || CAST(l_suppkey % 12 AS STRING) AS donor,
       p_type AS program,
       'NATION_' || CAST(l_suppkey % 25 AS STRING) AS district,
       l_extendedprice AS amount_committed,
       CASE WHEN l_orderkey % 101 = 0 THEN NULL
            ELSE CAST(FLOOR(l_extendedprice * (1 + l_tax - l_discount) * 100) AS DOUBLE) / 100 END AS amount_disbursed,
       CAST(l_shipdate AS DATE) AS disbursement_date,
       'PKR' AS currency,
       'PK-' || CAST(l_partkey % 9000 + 1000 AS STRING) AS project_code,
       'Q' || CAST(l_linenumber % 4 + 1 AS STRING) || ' 2024' AS reporting_period
FROM {lineitem} LEFT JOIN {part} ON l_partkey = p_partkey
""",
    "afghan_refugees": """
SELECT 'F' || CAST(c_custkey AS STRING) AS refugee_id,
       'PAK-' || CAST(100000 + c_custkey AS STRING) AS unhcr_case_number,
       c_name AS name,
       CASE WHEN c_custkey % 25 < 13 THEN 'Male' ELSE 'Female' END AS gender,
       CAST(c_custkey % 76 AS INT) AS age,
       'NATION_' || CAST(c_nationkey % 15 AS STRING) AS province_of_origin,
       CASE c_custkey % 6 WHEN 0 THEN 'Pre-1979' WHEN 1 THEN '1979-1989' WHEN 2 THEN '1992-1996' WHEN 3 THEN '2001-2010' WHEN 4 THEN '2011-2020' ELSE '2021+' END AS arrival_wave,
       CASE c_custkey % 4 WHEN 0 THEN 'PoR Card' WHEN 1 THEN 'ACC' WHEN 2 THEN 'Undocumented' ELSE 'Passport' END AS documentation_type,
       'CAMP_' || CAST(c_custkey % 9 AS STRING) AS camp_settlement,
       n_name AS host_district,
       CAST(1 + c_custkey % 14 AS INT) AS family_size,
       CASE WHEN c_custkey % 211 = 0 THEN NULL ELSE CAST(c_custkey * 73 % 1001 AS DOUBLE) / 100 END AS vulnerability_score,
       c_custkey % 25 = 0 AS is_unaccompanied_minor,
       c_custkey % 14 = 0 AS has_disability,
       c_mktsegment AS enrolled_in_program,
       DATE '2019-01-01' + CAST(c_custkey % 1800 AS INT) AS registration_date,
       DATE '2022-01-01' + CAST(c_custkey % 700 AS INT) AS last_verification,
       CASE WHEN c_custkey % 20 < 4 THEN 'Yes' WHEN c_custkey % 20 < 13 THEN 'No' ELSE 'Undecided' END AS return_intention
FROM {customer} LEFT JOIN {nation} ON c_nationkey = n_nationkey
""",
    "refugee_assistance": """
SELECT 'A' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) AS assistance_id,
       CASE WHEN o_custkey % 53 = 0 THEN 'F-none' ELSE 'F' || CAST(o_custkey AS STRING) END AS refugee_id,
       c_mktsegment AS program,
       l_returnflag || l_linestatus AS modality,
       CAST(FLOOR(l_extendedprice * 100 / 200) AS DOUBLE) / 100 AS amount_usd,
       l_extendedprice AS amount_pkr,
       CAST(l_shipdate AS DATE) AS delivery_date,
       CASE l_linenumber % 3 WHEN 0 THEN 'Mobile Unit' WHEN 1 THEN 'Bank Transfer' ELSE 'Hawala' END AS delivery_point,
       CASE WHEN l_orderkey % 25 < 22 THEN 'Delivered' WHEN l_orderkey % 25 < 24 THEN 'Pending' ELSE 'Failed' END AS status,
       'ORG_' || CAST(l_suppkey % 6 AS STRING) AS implementing_org,
       'NATION_' || CAST(l_suppkey % 13 AS STRING) AS host_district
FROM {lineitem} LEFT JOIN {orders} ON l_orderkey = o_orderkey LEFT JOIN {customer} ON o_custkey = c_custkey
""",
    "refugee_protection": """
SELECT 'K' || CAST(event_id AS STRING) AS case_id,
       'F' || CAST(user_id AS STRING) AS refugee_id,
       event_type AS incident_type,
       CAST(ts AS DATE) + CAST(event_id % 540 AS INT) AS incident_date,
       CASE event_id % 5 WHEN 0 THEN 'UNHCR' WHEN 1 THEN 'Police' WHEN 2 THEN 'NGO Partner' WHEN 3 THEN 'Community Leader' ELSE 'Not Reported' END AS reported_to,
       CASE event_id % 4 WHEN 0 THEN 'Open' WHEN 1 THEN 'Under Review' WHEN 2 THEN 'Referred' ELSE 'Closed' END AS case_status,
       CASE event_id * 3 % 7 WHEN 0 THEN 'Critical' WHEN 1 THEN 'High' WHEN 2 THEN 'High' WHEN 3 THEN 'Medium' ELSE 'Low' END AS risk_level,
       'NATION_' || CAST(user_id % 13 AS STRING) AS host_district,
       'W' || CAST(event_id % 40 AS STRING) AS case_worker,
       CASE WHEN event_id % 4 = 1 THEN NULL ELSE CAST(ts AS DATE) + CAST(event_id % 540 + event_id % 90 AS INT) END AS follow_up_date
FROM {events}
""",
}


def entity(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One entity over the parquet tables in ``sf_dir``."""
    text = ENTITY_SQL[name]
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
            for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def entity_sql(name: str) -> str:
    """The same entity for an engine that knows the tables by name."""
    return re.sub(r"\{(\w+)\}", r"\1", ENTITY_SQL[name]).strip()


def with_entities(names: Iterable[str], ctes: Iterable[tuple[str, str]], final: str) -> str:
    """``WITH entities, ctes final`` as one statement."""
    parts = [(n, entity_sql(n)) for n in names] + list(ctes)
    body = ",\n".join(f"{n} AS (\n{sql}\n)" for n, sql in parts)
    return f"WITH {body}\n{final}" if body else final
