"""The 22 raw domain tables, derived from the driver's tables.

Each text is plain SQL that Spark and DuckDB read the same way; ``{orders}`` and
the like stand for the driver tables. Every table is built from all rows of its
driver table; dirt (NULLs, padding, shared phones) is set by CASE on the key.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Column contracts of the raw tables (name type, in order).
SCHEMAS: dict[str, str] = {
    "hospital": "hospital_id string, hospital_name string, hospital_type string, governorate string, "
    "district string, phone string, total_beds int, icu_capacity int, latitude decimal(9,6), "
    "longitude decimal(9,6), manager_name string, manager_email string, manager_phone string",
    "department": "department_id string, hospital_id string, department_name string, "
    "floor_number double, manager_phone bigint",
    "doctor": "doctor_id string, first_name string, last_name string, phone string, specialty string, "
    "employment_status string, hospital_id string, department_id string, years_experience int",
    "patient": "patient_id string, national_id string, first_name string, last_name string, gender string, "
    "birth_date date, phone bigint, emergency_contact bigint, street string, city string, "
    "governorate string, blood_type string",
    "diagnosis": "diagnosis_code string, diagnosis_name string, diagnosis_category string, severity_level string",
    "medical_procedure": "procedure_code string, procedure_name string, procedure_category string, "
    "expected_amount double, complexity_score int",
    "drug": "drug_id string, drug_name string, generic_name string, manufacturer string, "
    "drug_category string, unit_amount double",
    "visit": "visit_id string, patient_id string, doctor_id string, hospital_id string, department_id string, "
    "diagnosis_code string, visit_type string, visit_status string, symptoms string, visit_date date, "
    "waiting_time int, total_amount double",
    "visit_procedure": "visit_procedure_id string, visit_id string, procedure_code string, "
    "procedure_date date, procedure_amount double",
    "claim": "claim_id string, patient_id string, visit_id string, hospital_id string, claim_status string, "
    "claim_date date, claim_amount double, approved_amount double",
    "claim_item": "claim_item_id string, claim_id string, procedure_code string, drug_id string, "
    "quantity int, item_amount double",
    "claim_approval": "approval_id string, claim_id string, approval_status string, rejection_reason string, "
    "reviewed_by string, approval_date date",
    "prescription": "prescription_id string, visit_id string, prescription_date date",
    "prescription_item": "prescription_item_id string, prescription_id string, drug_id string, "
    "frequency string, quantity int, duration_days int",
    "drug_inventory": "inventory_id string, hospital_id string, drug_id string, quantity_available int, "
    "reorder_level int, expiration_date date",
    "drug_transaction": "transaction_id string, hospital_id string, drug_id string, transaction_type string, "
    "performed_by string, quantity int, transaction_date date",
    "patient_feedback": "feedback_id string, patient_id string, hospital_id string, doctor_id string, "
    "comments string, rating int",
    "icu_status": "icu_status_id string, hospital_id string, occupied_beds int, available_beds int, "
    "update_time timestamp_ntz",
    "referral": "referral_id string, patient_id string, from_hospital_id string, to_hospital_id string, "
    "referral_status string, referral_reason string, referral_date date",
    "doctor_schedule": "schedule_id string, doctor_id string, shift_type string, shift_date date",
    "bed": "bed_id string, hospital_id string, department_id string, bed_type string, availability_status string",
    "medical_record": "record_id string, patient_id string, record_type string, record_date date",
}

DOMAIN_SQL: dict[str, str] = {
    "hospital": """
        SELECT concat('H', cast(n_nationkey AS string)) AS hospital_id,
               CASE WHEN n_nationkey % 7 = 3 THEN concat('  ', n_name, ' ') ELSE n_name END AS hospital_name,
               CASE n_regionkey WHEN 0 THEN 'Public' WHEN 1 THEN 'Private' WHEN 2 THEN 'University'
                    ELSE 'Specialized' END AS hospital_type,
               r_name AS governorate,
               CASE WHEN n_nationkey % 9 = 5 THEN NULL
                    ELSE concat('District ', cast(n_nationkey % 4 AS string)) END AS district,
               CASE n_nationkey % 4
                    WHEN 0 THEN concat('0100123', cast(1000 + n_nationkey AS string))
                    WHEN 1 THEN concat('+20 101 234 ', cast(2000 + n_nationkey AS string))
                    WHEN 2 THEN concat('20102345', cast(3000 + n_nationkey AS string))
                    ELSE NULL END AS phone,
               CASE WHEN n_nationkey % 12 = 11 THEN 0 ELSE cast(40 + (n_nationkey * 7) % 60 AS int) END AS total_beds,
               CASE WHEN n_nationkey % 12 = 10 THEN 0 WHEN n_nationkey % 12 = 6 THEN 90
                    ELSE cast(10 + n_nationkey % 5 AS int) END AS icu_capacity,
               cast(22 + n_nationkey * 0.25 AS decimal(9,6)) AS latitude,
               cast(25 + n_nationkey * 0.5 AS decimal(9,6)) AS longitude,
               CASE WHEN n_nationkey % 8 = 4 THEN NULL
                    ELSE concat('Manager ', cast(n_nationkey AS string)) END AS manager_name,
               CASE WHEN n_nationkey % 6 = 2 THEN 'no-mail'
                    ELSE concat('m', cast(n_nationkey AS string), '@example.org') END AS manager_email,
               CASE WHEN n_nationkey % 5 = 1 THEN NULL
                    ELSE concat('0111-222-', cast(4000 + n_nationkey AS string)) END AS manager_phone
        FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "department": """
        SELECT concat('DP', cast(nation_id * 6 + slot AS string)) AS department_id,
               concat('H', cast(nation_id AS string)) AS hospital_id,
               CASE slot WHEN 0 THEN 'Emergency' WHEN 1 THEN ' Cardiology ' WHEN 2 THEN 'Surgery'
                    WHEN 3 THEN 'Pediatrics' WHEN 4 THEN NULL ELSE 'Radiology' END AS department_name,
               CASE WHEN slot = 5 THEN NULL ELSE cast(slot AS double) END AS floor_number,
               CASE WHEN nation_id % 6 = 5 THEN NULL
                    ELSE cast(1200000000 + nation_id * 6 + slot AS bigint) END AS manager_phone
        FROM (SELECT DISTINCT s_nationkey AS nation_id, s_suppkey % 6 AS slot FROM {supplier}) AS s""",
    "doctor": """
        SELECT concat('DR', cast(s_suppkey AS string)) AS doctor_id,
               CASE WHEN s_suppkey % 17 = 4 THEN NULL
                    ELSE concat('First', cast(s_suppkey % 30 AS string)) END AS first_name,
               CASE WHEN s_suppkey % 13 = 2 THEN concat(' ', s_name, '  ') ELSE s_name END AS last_name,
               CASE WHEN s_suppkey % 19 = 6 THEN NULL
                    WHEN s_suppkey % 5 = 0 THEN concat('+20-109-123-', cast(1000 + s_suppkey % 9000 AS string))
                    ELSE concat('010', cast(10000000 + s_suppkey AS string)) END AS phone,
               CASE s_suppkey % 5 WHEN 0 THEN 'Cardiology' WHEN 1 THEN 'Surgery' WHEN 2 THEN 'Pediatrics'
                    WHEN 3 THEN ' Radiology' ELSE 'ICU' END AS specialty,
               CASE WHEN s_acctbal < 0 THEN 'On Leave' WHEN s_acctbal < 5000 THEN 'Full Time'
                    ELSE 'Part Time' END AS employment_status,
               concat('H', cast(s_nationkey AS string)) AS hospital_id,
               concat('DP', cast(s_nationkey * 6 + s_suppkey % 6 AS string)) AS department_id,
               CASE WHEN s_suppkey % 23 = 7 THEN NULL WHEN s_suppkey % 29 = 11 THEN 95
                    ELSE cast(s_suppkey % 40 AS int) END AS years_experience
        FROM {supplier}""",
    "patient": """
        SELECT concat('P', cast(c_custkey AS string)) AS patient_id,
               CASE WHEN c_custkey % 43 = 9 THEN NULL WHEN c_custkey % 47 = 3 THEN 'N/A'
                    ELSE concat('29', cast(100000000000 + c_custkey AS string)) END AS national_id,
               CASE WHEN c_custkey % 17 = 5 THEN NULL
                    ELSE concat('First', cast(c_custkey % 50 AS string)) END AS first_name,
               CASE WHEN c_custkey % 13 = 6 THEN concat('  ', c_name, ' ') ELSE c_name END AS last_name,
               CASE WHEN c_custkey % 31 = 8 THEN 'other' WHEN c_custkey % 2 = 0 THEN 'Female'
                    ELSE 'Male' END AS gender,
               CASE WHEN c_custkey % 53 = 10 THEN NULL WHEN c_custkey % 59 = 12 THEN DATE '2090-01-01'
                    ELSE DATE '1930-01-01' + cast((c_custkey * 37) % 25900 AS int) END AS birth_date,
               CASE WHEN c_custkey % 41 = 14 THEN cast(900000000 + c_custkey AS bigint)
                    WHEN c_custkey % 29 = 15 THEN cast(1100000000 + c_custkey % 3 AS bigint)
                    WHEN c_custkey % 37 = 16 THEN NULL
                    ELSE cast(1000000000 + c_custkey AS bigint) END AS phone,
               CASE WHEN c_custkey % 23 = 18 THEN NULL
                    WHEN c_custkey % 19 = 1 THEN cast(1000000000 + c_custkey AS bigint)
                    ELSE cast(1200000000 + c_custkey AS bigint) END AS emergency_contact,
               concat('Street ', cast(c_custkey % 200 AS string)) AS street,
               CASE WHEN c_custkey % 61 = 20 THEN NULL ELSE c_mktsegment END AS city,
               concat('Governorate ', cast(c_nationkey AS string)) AS governorate,
               CASE c_custkey % 9 WHEN 0 THEN 'A+' WHEN 1 THEN 'A-' WHEN 2 THEN 'B+' WHEN 3 THEN 'B-'
                    WHEN 4 THEN 'AB+' WHEN 5 THEN 'AB-' WHEN 6 THEN 'O+' WHEN 7 THEN 'O-'
                    ELSE 'Z' END AS blood_type
        FROM {customer}""",
    "diagnosis": """
        SELECT concat('DX', substring(p_brand, 7)) AS diagnosis_code,
               concat(p_brand, ' disease ') AS diagnosis_name,
               CASE WHEN length(p_brand) = 7 THEN 'Acute' ELSE 'Chronic' END AS diagnosis_category,
               CASE WHEN p_brand LIKE '%5' THEN NULL WHEN p_brand LIKE '%1' THEN 'Severe'
                    WHEN p_brand LIKE '%2' THEN 'Moderate' ELSE 'Mild' END AS severity_level
        FROM (SELECT DISTINCT p_brand FROM {part}) AS b""",
    "medical_procedure": """
        SELECT concat('PR', cast(p_partkey AS string)) AS procedure_code,
               CASE WHEN p_partkey % 11 = 3 THEN concat(p_name, ' ') ELSE p_name END AS procedure_name,
               p_type AS procedure_category,
               CASE WHEN p_partkey % 14 = 5 THEN NULL ELSE p_retailprice END AS expected_amount,
               CASE WHEN p_partkey % 16 = 7 THEN NULL ELSE p_size END AS complexity_score
        FROM {part}""",
    "drug": """
        SELECT concat('D', cast(p_partkey AS string)) AS drug_id,
               p_name AS drug_name,
               CASE WHEN p_partkey % 15 = 4 THEN NULL ELSE concat('generic ', p_name) END AS generic_name,
               CASE WHEN p_partkey % 10 = 3 THEN concat(' ', p_brand, ' ') ELSE p_brand END AS manufacturer,
               p_type AS drug_category,
               CASE WHEN p_partkey % 21 = 6 THEN NULL ELSE p_retailprice END AS unit_amount
        FROM {part}""",
    "visit": """
        SELECT concat('V', cast(o_orderkey AS string)) AS visit_id,
               concat('P', cast(o_custkey AS string)) AS patient_id,
               concat('DR', cast(s_suppkey AS string)) AS doctor_id,
               concat('H', cast(s_nationkey AS string)) AS hospital_id,
               concat('DP', cast(s_nationkey * 6 + s_suppkey % 6 AS string)) AS department_id,
               concat('DX', cast(1 + o_orderkey % 25 AS string)) AS diagnosis_code,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'Inpatient' WHEN '2-HIGH' THEN 'Inpatient'
                    WHEN '3-MEDIUM' THEN 'Follow-up' ELSE 'Outpatient' END AS visit_type,
               CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN ' Cancelled'
                    ELSE 'Scheduled' END AS visit_status,
               CASE WHEN o_orderkey % 27 = 4 THEN NULL
                    ELSE concat('symptom ', cast(o_orderkey % 12 AS string)) END AS symptoms,
               cast(o_orderdate AS date) AS visit_date,
               CASE WHEN o_orderkey % 33 = 5 THEN NULL ELSE cast(o_orderkey % 90 AS int) END AS waiting_time,
               CASE WHEN o_orderkey % 23 = 6 THEN NULL ELSE o_totalprice END AS total_amount
        FROM {orders} JOIN {supplier} ON s_suppkey = o_orderkey % (SELECT count(*) FROM {supplier})""",
    "visit_procedure": """
        SELECT concat('VP', cast(l_orderkey AS string), '-', cast(l_linenumber AS string)) AS visit_procedure_id,
               concat('V', cast(l_orderkey AS string)) AS visit_id,
               concat('PR', cast(l_partkey AS string)) AS procedure_code,
               cast(CASE WHEN l_linestatus = 'O' THEN o_orderdate ELSE l_shipdate END AS date) AS procedure_date,
               CASE WHEN l_partkey % 39 = 7 THEN NULL ELSE l_extendedprice END AS procedure_amount
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "claim": """
        SELECT concat('C', cast(o_orderkey AS string)) AS claim_id,
               concat('P', cast(o_custkey AS string)) AS patient_id,
               concat('V', cast(o_orderkey AS string)) AS visit_id,
               concat('H', cast(s_nationkey AS string)) AS hospital_id,
               CASE o_orderstatus WHEN 'F' THEN 'Approved' WHEN 'O' THEN 'Rejected'
                    ELSE ' Pending Review ' END AS claim_status,
               cast(o_orderdate AS date) AS claim_date,
               CASE WHEN o_orderkey % 101 = 8 THEN 0.0e0 WHEN o_orderkey % 17 = 2 THEN o_totalprice * 0.015625e0
                    ELSE o_totalprice END AS claim_amount,
               CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'O' THEN 0.0e0
                    ELSE CASE WHEN o_orderkey % 101 = 8 THEN 0.0e0 WHEN o_orderkey % 17 = 2 THEN 10.5e0
                              WHEN o_orderpriority < '3' THEN o_totalprice
                              ELSE o_totalprice * 0.5e0 END END AS approved_amount
        FROM {orders} JOIN {supplier} ON s_suppkey = o_orderkey % (SELECT count(*) FROM {supplier})""",
    "claim_item": """
        SELECT concat('CI', cast(l_orderkey AS string), '-', cast(l_linenumber AS string)) AS claim_item_id,
               concat('C', cast(l_orderkey AS string)) AS claim_id,
               CASE WHEN l_linestatus = 'O' THEN concat('PR', cast(l_partkey AS string)) END AS procedure_code,
               CASE WHEN l_linestatus = 'F' THEN concat('D', cast(l_partkey AS string)) END AS drug_id,
               CASE WHEN l_partkey % 35 = 8 THEN NULL ELSE cast(l_quantity AS int) END AS quantity,
               CASE WHEN l_partkey % 38 = 9 THEN NULL ELSE l_extendedprice END AS item_amount
        FROM {lineitem}""",
    "claim_approval": """
        SELECT concat('A', cast(o_orderkey AS string)) AS approval_id,
               concat('C', cast(o_orderkey AS string)) AS claim_id,
               CASE o_orderstatus WHEN 'F' THEN 'Approved' ELSE 'Rejected' END AS approval_status,
               CASE WHEN o_orderstatus = 'O' AND o_orderpriority < '3' THEN 'Not covered'
                    WHEN o_orderstatus = 'O' AND o_orderpriority < '5' THEN 'Missing documents' END AS rejection_reason,
               concat('Reviewer ', cast(o_custkey % 7 AS string)) AS reviewed_by,
               CASE WHEN o_orderkey % 67 = 9 THEN NULL
                    ELSE cast(o_orderdate AS date) + cast(o_orderkey % 12 AS int) END AS approval_date
        FROM {orders}
        WHERE o_orderstatus <> 'P'""",
    "prescription": """
        SELECT concat('RX', cast(o_orderkey AS string)) AS prescription_id,
               concat('V', cast(o_orderkey AS string)) AS visit_id,
               cast(o_orderdate AS date) AS prescription_date
        FROM {orders}
        WHERE o_orderpriority <> '5-LOW'""",
    "prescription_item": """
        SELECT concat('RI', cast(l_orderkey AS string), '-', cast(l_linenumber AS string)) AS prescription_item_id,
               concat('RX', cast(l_orderkey AS string)) AS prescription_id,
               concat('D', cast(l_partkey AS string)) AS drug_id,
               CASE l_returnflag WHEN 'A' THEN 'Once Daily' WHEN 'N' THEN ' Twice Daily'
                    ELSE 'Three Times Daily' END AS frequency,
               cast(l_quantity AS int) AS quantity,
               CASE WHEN l_partkey % 44 = 10 THEN NULL ELSE cast(l_linenumber * 3 AS int) END AS duration_days
        FROM {lineitem}""",
    "drug_inventory": """
        SELECT concat('I', cast(s_nationkey AS string), '-', cast(l_partkey AS string), '-', l_returnflag) AS inventory_id,
               concat('H', cast(s_nationkey AS string)) AS hospital_id,
               concat('D', cast(l_partkey AS string)) AS drug_id,
               CASE WHEN l_partkey % 46 = 11 THEN NULL ELSE cast(max(l_quantity) AS int) END AS quantity_available,
               cast(10 + l_partkey % 20 AS int) AS reorder_level,
               cast(max(l_shipdate) AS date) + 45 AS expiration_date
        FROM {lineitem} JOIN {supplier} ON s_suppkey = l_orderkey % (SELECT count(*) FROM {supplier})
        GROUP BY s_nationkey, l_partkey, l_returnflag""",
    "drug_transaction": """
        SELECT concat('T', cast(l_orderkey AS string), '-', cast(l_linenumber AS string)) AS transaction_id,
               concat('H', cast(s_nationkey AS string)) AS hospital_id,
               concat('D', cast(l_partkey AS string)) AS drug_id,
               CASE WHEN l_linenumber = 7 AND l_returnflag = 'N' THEN 'Wastage'
                    WHEN l_returnflag = 'A' THEN 'Purchase' WHEN l_returnflag = 'N' THEN 'Dispensing'
                    ELSE ' Return' END AS transaction_type,
               concat('Staff ', cast(l_suppkey % 40 AS string)) AS performed_by,
               CASE WHEN l_partkey % 48 = 12 THEN NULL ELSE cast(l_quantity AS int) END AS quantity,
               cast(CASE WHEN l_linestatus = 'O' THEN o_orderdate ELSE l_shipdate END AS date) AS transaction_date
        FROM {lineitem}
        JOIN {orders} ON l_orderkey = o_orderkey
        JOIN {supplier} ON s_suppkey = l_orderkey % (SELECT count(*) FROM {supplier})""",
    "patient_feedback": """
        SELECT concat('F', cast(event_id AS string)) AS feedback_id,
               concat('P', cast(user_id AS string)) AS patient_id,
               concat('H', cast(s_nationkey AS string)) AS hospital_id,
               concat('DR', cast(s_suppkey AS string)) AS doctor_id,
               CASE WHEN event_id % 21 = 3 THEN NULL ELSE concat(' note ', event_type, ' ') END AS comments,
               CASE WHEN event_id % 19 = 4 THEN NULL ELSE cast(1 + event_id % 5 AS int) END AS rating
        FROM {events} JOIN {supplier} ON s_suppkey = event_id % (SELECT count(*) FROM {supplier})
        WHERE event_type IN ('click', 'view')""",
    "icu_status": """
        SELECT concat('U', cast(event_id AS string)) AS icu_status_id,
               concat('H', cast(event_id % 25 AS string)) AS hospital_id,
               CASE WHEN event_id % 15 = 5 THEN NULL ELSE cast(event_id % 12 AS int) END AS occupied_beds,
               cast(event_id % 7 AS int) AS available_beds,
               ts AS update_time
        FROM {events}
        WHERE event_type = 'error'""",
    "referral": """
        SELECT concat('R', cast(event_id AS string)) AS referral_id,
               concat('P', cast(user_id AS string)) AS patient_id,
               concat('H', cast(event_id % 25 AS string)) AS from_hospital_id,
               concat('H', cast((event_id * 7 + 3) % 25 AS string)) AS to_hospital_id,
               CASE event_id % 3 WHEN 0 THEN 'Completed' WHEN 1 THEN ' Pending' ELSE 'Declined' END AS referral_status,
               CASE WHEN event_id % 18 = 6 THEN NULL
                    ELSE concat('reason ', cast(event_id % 9 AS string)) END AS referral_reason,
               DATE '1997-01-01' + cast(event_id % 1000 AS int) AS referral_date
        FROM {events}
        WHERE event_type = 'signup'""",
    "doctor_schedule": """
        SELECT concat('S', cast(event_id AS string)) AS schedule_id,
               concat('DR', cast(event_id % (SELECT count(*) FROM {supplier}) AS string)) AS doctor_id,
               CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN ' Night' ELSE 'Day' END AS shift_type,
               DATE '1997-01-01' + cast(event_id % 1200 AS int) AS shift_date
        FROM {events}
        WHERE event_type = 'purchase'""",
    "bed": """
        SELECT concat('B', cast(p_partkey AS string)) AS bed_id,
               CASE WHEN p_partkey % 97 = 13 THEN NULL
                    ELSE concat('H', cast(p_partkey % 25 AS string)) END AS hospital_id,
               concat('DP', cast((p_partkey % 25) * 6 + p_partkey % 6 AS string)) AS department_id,
               CASE WHEN p_size <= 10 THEN 'ICU' WHEN p_size <= 40 THEN 'Standard' ELSE NULL END AS bed_type,
               CASE WHEN p_type = 'PROMO' THEN ' Available ' WHEN p_type = 'SMALL' THEN 'Occupied'
                    WHEN p_type = 'LARGE' THEN 'Occupied' ELSE 'Available' END AS availability_status
        FROM {part}""",
    "medical_record": """
        SELECT concat('M', cast(o_orderkey AS string)) AS record_id,
               concat('P', cast(o_custkey AS string)) AS patient_id,
               CASE o_orderstatus WHEN 'F' THEN ' Lab' WHEN 'O' THEN 'Imaging' ELSE NULL END AS record_type,
               cast(o_orderdate AS date) AS record_date
        FROM {orders}""",
}

# Correction tables for hospital contacts, keyed by manager and by hospital.
DOMAIN_SQL["manager_fix"] = """
        SELECT concat('Manager ', cast(n_nationkey AS string)) AS manager_name,
               concat('+20-155-700-', cast(5000 + n_nationkey AS string)) AS manager_phone,
               concat('fixed', cast(n_nationkey AS string), '@example.net') AS manager_email
        FROM {nation} WHERE n_regionkey = 1"""
DOMAIN_SQL["hospital_fix"] = """
        SELECT concat('H', cast(n_nationkey AS string)) AS hospital_id,
               concat('+20-122-800-', cast(6000 + n_nationkey AS string)) AS hospital_phone
        FROM {nation} WHERE n_regionkey = 2"""


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_table(spark: SparkSession, driver: Callable[[str], DataFrame], name: str) -> DataFrame:
    """One raw domain table as a lazy DataFrame over the driver's tables."""
    text = DOMAIN_SQL[name]
    needed = [t for t in DRIVER_TABLES if "{" + t + "}" in text]
    return spark.sql(text, **{t: driver(t) for t in needed})


def domain_sql(name: str) -> str:
    """The same text with the plain driver table names, for any SQL engine."""
    return reduce(lambda s, t: s.replace("{" + t + "}", t), DRIVER_TABLES, DOMAIN_SQL[name])
