"""Raw and cleaned tables as common table expressions, and small SQL snippets."""

from __future__ import annotations

import re

from wardflow.sources.domain import SCHEMAS, DOMAIN_SQL, domain_sql

AS_OF = "DATE '2001-12-31'"
WATERMARK = "DATE '1999-01-01'"


def columns(table: str) -> list[tuple[str, str]]:
    """Name and type of each raw column."""
    parts = re.split(r", (?=[a-z_]+ [a-z])", SCHEMAS[table])
    return [tuple(p.split(" ", 1)) for p in parts]


def r2(value: str) -> str:
    """Half-up rounding to two places on an eight-digit decimal."""
    return f"CAST(round(CAST({value} AS DECIMAL(30,8)), 2) AS DOUBLE)"


def r2z(value: str) -> str:
    return r2(f"coalesce(CAST({value} AS DOUBLE), 0)")


def ratio(n: str, d: str, scale: str = "1") -> str:
    return f"CASE WHEN {d} > 0 THEN {r2(f'CAST({n} AS DOUBLE) * {scale} / {d}')} ELSE 0.0::DOUBLE END"


def pct(n: str, d: str) -> str:
    return ratio(n, d, "100.0::DOUBLE")


def egypt(value: str) -> str:
    local = f"regexp_replace(regexp_replace({value}, '[^0-9]', '', 'g'), '^0?(20)?', '')"
    return f"'+20-' || substr({local}, 1, 3) || '-' || substr({local}, 4, 3) || '-' || substr({local}, 7, 4)"


def first_per_key(table: str, key: str, names: list[str]) -> str:
    order = ", ".join(f"{n} NULLS FIRST" for n in names if n != key)
    return f"SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM raw_{table}"


# Cleaned tables: raw table, key, trimmed?, strings filled?, numbers filled?, columns kept as they are.
CLEANED = {
    "bed": ("bed", "bed_id", True, True, False, "hospital_id department_id"),
    "claim": ("claim", "claim_id", True, True, True, "patient_id visit_id hospital_id approved_amount"),
    "claim_approval": ("claim_approval", "approval_id", False, True, True, "claim_id"),
    "claim_items": ("claim_item", "claim_item_id", False, True, True, "claim_id procedure_code drug_id"),
    "diagnosis": ("diagnosis", "diagnosis_code", True, True, False, ""),
    "doctor_schedule": ("doctor_schedule", "schedule_id", False, True, False, "doctor_id"),
    "drug": ("drug", "drug_id", True, True, True, ""),
    "drug_inventory": ("drug_inventory", "inventory_id", True, True, True, "hospital_id drug_id"),
    "drug_transaction": ("drug_transaction", "transaction_id", True, True, True, "hospital_id drug_id"),
    "icu_status": ("icu_status", "icu_status_id", True, True, True, "hospital_id"),
    "medical_procedure": ("medical_procedure", "procedure_code", True, True, True, ""),
    "medical_record": ("medical_record", "record_id", True, True, False, "patient_id"),
    "patient_feedback": ("patient_feedback", "feedback_id", True, True, False, "patient_id hospital_id doctor_id"),
    "prescription": ("prescription", "prescription_id", True, True, False, "visit_id"),
    "prescription_items": ("prescription_item", "prescription_item_id", True, True, False, "prescription_id drug_id"),
    "referral": ("referral", "referral_id", True, True, False, "patient_id from_hospital_id to_hospital_id"),
    "visit": ("visit", "visit_id", True, True, True, "patient_id doctor_id hospital_id department_id diagnosis_code"),
    "visit_procedure": ("visit_procedure", "visit_procedure_id", True, True, True, "visit_id procedure_code"),
}


def cleaned_sql(name: str) -> str:
    table, key, trimmed, strings, numbers, kept = CLEANED[name]
    shown = []
    for col, kind in columns(table):
        value = f"trim({col})" if trimmed and kind == "string" else col
        if col not in kept.split():
            if strings and kind == "string":
                value = f"coalesce({value}, 'Unknown')"
            if numbers and kind in ("int", "bigint", "double"):
                value = f"coalesce({value}, 0)"
        target = "item_quantity" if (name, col) == ("claim_items", "quantity") else col
        shown.append(f"{value} AS {target}")
    source = first_per_key(table, key, [c for c, _ in columns(table)])
    return f"SELECT {', '.join(shown)} FROM ({source}) AS s WHERE rn = 1"


def text(col: str) -> str:
    return f"coalesce(trim({col}), 'Unknown')"


SPECIAL = {
    "department": f"""
        SELECT department_id, trim(hospital_id) AS hospital_id, {text('department_name')} AS department_name,
               CAST(coalesce(floor_number, 0) AS INTEGER) AS floor_number,
               {egypt("('0' || CAST(coalesce(manager_phone, 0) AS VARCHAR))")} AS manager_phone
        FROM raw_department""",
    "doctor": f"""
        SELECT doctor_id, {text('phone')} AS doctor_phone, {text('specialty')} AS specialty,
               {text('employment_status')} AS employment_status, hospital_id, department_id, years_experience,
               trim(concat_ws('-', first_name, last_name)) AS doctor_name
        FROM raw_doctor""",
    "patient": f"""
        SELECT patient_id, {text('national_id')} AS national_id, {text('gender')} AS gender, birth_date,
               {egypt("('0' || CAST(phone AS VARCHAR))")} AS patient_phone,
               {egypt("('0' || CAST(emergency_contact AS VARCHAR))")} AS emergency_contact,
               {text('street')} AS street, {text('city')} AS city, {text('governorate')} AS governorate,
               {text('blood_type')} AS blood_type,
               trim(concat_ws(' ', first_name, last_name)) AS patient_name,
               CAST(2001 - year(birth_date) AS INTEGER) AS patient_age
        FROM raw_patient""",
    "hospital": f"""
        SELECT h.hospital_id, {text('h.hospital_name')} AS hospital_name, {text('h.hospital_type')} AS hospital_type,
               {text('h.governorate')} AS governorate, {text('h.district')} AS district,
               coalesce(f.hospital_phone, {egypt(text('h.phone'))}) AS hospital_phone,
               h.total_beds, h.icu_capacity, h.latitude, h.longitude,
               {text('h.manager_name')} AS manager_name,
               coalesce(m.manager_email, {text('h.manager_email')}) AS manager_email,
               coalesce(m.manager_phone, {egypt(text('h.manager_phone'))}) AS manager_phone
        FROM raw_hospital h
        LEFT JOIN raw_manager_fix m ON m.manager_name = trim(h.manager_name)
        LEFT JOIN raw_hospital_fix f ON f.hospital_id = h.hospital_id""",
}

TABLES: dict[str, str] = {f"raw_{name}": domain_sql(name) for name in DOMAIN_SQL}
TABLES |= {f"silver_{name}": cleaned_sql(name) for name in CLEANED}
TABLES |= {f"silver_{name}": sql for name, sql in SPECIAL.items()}


def with_tables(sql: str) -> str:
    """Put the definitions of all tables a text uses in front of it."""
    needed: list[str] = []

    def visit(body: str) -> None:
        for name in dict.fromkeys(re.findall(r"\b(?:raw|silver|dim|hist|now|past|mart|stage)_[a-z0-9_]+\b", body)):
            if name in TABLES and name not in needed:
                visit(TABLES[name])
                needed.append(name)

    visit(sql)
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({TABLES[n]})" for n in needed)
    return f"WITH {ctes}\n{sql}" if needed else sql
