"""Dimensions, watermarks and facts."""

from __future__ import annotations

from oracles.base import AS_OF, TABLES, WATERMARK, r2

FIRST, SECOND, KNOWN = "DATE '1998-01-01'", "DATE '2000-01-01'", "DATE '1999-06-30'"


def age_group(day: str) -> str:
    age = f"CAST({day} - birth_date AS DOUBLE) / 365.25::DOUBLE"
    return f"CASE WHEN {age} < 18 THEN 'Child' WHEN {age} < 60 THEN 'Adult' ELSE 'Senior' END AS age_group"


BUSINESS = {
    "patient": "patient_id, national_id, patient_name, gender, birth_date, age_group, patient_phone, street, city, "
    "governorate, blood_type, emergency_contact",
    "hospital": "hospital_id, hospital_name, hospital_type, governorate, district, hospital_phone, total_beds, "
    "icu_capacity, latitude, longitude, manager_name, manager_email, manager_phone",
    "department": "department_id, department_name, floor_number, hospital_key",
    "doctor": "doctor_id, doctor_name, specialty, years_experience, doctor_phone, employment_status, hospital_key, "
    "department_key",
    "drug": "drug_id, drug_name, generic_name, manufacturer, drug_category, unit_price",
}
TRACKED = {
    "patient": ("patient_phone", "street", "city", "emergency_contact"),
    "hospital": ("total_beds", "icu_capacity", "hospital_type", "manager_name"),
    "department": ("department_name", "floor_number", "hospital_key"),
    "doctor": ("department_key", "hospital_key", "employment_status", "specialty"),
    "drug": ("unit_price", "drug_category", "manufacturer"),
}

PRICE = "CAST(unit_amount AS DECIMAL(8,2)) AS unit_price"

# Source rows of the second load (today) and of the first one (the earlier state).
TABLES |= {
    "now_patient": f"SELECT *, {age_group(SECOND)} FROM silver_patient",
    "past_patient": f"""
        SELECT * REPLACE (CASE WHEN blood_type = 'O+' THEN 'Old City' ELSE city END AS city,
                          CASE WHEN blood_type <> 'A-' THEN patient_phone END AS patient_phone,
                          CASE WHEN gender = 'other' THEN 'Old Governorate' ELSE governorate END AS governorate),
               {age_group(FIRST)}
        FROM silver_patient
        WHERE patient_id IN (SELECT patient_id FROM raw_visit WHERE visit_date < DATE '1995-07-01')""",
    "now_hospital": "SELECT * FROM silver_hospital",
    "past_hospital": """
        SELECT * REPLACE (total_beds + CASE WHEN hospital_type = 'Public' THEN 5 ELSE 0 END AS total_beds)
        FROM silver_hospital WHERE governorate <> 'ASIA'""",
    "now_department": """
        SELECT d.*, h.hospital_key FROM silver_department d
        JOIN hist_hospital h ON h.hospital_id = d.hospital_id AND h.scd_is_current = 1""",
    "past_department": """
        SELECT d.* REPLACE (CASE WHEN department_name <> 'Surgery' THEN floor_number END AS floor_number), h.hospital_key
        FROM silver_department d JOIN stage_hospital h ON h.hospital_id = d.hospital_id""",
    "now_doctor": """
        SELECT d.*, h.hospital_key, p.department_key FROM silver_doctor d
        JOIN hist_hospital h ON h.hospital_id = d.hospital_id AND h.scd_is_current = 1
        JOIN hist_department p ON p.department_id = d.department_id AND p.scd_is_current = 1""",
    "past_doctor": """
        SELECT d.* REPLACE (CASE WHEN employment_status = 'On Leave' THEN 'General' ELSE specialty END AS specialty),
               h.hospital_key, p.department_key
        FROM silver_doctor d JOIN stage_hospital h ON h.hospital_id = d.hospital_id
        JOIN stage_department p ON p.department_id = d.department_id""",
    "now_drug": f"SELECT *, {PRICE} FROM silver_drug",
    "past_drug": f"""
        SELECT *, {PRICE} FROM (
          SELECT * REPLACE (CASE WHEN drug_category = 'PROMO' THEN unit_amount / 2 ELSE unit_amount END AS unit_amount,
                            CASE WHEN drug_category = 'SMALL' THEN 'old name' ELSE generic_name END AS generic_name)
          FROM silver_drug WHERE drug_category <> 'LARGE')""",
}

HOUSEKEEPING = "scd_start_date, scd_end_date, scd_is_current, scd_version"

for name, business in BUSINESS.items():
    key = f"{name}_id"
    differs = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in TRACKED[name])
    # First load: dense keys by business id.
    TABLES[f"stage_{name}"] = f"""
        SELECT row_number() OVER (ORDER BY {key}) AS {name}_key, {business} FROM past_{name}"""
    inserted = f"""
        SELECT (SELECT max({name}_key) FROM stage_{name}) + row_number() OVER (ORDER BY n.{key}) AS {name}_key,
               {', '.join('n.' + c.strip() for c in business.split(','))},
               {SECOND} AS scd_start_date, CAST(NULL AS DATE) AS scd_end_date, 1 AS scd_is_current,
               CASE WHEN o.{key} IS NULL THEN 1 ELSE 2 END AS scd_version
        FROM now_{name} n LEFT JOIN stage_{name} o ON o.{key} = n.{key}
        WHERE o.{key} IS NULL OR {differs}"""
    closing = f"EXISTS (SELECT 1 FROM now_{name} n WHERE n.{key} = o.{key} AND ({differs}))"
    kept = f"""
        SELECT o.*, {FIRST} AS scd_start_date, CASE WHEN {closing} THEN DATE '1999-12-31' END AS scd_end_date,
               CASE WHEN {closing} THEN 0 ELSE 1 END AS scd_is_current, 1 AS scd_version
        FROM stage_{name} o"""
    TABLES[f"hist_{name}"] = f"{kept} UNION ALL {inserted}"
    TABLES[f"hist_{name}_kept"], TABLES[f"hist_{name}_new"] = kept, inserted

# Dimensions after one load of today's tables.
PARENTS = {
    "department": ", h.hospital_key FROM silver_department s JOIN dim_hospital h ON h.hospital_id = s.hospital_id",
    "doctor": ", h.hospital_key, p.department_key FROM silver_doctor s JOIN dim_hospital h ON "
    "h.hospital_id = s.hospital_id JOIN dim_department p ON p.department_id = s.department_id",
}
for name in BUSINESS:
    TABLES[f"dim_{name}"] = f"""
        SELECT row_number() OVER (ORDER BY s.{name}_id) AS {name}_key, s.* {PARENTS.get(name, f'FROM silver_{name} s')}"""

TABLES |= {
    "dim_diagnosis": """
        SELECT row_number() OVER (ORDER BY diagnosis_code) AS diagnosis_key, diagnosis_code, diagnosis_name,
               diagnosis_category, severity_level FROM silver_diagnosis""",
    "dim_procedure": """
        SELECT row_number() OVER (ORDER BY procedure_code) AS procedure_key, procedure_code, procedure_name,
               procedure_category, expected_amount, complexity_score FROM silver_medical_procedure""",
    "dim_claim_status": """
        SELECT row_number() OVER (ORDER BY approval_status, coalesce(rejection_reason, ''), reviewed_by) AS claim_status_key,
               approval_status AS claim_status, rejection_reason, reviewed_by
        FROM (SELECT DISTINCT approval_status, rejection_reason, reviewed_by FROM silver_claim_approval)""",
    "stage_claims": f"""
        SELECT c.claim_id, c.visit_id, CAST(strftime(c.claim_date, '%Y%m%d') AS INTEGER) AS date_key,
               coalesce(p.patient_key, -1) AS patient_key, coalesce(h.hospital_key, -1) AS hospital_key,
               i.procedure_code, i.drug_key, coalesce(s.claim_status_key, -1) AS claim_status_key, c.claim_amount, c.approved_amount,
               {r2('c.claim_amount - coalesce(c.approved_amount, 0)')} AS approval_gap,
               CAST(a.approval_date - c.claim_date AS INTEGER) AS days_to_decision,
               coalesce(i.item_count, 0) AS item_count, a.reviewed_by, c.claim_date,
               c.claim_status AS status, a.approval_date AS decided_on
        FROM silver_claim c
        LEFT JOIN dim_patient p ON p.patient_id = c.patient_id
        LEFT JOIN dim_hospital h ON h.hospital_id = c.hospital_id
        LEFT JOIN silver_claim_approval a ON a.claim_id = c.claim_id
        LEFT JOIN dim_claim_status s ON s.claim_status = c.claim_status
             AND s.rejection_reason IS NOT DISTINCT FROM a.rejection_reason
             AND s.reviewed_by IS NOT DISTINCT FROM a.reviewed_by
        LEFT JOIN (
          SELECT ci.claim_id, count(*) AS item_count,
                 arg_max(m.procedure_code, (item_amount, claim_item_id)) FILTER (m.procedure_code IS NOT NULL) AS procedure_code,
                 arg_max(d.drug_key, (item_amount, claim_item_id)) FILTER (d.drug_key IS NOT NULL) AS drug_key
          FROM silver_claim_items ci
          LEFT JOIN silver_medical_procedure m ON m.procedure_code = ci.procedure_code
          LEFT JOIN dim_drug d ON d.drug_id = ci.drug_id
          GROUP BY ci.claim_id) i ON i.claim_id = c.claim_id""",
}

WAREHOUSE_SQL: dict[str, str] = {
    "dim_date": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date, CAST(year(d) AS INTEGER) AS year,
               CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
               CAST(weekofyear(d) AS INTEGER) AS week, CAST(day(d) AS INTEGER) AS day_of_month,
               CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name,
               CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_weekend,
               CASE WHEN month(d) IN (12, 1, 2) THEN 'Winter' WHEN month(d) <= 5 THEN 'Spring'
                    WHEN month(d) <= 8 THEN 'Summer' ELSE 'Autumn' END AS season
        FROM (SELECT CAST(unnest(generate_series(min(visit_date), max(visit_date), INTERVAL 1 DAY)) AS DATE) AS d
              FROM raw_visit)""",
    "dim_diagnosis": "SELECT * FROM dim_diagnosis",
    "dim_procedure": "SELECT * FROM dim_procedure",
    "dim_claim_status": "SELECT * FROM dim_claim_status",
    **{f"scd2_{n}": f"SELECT {n}_key, {b}, {HOUSEKEEPING} FROM hist_{n}" for n, b in BUSINESS.items()},
    "scd2_published": f"SELECT patient_key, {BUSINESS['patient']}, {HOUSEKEEPING} FROM hist_patient",
    "scd2_expire": f"SELECT patient_key, {BUSINESS['patient']}, {HOUSEKEEPING} FROM hist_patient_kept",
    "scd2_insert": f"SELECT patient_key, {BUSINESS['patient']}, {HOUSEKEEPING} FROM hist_patient_new",
    "join_current_dim": """
        SELECT v.visit_id, v.hospital_id, h.hospital_key, h.scd_version
        FROM raw_visit v JOIN hist_hospital h ON h.hospital_id = v.hospital_id AND h.scd_is_current = 1""",
    "join_asof_scd2": """
        SELECT v.visit_id, v.patient_id, v.visit_date, h.patient_key, h.scd_version
        FROM raw_visit v JOIN hist_patient h ON h.patient_id = v.patient_id
        WHERE v.visit_date >= h.scd_start_date AND v.visit_date <= coalesce(h.scd_end_date, DATE '9999-12-31')
        UNION ALL
        SELECT v.visit_id, v.patient_id, v.visit_date, NULL, NULL FROM raw_visit v
        WHERE v.visit_id NOT IN (
          SELECT w.visit_id FROM raw_visit w JOIN hist_patient h ON h.patient_id = w.patient_id
          WHERE w.visit_date >= h.scd_start_date AND w.visit_date <= coalesce(h.scd_end_date, DATE '9999-12-31'))""",
    "watermark_init": """
        SELECT 'fact_visits' AS table_name, max(visit_date) AS last_loaded_date FROM raw_visit
        UNION ALL VALUES ('fact_claims', DATE '2024-05-08'), ('fact_pharmacy', DATE '2024-05-08')""",
    "watermark_advance": f"""
        SELECT 'fact_visits' AS table_name, greatest({WATERMARK}, max(visit_date)) AS last_loaded_date FROM raw_visit
        UNION ALL SELECT 'fact_claims', {WATERMARK}
        UNION ALL SELECT 'fact_pharmacy', greatest({WATERMARK}, max(transaction_date)) FROM raw_drug_transaction""",
    "fact_visits": f"""
        SELECT v.visit_id, CAST(strftime(v.visit_date, '%Y%m%d') AS INTEGER) AS date_key, coalesce(p.patient_key, -1) AS patient_key,
               coalesce(h.hospital_key, -1) AS hospital_key, coalesce(d.doctor_key, -1) AS doctor_key,
               coalesce(e.department_key, -1) AS department_key, coalesce(g.diagnosis_key, -1) AS diagnosis_key, v.visit_type, v.total_amount AS total_cost,
               v.waiting_time, (SELECT count(*) FROM silver_visit_procedure x WHERE x.visit_id = v.visit_id) AS procedure_count,
               CASE WHEN v.visit_id IN (SELECT visit_id FROM silver_prescription) THEN 1 ELSE 0 END AS prescription_flag,
               {r2('f.rating')} AS feedback_rating, v.visit_status, r.referral_reason, v.visit_date
        FROM silver_visit v
        LEFT JOIN dim_patient p ON p.patient_id = v.patient_id
        LEFT JOIN dim_hospital h ON h.hospital_id = v.hospital_id
        LEFT JOIN dim_doctor d ON d.doctor_id = v.doctor_id
        LEFT JOIN dim_department e ON e.department_id = v.department_id
        LEFT JOIN dim_diagnosis g ON g.diagnosis_code = v.diagnosis_code
        LEFT JOIN (SELECT patient_id, hospital_id, doctor_id, avg(rating) AS rating FROM silver_patient_feedback
                   GROUP BY ALL) f
          ON f.patient_id = v.patient_id AND f.hospital_id = v.hospital_id AND f.doctor_id = v.doctor_id
        LEFT JOIN (SELECT patient_id, from_hospital_id, arg_min(referral_reason, (referral_date, referral_id)) AS referral_reason
                   FROM silver_referral GROUP BY ALL) r
          ON r.patient_id = v.patient_id AND r.from_hospital_id = v.hospital_id
        WHERE v.visit_date > {WATERMARK}""",
    "fact_claims": f"""
        SELECT * EXCLUDE (status, decided_on) FROM stage_claims
        WHERE claim_date > {WATERMARK} OR status = 'Pending Review'""",
    "merge_upsert": f"""
        SELECT * EXCLUDE (status, decided_on),
               CASE WHEN claim_date <= {KNOWN} THEN {KNOWN} ELSE {AS_OF} END AS loaded_on,
               CASE WHEN claim_date > {KNOWN} OR decided_on > {KNOWN} THEN {AS_OF} ELSE {KNOWN} END AS updated_on
        FROM stage_claims""",
    "fact_pharmacy": f"""
        SELECT t.transaction_id, t.transaction_date, CAST(strftime(t.transaction_date, '%Y%m%d') AS INTEGER) AS date_key,
               coalesce(d.drug_key, -1) AS drug_key, coalesce(h.hospital_key, -1) AS hospital_key, t.transaction_type, t.quantity, u.unit_amount,
               {r2('t.quantity * u.unit_amount')} AS total_value,
               CASE WHEN t.transaction_type IN ('Dispensing', 'Wastage', 'Return') AND s.stock - t.quantity <= 0
                    THEN 1 ELSE 0 END AS stockout_flag,
               CASE WHEN s.expiry - t.transaction_date <= 60 THEN 1 ELSE 0 END AS near_expiry_flag,
               CASE WHEN t.transaction_type = 'Dispensing' AND NOT EXISTS (
                      SELECT 1 FROM silver_prescription_items i
                      JOIN silver_prescription x ON x.prescription_id = i.prescription_id
                      JOIN silver_visit v ON v.visit_id = x.visit_id
                      WHERE i.drug_id = t.drug_id AND v.hospital_id = t.hospital_id AND v.visit_date = t.transaction_date)
                    THEN 1 ELSE 0 END AS no_prescription_flag,
               t.performed_by
        FROM silver_drug_transaction t
        LEFT JOIN dim_drug d ON d.drug_id = t.drug_id
        LEFT JOIN dim_hospital h ON h.hospital_id = t.hospital_id
        LEFT JOIN silver_drug u ON u.drug_id = t.drug_id
        LEFT JOIN (SELECT hospital_id, drug_id, sum(quantity_available) AS stock, min(expiration_date) AS expiry
                   FROM silver_drug_inventory GROUP BY ALL) s
          ON s.hospital_id = t.hospital_id AND s.drug_id = t.drug_id
        WHERE t.transaction_date > {WATERMARK}""",
}
# The second load leaves what one load of complete dimensions gives.
WAREHOUSE_SQL |= {f"{name}_two_loads": WAREHOUSE_SQL[name] for name in ("fact_visits", "fact_claims", "fact_pharmacy")}
# Summaries that are kept up equal one pass over the whole fact.
WAREHOUSE_SQL["rollup_hospital_activity"] = f"""
    SELECT hospital_key, count(*) AS visits, {r2('sum(CAST(total_cost AS DECIMAL(38,8)))')} AS total_cost,
           CAST(sum(waiting_time) AS DOUBLE) AS waiting_time, CAST(sum(procedure_count) AS DOUBLE) AS procedures,
           count(DISTINCT patient_key) AS patients, count(DISTINCT doctor_key) AS doctors
    FROM ({WAREHOUSE_SQL['fact_visits']}) GROUP BY hospital_key"""
WAREHOUSE_SQL["rollup_drug_movements"] = f"""
    SELECT drug_key, transaction_type, count(*) AS movements, CAST(sum(quantity) AS DOUBLE) AS quantity,
           {r2('sum(CAST(total_value AS DECIMAL(38,8)))')} AS total_value, count(DISTINCT hospital_key) AS hospitals
    FROM ({WAREHOUSE_SQL['fact_pharmacy']}) GROUP BY ALL"""
