"""Sources, sinks, cleaning, filters, joins, aggregates, functions, quality."""

from __future__ import annotations

from oracles.base import AS_OF, TABLES, WATERMARK, columns, egypt, pct, r2


def strings(table: str, change: str, skip: str = "") -> str:
    """All columns of a raw table with one expression on the string ones."""
    shown = [
        f"{change.format(c)} AS {c}" if kind == "string" and c not in skip.split() else c for c, kind in columns(table)
    ]
    return f"SELECT {', '.join(shown)} FROM raw_{table}"


def initcap(col: str) -> str:
    word = "upper(substr(w, 1, 1)) || lower(substr(w, 2))"
    return f"array_to_string(list_transform(string_split({col}, ' '), lambda w: {word}), ' ')"


def untrimmed(table: str, key: str, *cols: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT 'untrimmed' AS "check", '{table}' AS table_name, '{c}' AS column_name,
            count(*) FILTER ({c} <> trim({c})) AS failed_rows,
            min({key}) FILTER ({c} <> trim({c})) AS sample_key FROM raw_{table}"""
        for c in cols
    )


def listing(table: str, *cols: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS row_count, '{table}' AS table_name "
        f"FROM raw_{table} GROUP BY {c}"
        for c in cols
    )


def references(table: str, col: str, parent: str, parent_key: str) -> str:
    missing = f"(SELECT count(*) FROM raw_{table} WHERE {col} IS NULL)"
    dangling = (
        f"(SELECT count(*) FROM raw_{table} t WHERE t.{col} IS NOT NULL "
        f"AND NOT EXISTS (SELECT 1 FROM raw_{parent} p WHERE p.{parent_key} = t.{col}))"
    )
    return (
        f"SELECT '{table}' AS table_name, '{col}' AS column_name, 'null' AS finding, {missing} AS row_count "
        f"UNION ALL SELECT '{table}', '{col}', 'orphan', {dangling}"
    )


def outliers(table: str, key: str, col: str) -> str:
    return f"""
        SELECT '{table}' AS table_name, '{col}' AS column_name, {key} AS row_id, CAST({col} AS DOUBLE) AS value,
               {r2('q1')} AS q1, {r2('q3')} AS q3
        FROM silver_{table},
             (SELECT quantile_cont(CAST({col} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({col} AS DOUBLE), 0.75) AS q3
              FROM silver_{table}) AS q
        WHERE {col} < q1 - 1.5 * (q3 - q1) OR {col} > q3 + 1.5 * (q3 - q1)"""


def load_row(table: str, source: str = "", more: tuple[str, ...] = (), rejected: str = "0") -> str:
    cols = [c for c, _ in columns(table)] + list(more)
    nulls = " + ".join(f"(count(*) - count({c}))" for c in cols)
    return (
        f"SELECT '{table}' AS table_name, count(*) AS row_count, {len(cols)} AS column_count, "
        f"CAST({nulls} AS BIGINT) AS total_null_values, "
        f"round(CAST({nulls} AS DOUBLE) / (count(*) * {len(cols)}) * 100, 2) AS null_percentage, "
        f"'SUCCESS' AS status, CAST({rejected} AS BIGINT) AS rejected_rows FROM {source or f'raw_{table}'}"
    )


PENDING_CLAIM = "trim(claim_status) = 'Pending Review'"
MIXED_CLAIMS = f"""(
    SELECT * REPLACE (CASE WHEN {PENDING_CLAIM} THEN NULL ELSE approved_amount END AS approved_amount),
           CASE WHEN {PENDING_CLAIM} THEN visit_id END AS note FROM raw_claim)"""


def seeds(*names: str) -> str:
    return ", ".join(f"('{n}', {WATERMARK})" for n in names)


PATIENT_PROFILE = [c for c, _ in columns("patient")]


def profile_row(col: str) -> str:
    value = f"CAST({col} AS VARCHAR)"
    ranked = (
        f"(SELECT {value} AS v, count(*) AS n FROM raw_patient GROUP BY {col} ORDER BY n DESC, v NULLS FIRST LIMIT 1)"
    )
    return f"""
        SELECT '{col}' AS column_name,
               (SELECT count(*) FROM (SELECT DISTINCT {col} FROM raw_patient)) AS unique_values,
               (SELECT v FROM {ranked}) AS most_frequent_value,
               (SELECT n FROM {ranked}) AS appearance_count,
               (SELECT CAST(min({col}) AS VARCHAR) FROM raw_patient) AS min_value,
               (SELECT CAST(max({col}) AS VARCHAR) FROM raw_patient) AS max_value"""


PRESCRIBED = """EXISTS (SELECT 1 FROM {p}_prescription_{item} i
                 JOIN {p}_prescription x ON x.prescription_id = i.prescription_id
                 JOIN {p}_visit v ON v.visit_id = x.visit_id
                 WHERE i.drug_id = t.drug_id AND v.hospital_id = t.hospital_id
                   AND v.visit_date = t.transaction_date)"""

AGE = f"year({AS_OF}) - year(birth_date)"

OPERATOR_SQL: dict[str, str] = {
    # sources
    "scan_csv": "SELECT * FROM raw_claim",
    "scan_table": "SELECT * FROM raw_visit",
    "scan_file_metadata": "SELECT 'lineitem.parquet' AS source_file, count(*) AS row_count FROM lineitem",
    "values_seed": f"""
        SELECT table_name, last_loaded_date, CAST(count(*) AS BIGINT) AS newer_rows
        FROM (VALUES {seeds('fact_visits', 'fact_claims', 'fact_pharmacy')}) AS w(table_name, last_loaded_date)
        JOIN (SELECT 'fact_visits' AS source, visit_date AS day FROM raw_visit
              UNION ALL SELECT 'fact_claims', claim_date FROM raw_claim
              UNION ALL SELECT 'fact_pharmacy', transaction_date FROM raw_drug_transaction) AS s
          ON source = table_name AND day > last_loaded_date
        GROUP BY ALL""",
    "date_spine": """
        SELECT CAST(day AS DATE) AS full_date, count(visit_id) AS visit_count
        FROM (SELECT unnest(generate_series(min(visit_date), max(visit_date), INTERVAL 1 DAY)) AS day FROM raw_visit)
        LEFT JOIN raw_visit ON visit_date = CAST(day AS DATE)
        GROUP BY day""",
    # sinks
    "sink_overwrite": "SELECT * EXCLUDE (hospital_id), CAST(year(claim_date) AS INTEGER) AS claim_year FROM raw_claim",
    "sink_partitioned": """
        SELECT claim_id, claim_amount * CASE WHEN year(claim_date) >= 2000 THEN 2 ELSE 1 END AS claim_amount,
               CAST(year(claim_date) AS INTEGER) AS claim_year
        FROM raw_claim""",
    "sink_append": "SELECT * FROM raw_claim",
    "sink_append_evolve": """
        SELECT visit_id, visit_date, visit_type,
               CAST(CASE WHEN visit_type <> 'Inpatient' THEN year(visit_date) END AS INTEGER) AS visit_year
        FROM raw_visit""",
    "upsert_evolve": """
        SELECT visit_id, visit_date, visit_type, CAST(year(visit_date) AS INTEGER) AS visit_year,
               CASE WHEN visit_type <> 'Outpatient' THEN 'yes' END AS marked
        FROM raw_visit""",
    "scan_discover": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST(1 AS BIGINT) AS sources, true AS all_have_bytes" for t in ("claim", "visit", "hospital")
    ),
    "schema_conform": """
        SELECT claim_id, claim_date, CAST(CAST(approved_amount AS DECIMAL(30,8)) AS DECIMAL(12,2)) AS approved_amount,
               CAST(year(claim_date) AS INTEGER) AS claim_year, CAST(NULL AS VARCHAR) AS reviewed_by
        FROM raw_claim""",
    "load_validate": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS written, count(*) AS read_back, 'SUCCESS' AS status FROM raw_{t}"
        for t in ("claim", "visit", "patient")
    ),
    "snapshot_diff": """
        SELECT c.*, CASE WHEN claim_date > DATE '1999-06-30' THEN 'insert' ELSE 'update' END AS change_type
        FROM silver_claim c LEFT JOIN silver_claim_approval a USING (claim_id)
        WHERE claim_date > DATE '1999-06-30' OR approval_date > DATE '1999-06-30'""".replace(
        "SELECT c.*", "SELECT c.claim_id, c.patient_id, c.visit_id, c.hospital_id, c.claim_status, "
        "c.claim_date, c.claim_amount, c.approved_amount"
    ),
    # cleaning
    "clean_dedup": """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY claim_item_id ORDER BY claim_id NULLS FIRST,
                 procedure_code NULLS FIRST, drug_id NULLS FIRST, quantity NULLS FIRST, item_amount NULLS FIRST) AS rn
          FROM raw_claim_item) WHERE rn = 1""",
    "clean_trim": strings("doctor", "trim({})"),
    "clean_initcap": strings("hospital", initcap("{}")).replace("latitude, longitude, ", ""),
    "clean_lower": strings("visit", "lower({})"),
    "clean_fill_str": strings("patient", "coalesce({}, 'Unknown')", skip="national_id"),
    "clean_fill_num": """
        SELECT * REPLACE (coalesce(waiting_time, 0) AS waiting_time, coalesce(total_amount, 0) AS total_amount)
        FROM raw_visit""",
    "clean_to_date": """
        SELECT visit_id, CASE WHEN visit_type <> 'Follow-up' THEN visit_date END AS visit_date FROM raw_visit""",
    "clean_fill_everything": """
        SELECT trim(claim_id) AS claim_id, coalesce(trim(patient_id), 'Unknown') AS patient_id,
               coalesce(trim(visit_id), 'Unknown') AS visit_id, coalesce(trim(hospital_id), 'Unknown') AS hospital_id,
               coalesce(trim(claim_status), 'Unknown') AS claim_status,
               CASE WHEN coalesce(claim_status, '') <> 'Rejected' THEN claim_date END AS claim_date,
               coalesce(claim_amount, 0) AS claim_amount, coalesce(approved_amount, 0) AS approved_amount
        FROM raw_claim""",
    "clean_blank_date": """
        SELECT visit_id, CASE WHEN visit_type = 'Outpatient' THEN visit_date END AS visit_date FROM raw_visit""",
    "clean_audit": "SELECT *, TIMESTAMP '2001-12-31 00:00:00' AS _created_at FROM raw_bed",
    "clean_rename": "SELECT * RENAME (quantity AS item_quantity) FROM raw_claim_item",
    "clean_cast": """
        SELECT patient_id, TRY_CAST(national_id AS BIGINT) AS national_id, CAST(phone AS VARCHAR) AS phone
        FROM raw_patient""",
    "clean_phone": f"""
        SELECT id, {egypt('phone')} AS phone,
               CASE WHEN length(regexp_replace(regexp_replace(phone, '[^0-9]', '', 'g'), '^0?(20)?', '')) = 10
                    THEN {egypt('phone')} END AS strict_phone
        FROM (SELECT doctor_id AS id, phone FROM raw_doctor
              UNION ALL SELECT hospital_id, phone FROM raw_hospital
              UNION ALL SELECT patient_id, '0' || CAST(phone AS VARCHAR) FROM raw_patient) AS s""",
    "clean_override": """
        SELECT hospital_id, h.manager_name, coalesce(m.manager_phone, h.manager_phone) AS manager_phone,
               coalesce(m.manager_email, h.manager_email) AS manager_email
        FROM raw_hospital h LEFT JOIN raw_manager_fix m ON m.manager_name = h.manager_name""",
    "clean_concat": "SELECT *, concat_ws('-', first_name, last_name) AS doctor_name FROM raw_doctor",
    "clean_fullname": """
        SELECT * EXCLUDE (first_name, last_name), concat_ws(' ', first_name, last_name) AS patient_name
        FROM raw_patient""",
    "clean_age": f"SELECT patient_id, birth_date, CAST({AGE} AS INTEGER) AS patient_age FROM raw_patient",
    "bronze_audit": f"""
        SELECT claim_id, TIMESTAMP '2001-12-31 00:00:00' AS ingestion_timestamp, {AS_OF} AS ingestion_date,
               'run-1' AS pipeline_run_id, true AS from_csv, true AS from_claim, true AS has_time
        FROM raw_claim""",
    # filters
    "filter_in": """
        SELECT * FROM silver_drug_transaction
        WHERE transaction_type IN ('Dispensing', 'Wastage') AND substr(performed_by, 1, 7) NOT IN ('Staff 1', 'Staff 2')""",
    "filter_between": "SELECT * FROM raw_claim WHERE claim_amount BETWEEN 5000 AND 100000",
    "filter_like": "SELECT * FROM raw_doctor WHERE phone LIKE '+__-___-___-____'",
    "filter_null": "SELECT * FROM raw_bed WHERE hospital_id IS NULL OR bed_type IS NULL",
    "filter_colcol": "SELECT * FROM raw_drug_inventory WHERE quantity_available < reorder_level",
    "filter_length": """
        SELECT patient_id, phone, CAST(length(CAST(phone AS VARCHAR)) AS INTEGER) AS phone_length FROM raw_patient
        WHERE length(CAST(phone AS VARCHAR)) <> 10
           OR substr(CAST(phone AS VARCHAR), 1, 2) NOT IN ('10', '11', '12', '15')""",
    "filter_watermark": f"""
        SELECT * FROM silver_claim WHERE claim_date > {WATERMARK} OR claim_status = 'Pending Review'""",
    "exists_flag": f"""
        SELECT t.*, CASE WHEN {PRESCRIBED.format(p='raw', item='item')} THEN 1 ELSE 0 END AS prescribed
        FROM raw_drug_transaction t""",
    "case_bucket": f"""
        SELECT patient_id, CAST({AGE} AS INTEGER) AS patient_age,
               CASE WHEN {AGE} < 18 THEN 'Child (0-17)' WHEN {AGE} BETWEEN 18 AND 35 THEN 'Young Adult (18-35)'
                    WHEN {AGE} BETWEEN 36 AND 55 THEN 'Middle Age (36-55)'
                    WHEN {AGE} BETWEEN 56 AND 70 THEN 'Senior (56-70)' ELSE 'Elderly (70+)' END AS age_group
        FROM raw_patient""",
    "safe_divide": f"""
        SELECT claim_id, {r2('approved_amount * 100 / nullif(claim_amount, 0)')} AS approval_pct FROM raw_claim""",
    # joins
    "join_inner": """
        SELECT visit_procedure_id, p.visit_id, v.hospital_id, procedure_amount
        FROM raw_visit_procedure p JOIN raw_visit v ON v.visit_id = p.visit_id""",
    "join_left": """
        SELECT p.patient_id, (SELECT count(*) FROM raw_visit v WHERE v.patient_id = p.patient_id) AS visits,
               (SELECT count(*) FROM raw_patient_feedback f WHERE f.patient_id = p.patient_id) AS feedbacks
        FROM raw_patient p""",
    "join_left_multi": """
        SELECT v.visit_id, v.patient_id, v.hospital_id, v.doctor_id, f.best_rating
        FROM raw_visit v
        LEFT JOIN (SELECT patient_id, hospital_id, doctor_id, max(rating) AS best_rating
                   FROM raw_patient_feedback GROUP BY ALL) f
          ON f.patient_id = v.patient_id AND f.hospital_id = v.hospital_id AND f.doctor_id = v.doctor_id""",
    "join_top1": """
        SELECT c.claim_id, i.claim_item_id, i.item_amount
        FROM silver_claim c
        LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY item_amount DESC, claim_item_id DESC) AS rn
                   FROM silver_claim_items) i ON i.claim_id = c.claim_id AND i.rn = 1""",
    "join_anti": """
        SELECT c.* FROM raw_claim c LEFT JOIN (SELECT DISTINCT claim_id AS known FROM raw_claim_item) i
          ON i.known = c.claim_id WHERE i.known IS NULL""",
    "join_flag": """
        SELECT visit_id, visit_type,
               CASE WHEN visit_id IN (SELECT visit_id FROM raw_prescription) THEN 1 ELSE 0 END AS prescription_flag
        FROM raw_visit""",
    "join_dup_keys": """
        SELECT patient_id, phone, shared_by
        FROM (SELECT patient_id, phone, count(*) OVER (PARTITION BY phone) AS shared_by FROM raw_patient)
        WHERE shared_by > 1 AND phone IS NOT NULL""",
    # aggregates
    "agg_count": "SELECT hospital_id, count(*) AS visits FROM raw_visit GROUP BY hospital_id",
    "agg_count_distinct": """
        SELECT doctor_id, count(DISTINCT patient_id) AS patients, count(DISTINCT diagnosis_code) AS diagnoses
        FROM raw_visit GROUP BY doctor_id""",
    "agg_cond_distinct": """
        SELECT hospital_id, count(DISTINCT patient_id) FILTER (visit_type = 'Inpatient') AS inpatients,
               count(DISTINCT patient_id) FILTER (visit_type = 'Outpatient') AS outpatients
        FROM raw_visit GROUP BY hospital_id""",
    "agg_basic": f"""
        SELECT doctor_id, {r2('sum(total_amount)')} AS amount, {r2('avg(waiting_time)')} AS avg_wait,
               min(visit_date) AS first_visit, max(visit_date) AS last_visit
        FROM raw_visit GROUP BY doctor_id""",
    "agg_cond_sum": """
        SELECT drug_id, count(*) AS moves, count(*) FILTER (transaction_type = 'Purchase') AS purchases,
               count(*) FILTER (transaction_type = 'Dispensing') AS dispensings,
               CAST(sum(CASE transaction_type WHEN 'Purchase' THEN quantity ELSE 0 END) AS BIGINT) AS purchased,
               CAST(sum(CASE transaction_type WHEN 'Dispensing' THEN quantity ELSE 0 END) AS BIGINT) AS dispensed,
               min(transaction_date) AS first_transaction_date, max(transaction_date) AS last_transaction_date
        FROM silver_drug_transaction GROUP BY drug_id""",
    "agg_avg_ratio": f"""
        SELECT patient_id, {r2('avg(approved_amount / nullif(claim_amount, 0)) * 100')} AS approval_pct
        FROM raw_claim GROUP BY patient_id""",
    "agg_sum_diff": f"""
        SELECT hospital_id, {r2('sum(claim_amount - approved_amount)')} AS denied FROM raw_claim GROUP BY hospital_id""",
    "agg_avg_decimal": f"""
        SELECT doctor_id, {r2('avg(CAST(rating AS DECIMAL(3,1)))')} AS avg_rating
        FROM raw_patient_feedback GROUP BY doctor_id""",
    "agg_first": """
        SELECT patient_id, from_hospital_id, referral_reason
        FROM (SELECT *, row_number() OVER (PARTITION BY patient_id, from_hospital_id
                                           ORDER BY referral_date, referral_id) AS rn FROM raw_referral)
        WHERE rn = 1""",
    "agg_max": """
        SELECT hospital_id, max(claim_date) AS newest_claim, max(claim_amount) AS largest_claim
        FROM raw_claim GROUP BY hospital_id""",
    "agg_derived_keys": """
        SELECT hospital_id, visit_date, dayname(visit_date) AS day_of_week,
               CAST(year(visit_date) AS INTEGER) AS visit_year, CAST(month(visit_date) AS INTEGER) AS visit_month,
               count(*) AS visits
        FROM raw_visit GROUP BY hospital_id, visit_date""",
    "agg_distinct": "SELECT DISTINCT approval_status, rejection_reason, reviewed_by FROM silver_claim_approval",
    # windows, order, set operations
    "window_latest": """
        SELECT hospital_id, occupied_beds AS icu_occupied, available_beds AS icu_available, update_time AS icu_time
        FROM (SELECT *, row_number() OVER (PARTITION BY hospital_id ORDER BY update_time DESC, icu_status_id DESC) AS rn
              FROM silver_icu_status) WHERE rn = 1""",
    "surrogate_key": "SELECT patient_id, row_number() OVER (ORDER BY patient_id) AS patient_key FROM raw_patient",
    "sort_multi": """
        SELECT claim_id, hospital_id, claim_date, claim_amount FROM raw_claim
        ORDER BY hospital_id, claim_date DESC, claim_amount DESC, claim_id""",
    "union_all_padded": """
        SELECT from_hospital_id AS hospital_id, referral_date AS operation_date, count(*) AS referrals_sent,
               count(*) FILTER (referral_status = 'Completed') AS completed_referrals_sent,
               count(*) FILTER (referral_status = 'Pending') AS pending_referrals_sent,
               0::BIGINT AS referrals_received, 0::BIGINT AS completed_referrals_received,
               0::BIGINT AS pending_referrals_received
        FROM silver_referral GROUP BY ALL
        UNION ALL
        SELECT to_hospital_id, referral_date, 0, 0, 0, count(*), count(*) FILTER (referral_status = 'Completed'),
               count(*) FILTER (referral_status = 'Pending')
        FROM silver_referral GROUP BY ALL""",
    # scalar functions
    "fn_string": """
        SELECT patient_id, trim(last_name) AS trimmed, lower(last_name) AS lowered,
               regexp_replace(last_name, '[^0-9]', '', 'g') AS digits, substr(last_name, 1, 4) AS head,
               starts_with(last_name, 'Customer') AS starts, '#' || last_name AS joined,
               concat_ws('-', first_name, last_name) AS joined_ws, CAST(length(last_name) AS INTEGER) AS size
        FROM raw_patient""",
    "fn_date": f"""
        SELECT visit_id, visit_date AS parsed, CAST(year(visit_date) AS INTEGER) AS y,
               CAST(month(visit_date) AS INTEGER) AS m, CAST(quarter(visit_date) AS INTEGER) AS q,
               CAST(day(visit_date) AS INTEGER) AS d, CAST(dayofweek(visit_date) + 1 AS INTEGER) AS dow,
               CAST(weekofyear(visit_date) AS INTEGER) AS week,
               CAST(strftime(visit_date, '%Y%m%d') AS INTEGER) AS date_key, monthname(visit_date) AS month_name,
               dayname(visit_date) AS day_name, CAST({AS_OF} - visit_date AS INTEGER) AS days_ago,
               CAST(visit_date - INTERVAL 1 DAY AS DATE) AS day_before
        FROM raw_visit""",
    "fn_math": f"""
        SELECT claim_id, {r2('claim_amount / 3')} AS third, {pct('approved_amount', 'claim_amount')} AS approval_pct,
               claim_amount - coalesce(approved_amount, 0) AS gap,
               {r2(f"CAST({AS_OF} - claim_date AS DOUBLE) / 365.25::DOUBLE")} AS years_ago
        FROM raw_claim""",
    "fn_conditional": """
        SELECT patient_id, coalesce(national_id, 'none') AS national_id, nullif(gender, 'other') AS gender,
               CASE WHEN phone IS NULL THEN 'missing' ELSE 'given' END AS phone_state,
               CAST(phone AS VARCHAR) AS phone_text, CAST(birth_date AS VARCHAR) AS birth_text,
               CAST(NULL AS DATE) AS no_date, CAST(emergency_contact AS DECIMAL(12,2)) AS contact_decimal
        FROM raw_patient""",
    # quality and profiles
    "dq_primary_key": """
        SELECT claim_item_id AS key_value, count(*) AS row_count FROM raw_claim_item
        GROUP BY claim_item_id HAVING count(*) > 1 OR claim_item_id IS NULL""",
    "dq_untrimmed": " UNION ALL ".join(
        [
            untrimmed("hospital", "hospital_id", "hospital_name", "manager_name"),
            untrimmed("doctor", "doctor_id", "first_name", "last_name", "specialty"),
            untrimmed("drug", "drug_id", "manufacturer", "generic_name"),
            untrimmed("claim", "claim_id", "claim_status"),
            untrimmed("diagnosis", "diagnosis_code", "diagnosis_name"),
            untrimmed("bed", "bed_id", "availability_status"),
            untrimmed("claim_approval", "approval_id", "approval_status", "rejection_reason"),
            untrimmed("claim_item", "claim_item_id", "drug_id"),
        ]
    ),
    "dq_domain": " UNION ALL ".join(
        [
            listing("hospital", "hospital_type", "governorate", "district"),
            listing("doctor", "specialty", "employment_status"),
            listing("bed", "bed_type", "availability_status"),
            listing("claim", "claim_status"),
            listing("diagnosis", "severity_level"),
        ]
    ),
    "dq_email": """
        SELECT hospital_id, manager_email FROM raw_hospital
        WHERE manager_email IS NULL OR manager_email NOT LIKE '%_@%.%'""",
    "dq_phone": """
        SELECT doctor_id AS id, phone FROM raw_doctor WHERE phone IS NULL OR phone NOT LIKE '+__-___-___-____'
        UNION ALL
        SELECT hospital_id, hospital_phone FROM silver_hospital
        WHERE hospital_phone IS NULL OR hospital_phone NOT LIKE '+__-___-___-____'""",
    "dq_foreign_key": " UNION ALL ".join(
        [
            references("bed", "hospital_id", "hospital", "hospital_id"),
            references("bed", "department_id", "department", "department_id"),
            references("prescription_item", "prescription_id", "prescription", "prescription_id"),
            references("claim_item", "claim_id", "claim", "claim_id"),
            references("claim_item", "drug_id", "drug", "drug_id"),
        ]
    ),
    "dq_null_date": """
        SELECT 'null_date' AS "check", 'claim_approval' AS table_name, 'approval_date' AS column_name,
               count(*) FILTER (approval_date IS NULL) AS failed_rows,
               min(approval_id) FILTER (approval_date IS NULL) AS sample_key FROM raw_claim_approval
        UNION ALL
        SELECT 'null_date', 'claim', 'claim_date', count(*) FILTER (claim_date IS NULL),
               min(claim_id) FILTER (claim_date IS NULL) FROM raw_claim""",
    "dq_date_order": " UNION ALL ".join(
        f"""SELECT 'order' AS "check", 'claim' AS table_name, '{first},{second}' AS column_name,
            count(*) FILTER ({first} > {second}) AS failed_rows,
            min(c.claim_id) FILTER ({first} > {second}) AS sample_key
            FROM raw_claim c LEFT JOIN raw_claim_approval a ON a.claim_id = c.claim_id"""
        for first, second in (("claim_date", "approval_date"), ("approved_amount", "claim_amount"))
    ),
    "dq_invalid_rows": f"""
        SELECT patient_id, failed_rules FROM (
          SELECT patient_id, concat_ws(',',
            CASE WHEN patient_id IS NULL THEN 'patient_id_missing' END,
            CASE WHEN national_id IS NULL THEN 'national_id_missing' END,
            CASE WHEN birth_date > {AS_OF} THEN 'birth_date_in_future' END,
            CASE WHEN {AGE} < 0 THEN 'negative_age' END,
            CASE WHEN gender NOT IN ('Male', 'Female') THEN 'gender_unknown' END,
            CASE WHEN blood_type NOT IN ('A+', 'A-', 'B+', 'B-', 'AB+', 'AB-', 'O+', 'O-') THEN 'blood_type_unknown' END,
            CASE WHEN phone = emergency_contact THEN 'phone_is_emergency_contact' END,
            CASE WHEN length(CAST(phone AS VARCHAR)) <> 10 THEN 'phone_length' END,
            CASE WHEN NOT regexp_matches(national_id, '^[0-9]+$') THEN 'national_id_not_numeric' END) AS failed_rules
          FROM raw_patient) WHERE failed_rules <> ''""",
    "dq_outlier_iqr": " UNION ALL ".join(
        [
            outliers("hospital", "hospital_id", "icu_capacity"),
            outliers("doctor", "doctor_id", "years_experience"),
            outliers("claim", "claim_id", "claim_amount"),
            outliers("claim", "claim_id", "approved_amount"),
            outliers("claim_items", "claim_item_id", "item_amount"),
            outliers("claim_items", "claim_item_id", "item_quantity"),
        ]
    ),
    "profile_describe": " UNION ALL ".join(
        f"SELECT '{name}' AS summary, "
        + ", ".join(f"{text.format(c)} AS {c}" for c in ("claim_id", "patient_id", "visit_id", "hospital_id", "claim_status"))
        + ", "
        + ", ".join(f"{r2(f'CAST({number.format(c)} AS DOUBLE)')} AS {c}" for c in ("claim_amount", "approved_amount"))
        + " FROM raw_claim"
        for name, text, number in (
            ("count", "CAST(count({}) AS VARCHAR)", "count({})"),
            ("mean", "CAST(NULL AS VARCHAR)", "avg({})"),
            ("stddev", "CAST(NULL AS VARCHAR)", "stddev_samp({})"),
            ("min", "min({})", "min({})"),
            ("max", "max({})", "max({})"),
        )
    ),
    "profile_nulls": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM raw_patient" for c in PATIENT_PROFILE
    ),
    "profile_columns": " UNION ALL ".join(profile_row(c) for c in PATIENT_PROFILE),
    "profile_value_counts": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS value_count FROM raw_patient GROUP BY {c} "
        "HAVING count(*) > 1"
        for c in ("gender", "city", "governorate", "blood_type")
    ),
    "profile_phone": """
        SELECT patient_id, phone, emergency_contact, CAST(length(CAST(phone AS VARCHAR)) AS INTEGER) AS phone_length,
               CAST(coalesce(phone = emergency_contact, false) AS INTEGER) AS equals_emergency_contact,
               CAST(coalesce(length(CAST(phone AS VARCHAR)) <> 10, false) AS INTEGER) AS wrong_length,
               CAST(coalesce(substr(CAST(phone AS VARCHAR), 1, 2) NOT IN ('10', '11', '12', '15'), false) AS INTEGER)
                 AS wrong_prefix,
               CAST(phone IS NOT NULL AND count(*) OVER (PARTITION BY phone) > 1 AS INTEGER) AS shared_phone
        FROM raw_patient""",
    "load_by_name": f"SELECT *, 'run-1' AS pipeline_run_id FROM {MIXED_CLAIMS}",
    "load_rejects": f"""
        SELECT claim_id || ',none' AS raw_row, CAST(1 AS INTEGER) AS parsed_values, 'run-1' AS pipeline_run_id, {AS_OF} AS ingestion_date
        FROM raw_claim WHERE {PENDING_CLAIM}""",
    "load_metrics": " UNION ALL ".join(
        [
            load_row("patient"),
            load_row("visit"),
            load_row("claim", MIXED_CLAIMS, ("note",), f"count(*) FILTER ({PENDING_CLAIM})"),
        ]
    ),
    "load_metrics_history": " UNION ALL ".join(
        f"SELECT '{run}' AS pipeline_run_id, {day} AS load_date, * FROM ({load_row(t)})"
        for run, day in (("run-1", "DATE '1998-01-01'"), ("run-2", "DATE '2000-01-01'"))
        for t in ("patient", "claim")
    ),
}

# Cleaned tables are checked as they are.
OPERATOR_SQL |= {name: f"SELECT * FROM {name}" for name in TABLES if name.startswith("silver_")}
