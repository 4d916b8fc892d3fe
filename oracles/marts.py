"""The seven marts, their summaries and samples."""

from __future__ import annotations

from oracles.base import AS_OF, TABLES, pct, r2, r2z, ratio


def z(value: str) -> str:
    return f"CAST(coalesce({value}, 0) AS BIGINT)"


def zi(value: str) -> str:
    return f"CAST(coalesce({value}, 0) AS INTEGER)"


def three(value: str, high: str, low: str, labels: tuple[str, str, str], default: str) -> str:
    return (
        f"CASE WHEN {value} > {high} THEN '{labels[0]}' WHEN {value} BETWEEN {low} AND {high} THEN '{labels[1]}' "
        f"WHEN {value} < {low} THEN '{labels[2]}' ELSE '{default}' END"
    )


def rated(value: str, labels: tuple[str, str, str]) -> str:
    return (
        f"CASE WHEN {value} >= 4 THEN '{labels[0]}' WHEN {value} BETWEEN 3 AND 4 THEN '{labels[1]}' "
        f"WHEN {value} < 3 THEN '{labels[2]}' ELSE 'No Rating' END"
    )


def visits_per(key: str, *more: str) -> str:
    extra = "".join(f", {m}" for m in more)
    return f"""(SELECT {key}, count(*) AS n, count(*) FILTER (visit_type = 'Outpatient') AS n_out,
        count(*) FILTER (visit_type = 'Inpatient') AS n_in, count(*) FILTER (visit_type = 'Follow-up') AS n_follow,
        avg(waiting_time) AS wait, sum(total_amount) AS amount, avg(total_amount) AS mean_amount,
        min(visit_date) AS first_day, max(visit_date) AS last_day{extra}
        FROM silver_visit GROUP BY {key})"""


def ratings_per(key: str) -> str:
    return f"""(SELECT {key}, count(*) AS n, avg(rating) AS mean, min(rating) AS low, max(rating) AS high,
        count(*) FILTER (rating >= 4) AS good, count(*) FILTER (rating <= 2) AS bad
        FROM silver_patient_feedback GROUP BY {key})"""


def beds_per(keys: str) -> str:
    return f"""(SELECT {keys}, count(*) AS n, count(*) FILTER (availability_status = 'Available') AS free,
        count(*) FILTER (availability_status = 'Occupied') AS used, count(*) FILTER (bed_type = 'ICU') AS icu,
        count(*) FILTER (bed_type = 'Standard') AS standard FROM silver_bed GROUP BY {keys})"""


LAST_ICU = """(SELECT hospital_id, arg_max(occupied_beds, (update_time, icu_status_id)) AS used,
    arg_max(available_beds, (update_time, icu_status_id)) AS free, max(update_time) AS at
    FROM silver_icu_status GROUP BY hospital_id)"""

VISIT_COLUMNS = f"""{z('v.n')} AS total_visits, {z('v.n_out')} AS outpatient_visits, {z('v.n_in')} AS inpatient_visits,
    {z('v.n_follow')} AS followup_visits, {r2z('v.wait')} AS avg_waiting_time_minutes,
    v.first_day AS first_visit_date, v.last_day AS last_visit_date"""

TABLES["mart_patient"] = f"""
    SELECT p.patient_id, p.patient_name, p.gender, p.birth_date, p.patient_age AS age,
           CASE WHEN p.patient_age < 18 THEN 'Child (0-17)' WHEN p.patient_age <= 35 THEN 'Young Adult (18-35)'
                WHEN p.patient_age <= 55 THEN 'Middle Age (36-55)' WHEN p.patient_age <= 70 THEN 'Senior (56-70)'
                ELSE 'Elderly (70+)' END AS age_group,
           p.blood_type, p.governorate, p.city, {VISIT_COLUMNS},
           {z('v.hospitals')} AS hospitals_visited, {z('v.diagnoses')} AS unique_diagnoses,
           {r2z('v.amount')} AS total_visit_cost, {r2z('v.mean_amount')} AS avg_cost_per_visit,
           {z('c.n')} AS total_claims, {z('c.yes')} AS approved_claims, {z('c.no')} AS rejected_claims,
           {r2z('c.claimed')} AS total_claimed_amount, {r2z('c.approved')} AS total_approved_amount,
           {r2z('c.denied')} AS total_denied_amount, {r2z('c.share * 100')} AS claim_approval_rate_pct,
           {z('f.n')} AS feedback_count, {r2z('f.mean')} AS avg_satisfaction_rating, f.low AS min_rating,
           f.high AS max_rating,
           {three('v.n', '10', '5', ('High Utilization', 'Medium Utilization', 'Low Utilization'), 'No Visits')}
             AS utilization_category
    FROM silver_patient p
    LEFT JOIN {visits_per('patient_id', 'count(DISTINCT hospital_id) AS hospitals',
                          'count(DISTINCT diagnosis_code) AS diagnoses')} v ON v.patient_id = p.patient_id
    LEFT JOIN (SELECT patient_id, count(*) AS n, count(*) FILTER (claim_status = 'Approved') AS yes,
                      count(*) FILTER (claim_status = 'Rejected') AS no, sum(claim_amount) AS claimed,
                      sum(approved_amount) AS approved, sum(claim_amount - approved_amount) AS denied,
                      avg(approved_amount / nullif(claim_amount, 0)) AS share
               FROM silver_claim GROUP BY patient_id) c ON c.patient_id = p.patient_id
    LEFT JOIN {ratings_per('patient_id')} f ON f.patient_id = p.patient_id"""

OCCUPANCY = "b.used * 100.0::DOUBLE / nullif(h.total_beds, 0)"

TABLES["mart_hospital"] = f"""
    SELECT h.hospital_id, h.hospital_name, h.hospital_type, h.governorate, h.district, h.manager_name, h.total_beds,
           h.icu_capacity, {z('b.n')} AS beds_in_system, {z('b.free')} AS current_available_beds,
           {z('b.used')} AS current_occupied_beds, {pct('b.used', 'h.total_beds')} AS bed_occupancy_rate_pct,
           {z('b.icu')} AS icu_beds_tracked, {z('b.standard')} AS standard_beds_tracked,
           {zi('u.used')} AS latest_icu_occupied, {zi('u.free')} AS latest_icu_available,
           {pct('u.used', 'h.icu_capacity')} AS icu_occupancy_rate_pct, u.at AS latest_icu_update,
           {z('d.n')} AS total_departments,
           CASE WHEN d.emergency > 0 THEN 'Yes' ELSE 'No' END AS has_emergency_department,
           {VISIT_COLUMNS}, {z('v.patients')} AS unique_patients_served, {z('v.doctors')} AS unique_doctors_count,
           {r2z('v.amount')} AS total_revenue, {r2z('v.mean_amount')} AS avg_revenue_per_visit,
           {ratio('v.amount', 'v.n')} AS revenue_per_visit,
           {z('f.n')} AS feedback_count, {r2z('f.mean')} AS avg_patient_rating, f.low AS min_rating, f.high AS max_rating,
           {z('f.good')} AS positive_feedback_count, {z('f.bad')} AS negative_feedback_count,
           {pct('f.good', 'f.n')} AS positive_feedback_rate_pct,
           (SELECT count(*) FROM silver_referral r WHERE r.from_hospital_id = h.hospital_id) AS referrals_sent,
           (SELECT count(*) FROM silver_referral r WHERE r.to_hospital_id = h.hospital_id) AS referrals_received,
           {three('v.n', '10000', '5000', ('High Volume', 'Medium Volume', 'Low Volume'), 'No Activity')} AS volume_category,
           {three(OCCUPANCY, '80', '60', ('High Occupancy', 'Moderate Occupancy', 'Low Occupancy'), 'Unknown')}
             AS occupancy_category,
           {rated('f.mean', ('Excellent', 'Good', 'Needs Improvement'))} AS satisfaction_category
    FROM silver_hospital h
    LEFT JOIN {visits_per('hospital_id', 'count(DISTINCT patient_id) AS patients',
                          'count(DISTINCT doctor_id) AS doctors')} v ON v.hospital_id = h.hospital_id
    LEFT JOIN {beds_per('hospital_id')} b ON b.hospital_id = h.hospital_id
    LEFT JOIN {LAST_ICU} u ON u.hospital_id = h.hospital_id
    LEFT JOIN (SELECT hospital_id, count(*) AS n, count(*) FILTER (department_name = 'Emergency') AS emergency
               FROM silver_department GROUP BY hospital_id) d ON d.hospital_id = h.hospital_id
    LEFT JOIN {ratings_per('hospital_id')} f ON f.hospital_id = h.hospital_id"""

TABLES["mart_doctor"] = f"""
    SELECT d.doctor_id, d.doctor_name, d.hospital_id, h.hospital_name, h.hospital_type, d.department_id,
           e.department_name, d.specialty, d.years_experience, d.employment_status, {VISIT_COLUMNS},
           {z('v.patients')} AS unique_patients_treated, {z('v.diagnoses')} AS unique_diagnoses_handled,
           {r2z('v.amount')} AS total_revenue, {r2z('v.mean_amount')} AS avg_revenue_per_visit,
           {z('f.n')} AS feedback_count, {r2z('f.mean')} AS avg_patient_rating, f.low AS min_rating, f.high AS max_rating,
           {z('f.good')} AS positive_feedback_count, {z('f.bad')} AS negative_feedback_count,
           {pct('f.good', 'f.n')} AS positive_feedback_rate_pct,
           {z('s.n')} AS total_shifts, {z('s.days')} AS days_scheduled, s.first_shift_date, s.last_shift_date,
           {three('v.n', '100', '50', ('High Workload', 'Medium Workload', 'Low Workload'), 'No Visits')} AS workload_category,
           {rated('f.mean', ('High Performance', 'Average Performance', 'Needs Improvement'))} AS performance_category
    FROM silver_doctor d
    LEFT JOIN silver_hospital h ON h.hospital_id = d.hospital_id
    LEFT JOIN silver_department e ON e.department_id = d.department_id
    LEFT JOIN {visits_per('doctor_id', 'count(DISTINCT patient_id) AS patients',
                          'count(DISTINCT diagnosis_code) AS diagnoses')} v ON v.doctor_id = d.doctor_id
    LEFT JOIN {ratings_per('doctor_id')} f ON f.doctor_id = d.doctor_id
    LEFT JOIN (SELECT doctor_id, count(*) AS n, count(DISTINCT shift_date) AS days, min(shift_date) AS first_shift_date,
                      max(shift_date) AS last_shift_date FROM silver_doctor_schedule GROUP BY doctor_id) s
      ON s.doctor_id = d.doctor_id"""

TABLES["mart_claims"] = f"""
    SELECT c.claim_id, c.patient_id, c.visit_id, c.hospital_id, h.hospital_name, h.hospital_type, h.governorate,
           c.claim_date, CAST(year(c.claim_date) AS INTEGER) AS claim_year,
           CAST(month(c.claim_date) AS INTEGER) AS claim_month, CAST(quarter(c.claim_date) AS INTEGER) AS claim_quarter,
           v.visit_type, v.diagnosis_code, v.symptoms, {r2('c.claim_amount')} AS claim_amount,
           {r2('c.approved_amount')} AS approved_amount,
           {r2('c.claim_amount - c.approved_amount')} AS denied_amount, c.claim_status,
           {pct('c.approved_amount', 'c.claim_amount')} AS approval_rate_pct,
           {pct('(c.claim_amount - c.approved_amount)', 'c.claim_amount')} AS denial_rate_pct,
           a.reviewed_by, a.approval_status, a.approval_date, a.rejection_reason,
           {zi('a.approval_date - c.claim_date')} AS approval_turnaround_days,
           {z('i.n')} AS total_claim_items, {z('i.procedures')} AS procedures_in_claim, {z('i.drugs')} AS drugs_in_claim,
           {r2z('i.amount')} AS total_items_amount, {z('i.quantity')} AS total_items_quantity,
           {three('c.claim_amount', '10000', '5000', ('High Value', 'Medium Value', 'Low Value'), 'Unknown')}
             AS claim_value_category,
           CASE WHEN c.claim_status = 'Rejected' THEN 'Rejected' WHEN c.claim_status <> 'Approved' THEN 'Unknown'
                WHEN c.approved_amount = c.claim_amount THEN 'Fully Approved'
                WHEN c.approved_amount < c.claim_amount THEN 'Partially Approved' ELSE 'Unknown' END AS approval_category,
           CASE WHEN a.approval_date - c.claim_date <= 3 THEN 'Fast Processing'
                WHEN a.approval_date - c.claim_date <= 7 THEN 'Normal Processing'
                WHEN a.approval_date - c.claim_date > 7 THEN 'Slow Processing' ELSE 'Unknown' END
             AS processing_speed_category
    FROM silver_claim c
    LEFT JOIN (SELECT claim_id, count(*) AS n, count(DISTINCT procedure_code) AS procedures,
                      count(DISTINCT drug_id) AS drugs, sum(item_amount) AS amount, sum(item_quantity) AS quantity
               FROM silver_claim_items GROUP BY claim_id) i ON i.claim_id = c.claim_id
    LEFT JOIN silver_claim_approval a ON a.claim_id = c.claim_id
    LEFT JOIN silver_visit v ON v.visit_id = c.visit_id
    LEFT JOIN silver_hospital h ON h.hospital_id = c.hospital_id"""

DAYS_LEFT = f"(i.first_expiry - {AS_OF})"

TABLES["mart_drug"] = f"""
    SELECT d.drug_id, d.drug_name, d.generic_name, d.manufacturer, d.drug_category, {r2('d.unit_amount')} AS unit_price,
           {z('p.n')} AS total_prescriptions, {z('p.slips')} AS unique_prescriptions,
           {z('p.quantity')} AS total_quantity_prescribed, {r2z('p.mean_quantity')} AS avg_quantity_per_prescription,
           {r2z('p.mean_days')} AS avg_treatment_duration_days, {z('p.once')} AS once_daily_prescriptions,
           {z('p.twice')} AS twice_daily_prescriptions, {z('p.thrice')} AS thrice_daily_prescriptions,
           {z('i.hospitals')} AS hospitals_stocking_drug, {z('i.stock')} AS current_stock_quantity,
           {r2z('i.mean_stock')} AS avg_stock_per_hospital, {z('i.reorder')} AS total_reorder_level,
           {r2z('i.mean_reorder')} AS avg_reorder_level, i.first_expiry AS earliest_expiration_date,
           i.last_expiry AS latest_expiration_date, {z('i.low')} AS low_stock_locations,
           {z('t.n')} AS total_transactions, {z('t.n_buy')} AS purchase_transactions,
           {z('t.n_give')} AS dispensing_transactions, {z('t.bought')} AS total_purchased_quantity,
           {z('t.given')} AS total_dispensed_quantity, t.first_day AS first_transaction_date,
           t.last_day AS last_transaction_date, {r2z('p.quantity * d.unit_amount')} AS total_prescription_value,
           {r2z('i.stock * d.unit_amount')} AS current_inventory_value,
           CASE WHEN t.given > 0 AND i.stock > 0 THEN {r2('CAST(t.given AS DOUBLE) * 100 / (t.given + i.stock)')}
                ELSE 0.0::DOUBLE END AS utilization_rate_pct,
           CASE WHEN t.bought > 0 AND t.given > 0 THEN {r2('CAST(t.given AS DOUBLE) * 100 / t.bought')}
                ELSE 0.0::DOUBLE END AS turnover_rate_pct,
           {three('p.n', '1000', '500', ('High Demand', 'Medium Demand', 'Low Demand'), 'No Demand')} AS demand_category,
           CASE WHEN i.low > 0 THEN 'Stock Alert' WHEN i.stock < i.reorder THEN 'Reorder Needed'
                WHEN i.stock >= i.reorder THEN 'Adequate Stock' ELSE 'Unknown' END AS stock_status,
           CASE WHEN {DAYS_LEFT} < 30 THEN 'Expiring Soon' WHEN {DAYS_LEFT} BETWEEN 30 AND 90 THEN 'Monitor Expiration'
                WHEN {DAYS_LEFT} > 90 THEN 'Good Shelf Life' ELSE 'Unknown' END AS expiration_status
    FROM silver_drug d
    LEFT JOIN (SELECT drug_id, count(*) AS n, count(DISTINCT prescription_id) AS slips, sum(quantity) AS quantity,
                      avg(quantity) AS mean_quantity, avg(duration_days) AS mean_days,
                      count(*) FILTER (frequency = 'Once Daily') AS once,
                      count(*) FILTER (frequency = 'Twice Daily') AS twice,
                      count(*) FILTER (frequency = 'Three Times Daily') AS thrice
               FROM silver_prescription_items GROUP BY drug_id) p ON p.drug_id = d.drug_id
    LEFT JOIN (SELECT drug_id, count(DISTINCT hospital_id) AS hospitals, sum(quantity_available) AS stock,
                      avg(quantity_available) AS mean_stock, sum(reorder_level) AS reorder,
                      avg(reorder_level) AS mean_reorder, min(expiration_date) AS first_expiry,
                      max(expiration_date) AS last_expiry, count(*) FILTER (quantity_available < reorder_level) AS low
               FROM silver_drug_inventory GROUP BY drug_id) i ON i.drug_id = d.drug_id
    LEFT JOIN (SELECT drug_id, count(*) AS n, count(*) FILTER (transaction_type = 'Purchase') AS n_buy,
                      count(*) FILTER (transaction_type = 'Dispensing') AS n_give,
                      sum(CASE WHEN transaction_type = 'Purchase' THEN quantity ELSE 0 END) AS bought,
                      sum(CASE WHEN transaction_type = 'Dispensing' THEN quantity ELSE 0 END) AS given,
                      min(transaction_date) AS first_day, max(transaction_date) AS last_day
               FROM silver_drug_transaction GROUP BY drug_id) t ON t.drug_id = d.drug_id"""

EARNED = "(coalesce(v.revenue, 0) + coalesce(p.revenue, 0))"

TABLES["mart_financial"] = f"""
    SELECT v.hospital_id, h.hospital_name, h.hospital_type, h.governorate, v.visit_date AS transaction_date,
           CAST(year(v.visit_date) AS INTEGER) AS revenue_year, CAST(month(v.visit_date) AS INTEGER) AS revenue_month,
           CAST(quarter(v.visit_date) AS INTEGER) AS revenue_quarter, v.visit_type, v.department_id, d.department_name,
           v.n AS visit_count, {r2z('v.revenue')} AS total_visit_revenue, {z('p.n')} AS procedure_count,
           {r2z('p.revenue')} AS total_procedure_revenue, {z('c.n')} AS claim_count,
           {r2z('c.claimed')} AS total_claimed_amount, {r2z('c.approved')} AS total_approved_amount,
           {r2z('c.denied')} AS total_denied_amount, {r2z(EARNED)} AS total_revenue,
           {pct('c.approved', 'c.claimed')} AS reimbursement_rate_pct,
           {r2z(f'{EARNED} - coalesce(c.approved, 0)')} AS net_revenue_after_claims,
           {ratio('v.revenue', 'v.n')} AS avg_revenue_per_visit,
           {ratio('p.revenue', 'p.n')} AS avg_revenue_per_procedure,
           {ratio('c.approved', 'c.n')} AS avg_approved_per_claim
    FROM (SELECT hospital_id, visit_date, visit_type, department_id, count(*) AS n, sum(total_amount) AS revenue
          FROM silver_visit GROUP BY ALL) v
    LEFT JOIN (SELECT x.hospital_id, y.procedure_date, count(*) AS n, sum(y.procedure_amount) AS revenue
               FROM silver_visit_procedure y JOIN silver_visit x ON x.visit_id = y.visit_id GROUP BY ALL) p
      ON p.hospital_id = v.hospital_id AND p.procedure_date = v.visit_date
    LEFT JOIN (SELECT hospital_id, claim_date, count(*) AS n, sum(claim_amount) AS claimed,
                      sum(approved_amount) AS approved, sum(claim_amount - approved_amount) AS denied
               FROM silver_claim GROUP BY ALL) c
      ON c.hospital_id = v.hospital_id AND c.claim_date = v.visit_date
    LEFT JOIN silver_hospital h ON h.hospital_id = v.hospital_id
    LEFT JOIN silver_department d ON d.department_id = v.department_id AND d.hospital_id = v.hospital_id"""

OPERATION_OCCUPANCY = "b.used * 100.0::DOUBLE / nullif(h.total_beds, 0)"

TABLES["mart_operational"] = f"""
    SELECT v.hospital_id, h.hospital_name, h.hospital_type, h.governorate, v.department_id, d.department_name,
           v.visit_date AS operation_date, dayname(v.visit_date) AS day_of_week,
           CAST(year(v.visit_date) AS INTEGER) AS visit_year, CAST(month(v.visit_date) AS INTEGER) AS visit_month,
           v.visit_type, v.n AS total_visits, v.patients AS unique_patients, v.doctors AS doctors_on_duty,
           v.done AS completed_visits, v.cancelled AS cancelled_visits, {pct('v.done', 'v.n')} AS completion_rate_pct,
           {r2z('v.wait')} AS avg_waiting_time_minutes, {zi('v.shortest')} AS min_waiting_time_minutes,
           {zi('v.longest')} AS max_waiting_time_minutes, h.total_beds AS hospital_capacity_beds,
           {z('b.n')} AS beds_tracked, {z('b.free')} AS available_beds, {z('b.used')} AS occupied_beds,
           {pct('b.used', 'h.total_beds')} AS bed_occupancy_rate_pct, {z('b.icu')} AS icu_beds_tracked,
           {z('b.standard')} AS standard_beds_tracked, h.icu_capacity AS hospital_icu_capacity,
           {zi('u.used')} AS current_icu_occupied, {zi('u.free')} AS current_icu_available,
           {pct('u.used', 'h.icu_capacity')} AS icu_occupancy_rate_pct, u.at AS icu_last_updated,
           CAST(r.sent AS BIGINT) AS referrals_sent, CAST(r.received AS BIGINT) AS referrals_received,
           CAST(r.sent_done AS BIGINT) AS completed_referrals_sent, CAST(r.sent_open AS BIGINT) AS pending_referrals_sent,
           {z('s.doctors')} AS doctors_scheduled, {z('s.n')} AS total_shifts_scheduled,
           {ratio('v.n', 'v.doctors')} AS visits_per_doctor,
           CASE WHEN v.wait < 30 THEN 'Efficient' WHEN v.wait <= 60 THEN 'Moderate'
                WHEN v.wait > 60 THEN 'Needs Improvement' ELSE 'Unknown' END AS wait_time_efficiency,
           {three(OPERATION_OCCUPANCY, '85', '70', ('Critical', 'High', 'Normal'), 'Unknown')} AS capacity_status,
           {three('v.n', '100', '50', ('High Volume', 'Medium Volume', 'Low Volume'), 'No Activity')}
             AS daily_volume_category
    FROM (SELECT hospital_id, department_id, visit_date, visit_type, count(*) AS n,
                 count(DISTINCT patient_id) AS patients, count(DISTINCT doctor_id) AS doctors,
                 avg(waiting_time) AS wait, min(waiting_time) AS shortest, max(waiting_time) AS longest,
                 count(*) FILTER (visit_status = 'Completed') AS done,
                 count(*) FILTER (visit_status = 'Cancelled') AS cancelled
          FROM silver_visit GROUP BY ALL) v
    LEFT JOIN silver_hospital h ON h.hospital_id = v.hospital_id
    LEFT JOIN silver_department d ON d.department_id = v.department_id AND d.hospital_id = v.hospital_id
    LEFT JOIN {beds_per('hospital_id, department_id')} b
      ON b.hospital_id = v.hospital_id AND b.department_id = v.department_id
    LEFT JOIN {LAST_ICU} u ON u.hospital_id = v.hospital_id
    LEFT JOIN (SELECT hospital_id, day, count(*) FILTER (out) AS sent, count(*) FILTER (NOT out) AS received,
                      count(*) FILTER (out AND referral_status = 'Completed') AS sent_done,
                      count(*) FILTER (out AND referral_status = 'Pending') AS sent_open
               FROM (SELECT from_hospital_id AS hospital_id, referral_date AS day, referral_status, true AS out
                     FROM silver_referral
                     UNION ALL SELECT to_hospital_id, referral_date, referral_status, false FROM silver_referral)
               GROUP BY ALL) r ON r.hospital_id = v.hospital_id AND r.day = v.visit_date
    LEFT JOIN (SELECT o.hospital_id, w.shift_date, count(DISTINCT w.doctor_id) AS doctors, count(*) AS n
               FROM silver_doctor_schedule w JOIN silver_doctor o ON o.doctor_id = w.doctor_id GROUP BY ALL) s
      ON s.hospital_id = v.hospital_id AND s.shift_date = v.visit_date"""


def means(**named: str) -> str:
    return ", ".join(f"{r2(f'avg({old})')} AS {new}" for new, old in named.items())


FINANCIAL_GROUP = "hospital_name, hospital_type, revenue_year, revenue_quarter"
OPERATIONAL_GROUP = "hospital_name, hospital_type, visit_year, visit_month"
OPERATIONAL_MEANS = means(
    avg_wait_time="avg_waiting_time_minutes",
    avg_bed_occupancy="bed_occupancy_rate_pct",
    avg_icu_occupancy="icu_occupancy_rate_pct",
    avg_completion_rate="completion_rate_pct",
)

MART_SQL: dict[str, str] = {name: f"SELECT * FROM {name}" for name in TABLES if name.startswith("mart_")}
MART_SQL |= {
    "summary_patient": f"""
        SELECT age_group, gender, utilization_category, count(*) AS total_patients, count(*) AS patient_count,
               {means(avg_visits_per_patient='total_visits', avg_total_cost='total_visit_cost',
                      avg_satisfaction='avg_satisfaction_rating', avg_claim_approval_rate='claim_approval_rate_pct')}
        FROM mart_patient GROUP BY ALL""",
    "summary_hospital": f"""
        SELECT hospital_type, volume_category, satisfaction_category, count(*) AS total_hospitals,
               {means(avg_visits_per_hospital='total_visits', avg_bed_occupancy_pct='bed_occupancy_rate_pct',
                      avg_icu_occupancy_pct='icu_occupancy_rate_pct', avg_rating='avg_patient_rating',
                      avg_revenue_per_hospital='total_revenue', avg_wait_time='avg_waiting_time_minutes')}
        FROM mart_hospital GROUP BY ALL""",
    "summary_doctor": f"""
        SELECT specialty, workload_category, performance_category, count(*) AS total_doctors,
               {means(avg_visits_per_doctor='total_visits', avg_patients_per_doctor='unique_patients_treated',
                      avg_rating='avg_patient_rating', avg_revenue_per_doctor='total_revenue',
                      avg_wait_time='avg_waiting_time_minutes')}
        FROM mart_doctor GROUP BY ALL""",
    "summary_claims": f"""
        SELECT claim_status, claim_value_category, count(DISTINCT claim_id) AS total_claims,
               {means(avg_claim_amount='claim_amount', avg_approved_amount='approved_amount',
                      avg_approval_rate='approval_rate_pct', avg_turnaround_days='approval_turnaround_days')},
               {r2('sum(claim_amount)')} AS total_claim_amount, {r2('sum(approved_amount)')} AS total_approved_amount
        FROM mart_claims GROUP BY ALL""",
    "summary_drug": f"""
        SELECT drug_category, demand_category, count(*) AS total_drugs,
               {means(avg_prescriptions='total_prescriptions', avg_stock='current_stock_quantity',
                      avg_turnover_rate='turnover_rate_pct')},
               {r2('sum(total_prescription_value)')} AS total_prescription_value,
               {r2('sum(current_inventory_value)')} AS total_inventory_value,
               count(*) FILTER (stock_status = 'Stock Alert') AS drugs_with_stock_alert
        FROM mart_drug GROUP BY ALL""",
    "summary_financial": f"""
        SELECT {FINANCIAL_GROUP}, CAST(sum(visits) AS BIGINT) AS total_visits,
               {r2('sum(visit_revenue + procedure_revenue)')} AS total_revenue, {r2('sum(claimed)')} AS total_claimed,
               {r2('sum(approved)')} AS total_approved, {r2('avg(rate)')} AS avg_reimbursement_rate,
               {r2('sum(visit_revenue + procedure_revenue - approved)')} AS net_revenue
        FROM (SELECT {FINANCIAL_GROUP}, hospital_id, transaction_date, sum(visit_count) AS visits,
                     sum(total_visit_revenue) AS visit_revenue, any_value(total_procedure_revenue) AS procedure_revenue,
                     any_value(total_claimed_amount) AS claimed, any_value(total_approved_amount) AS approved,
                     any_value(reimbursement_rate_pct) AS rate
              FROM mart_financial GROUP BY ALL)
        GROUP BY {FINANCIAL_GROUP}""",
    "summary_financial_by_row": f"""
        SELECT {FINANCIAL_GROUP}, CAST(sum(visit_count) AS BIGINT) AS total_visits,
               {r2('sum(total_revenue)')} AS total_revenue, {r2('sum(total_claimed_amount)')} AS total_claimed,
               {r2('sum(total_approved_amount)')} AS total_approved,
               {r2('avg(reimbursement_rate_pct)')} AS avg_reimbursement_rate,
               {r2('sum(net_revenue_after_claims)')} AS net_revenue
        FROM mart_financial GROUP BY {FINANCIAL_GROUP}""",
    "summary_operational": f"""
        SELECT s.*, r.total_referrals_sent, r.total_referrals_received
        FROM (SELECT {OPERATIONAL_GROUP}, CAST(sum(total_visits) AS BIGINT) AS total_visits, {OPERATIONAL_MEANS}
              FROM mart_operational GROUP BY {OPERATIONAL_GROUP}) s
        JOIN (SELECT {OPERATIONAL_GROUP}, CAST(sum(referrals_sent) AS BIGINT) AS total_referrals_sent,
                     CAST(sum(referrals_received) AS BIGINT) AS total_referrals_received
              FROM (SELECT DISTINCT {OPERATIONAL_GROUP}, hospital_id, operation_date, referrals_sent, referrals_received
                    FROM mart_operational) GROUP BY {OPERATIONAL_GROUP}) r
          ON (s.hospital_name, s.hospital_type, s.visit_year, s.visit_month)
             = (r.hospital_name, r.hospital_type, r.visit_year, r.visit_month)""",
    "summary_operational_by_row": f"""
        SELECT {OPERATIONAL_GROUP}, CAST(sum(total_visits) AS BIGINT) AS total_visits, {OPERATIONAL_MEANS},
               CAST(sum(referrals_sent) AS BIGINT) AS total_referrals_sent,
               CAST(sum(referrals_received) AS BIGINT) AS total_referrals_received
        FROM mart_operational GROUP BY {OPERATIONAL_GROUP}""",
    "topk_hospital": """
        SELECT hospital_name, hospital_type, total_visits, bed_occupancy_rate_pct, icu_occupancy_rate_pct,
               avg_patient_rating, total_revenue, volume_category, satisfaction_category
        FROM mart_hospital ORDER BY total_visits DESC, hospital_id LIMIT 10""",
    "topk_doctor": """
        SELECT doctor_name, specialty, hospital_name, total_visits, unique_patients_treated, avg_patient_rating,
               total_revenue, workload_category, performance_category
        FROM mart_doctor ORDER BY total_visits DESC, doctor_id LIMIT 10""",
    "topk_claims": """
        SELECT claim_id, hospital_name, claim_date, visit_type, claim_amount, approved_amount, claim_status,
               approval_rate_pct, approval_turnaround_days, claim_value_category
        FROM mart_claims ORDER BY claim_date DESC, claim_id, approval_date LIMIT 10""",
    "topk_drug": """
        SELECT drug_name, drug_category, total_prescriptions, current_stock_quantity, total_prescription_value,
               demand_category, stock_status, expiration_status
        FROM mart_drug ORDER BY total_prescriptions DESC, drug_id LIMIT 10""",
    "topk_financial": """
        SELECT hospital_name, transaction_date, visit_type, department_name, visit_count, total_revenue,
               reimbursement_rate_pct, net_revenue_after_claims
        FROM mart_financial
        ORDER BY transaction_date DESC, total_revenue DESC, hospital_id, visit_type, department_id LIMIT 10""",
    "topk_operational": """
        SELECT hospital_name, operation_date, day_of_week, department_name, total_visits, avg_waiting_time_minutes,
               bed_occupancy_rate_pct, wait_time_efficiency, capacity_status
        FROM mart_operational
        ORDER BY operation_date DESC, total_visits DESC, hospital_id, department_id, visit_type LIMIT 10""",
    "lookup_operational": """
        SELECT * FROM mart_operational WHERE hospital_id = 'H5' AND operation_date = DATE '1997-02-09'""",
    "daily_occupancy": """
        SELECT hospital_id, department_id, operation_date, visit_type, occupied_beds FROM mart_operational""",
}
