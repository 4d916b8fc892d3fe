from __future__ import annotations

import datetime as dt

import pytest

from tests.conftest import listed
from wardflow.plans import marts
from wardflow.plans.marts.hospital import HospitalThresholds
from wardflow.plans.marts.patient import PatientThresholds

D = dt.date
DAY, LATER = D(2024, 6, 3), D(2024, 6, 4)

SCHEMAS = {
    "patient": "patient_id string, patient_name string, gender string, birth_date date, patient_age int, blood_type string, governorate string, city string",
    "hospital": "hospital_id string, hospital_name string, hospital_type string, governorate string, district string, total_beds int, icu_capacity int, manager_name string",
    "department": "department_id string, hospital_id string, department_name string",
    "doctor": "doctor_id string, doctor_name string, hospital_id string, department_id string, specialty string, years_experience int, employment_status string",
    "visit": "visit_id string, patient_id string, doctor_id string, hospital_id string, department_id string, diagnosis_code string, visit_type string, visit_status string, symptoms string, visit_date date, waiting_time int, total_amount double",
    "visit_procedure": "visit_procedure_id string, visit_id string, procedure_date date, procedure_amount double",
    "claim": "claim_id string, patient_id string, visit_id string, hospital_id string, claim_status string, claim_date date, claim_amount double, approved_amount double",
    "claim_items": "claim_item_id string, claim_id string, procedure_code string, drug_id string, item_quantity int, item_amount double",
    "claim_approval": "approval_id string, claim_id string, approval_status string, rejection_reason string, reviewed_by string, approval_date date",
    "patient_feedback": "feedback_id string, patient_id string, hospital_id string, doctor_id string, rating int",
    "bed": "bed_id string, hospital_id string, department_id string, bed_type string, availability_status string",
    "icu_status": "icu_status_id string, hospital_id string, occupied_beds int, available_beds int, update_time timestamp_ntz",
    "referral": "referral_id string, from_hospital_id string, to_hospital_id string, referral_status string, referral_date date",
    "doctor_schedule": "schedule_id string, doctor_id string, shift_date date",
    "drug": "drug_id string, drug_name string, generic_name string, manufacturer string, drug_category string, unit_amount double",
    "prescription_items": "prescription_item_id string, prescription_id string, drug_id string, frequency string, quantity int, duration_days int",
    "drug_inventory": "inventory_id string, hospital_id string, drug_id string, quantity_available int, reorder_level int, expiration_date date",
    "drug_transaction": "transaction_id string, drug_id string, transaction_type string, quantity int, transaction_date date",
}


def visit(i, patient="p1", doctor="d1", hospital="h1", department="e1", kind="Inpatient", status="Completed", day=DAY, wait=10, amount=100.0, code="x1"):
    return (f"v{i}", patient, doctor, hospital, department, code, kind, status, "s", day, wait, amount)


@pytest.fixture
def tables(spark):
    rows = {
        "patient": [("p1", "A", "Female", None, 30, "A+", "g", "c"), ("p2", "B", "Male", None, None, "O+", "g", "c")],
        "hospital": [("h1", "One", "Public", "g", "d", 10, 4, "m"), ("h2", "Two", "Public", "g", "d", 0, 0, "m"), ("h3", "Three", "Private", "g", "d", 5, 2, "m")],
        "department": [("e1", "h1", "Emergency"), ("e2", "h1", "Surgery"), ("e3", "h2", "Surgery")],
        "doctor": [("d1", "Dr 1", "h1", "e1", "Surgery", 3, "Full"), ("d2", "Dr 2", "h9", "e9", "Surgery", 3, "Full")],
        "visit": [visit(1), visit(2, kind="Outpatient", wait=21, amount=50.0, code="x2"), visit(3, day=LATER, kind="Follow-up", status="Cancelled"), visit(4, hospital="h2", department="e3", amount=None, wait=None, day=LATER)],
        "visit_procedure": [("q1", "v1", DAY, 7.0), ("q2", "v2", DAY, 3.0), ("q3", "v9", DAY, 99.0)],
        "claim": [("c1", "p1", "v1", "h1", "Approved", DAY, 100.0, 60.0), ("c2", "p1", "v2", "h1", "Rejected", DAY, 10.0, 0.0), ("c3", "p1", "v3", "h1", "Pending Review", LATER, 50.0, None), ("c4", "p1", "v4", "h2", "Approved", DAY, 0.0, 0.0)],
        "claim_items": [("i1", "c1", "pr1", None, 2, 5.0), ("i2", "c1", "pr1", None, 1, 6.0), ("i3", "c1", None, "g1", 1, 7.0)],
        "claim_approval": [("a1", "c1", "Approved", None, "r1", D(2024, 6, 6)), ("a2", "c1", "Approved", None, "r2", D(2024, 6, 10)), ("a3", "c2", "Rejected", "why", "r1", D(2024, 6, 20)), ("a4", "c4", "Approved", None, "r1", None)],
        "patient_feedback": [("f1", "p1", "h1", "d1", 5), ("f2", "p1", "h1", "d1", 2), ("f3", "p1", "h1", "d1", None)],
        "bed": [(f"b{i}", "h1", "e1", "ICU" if i < 2 else "Standard", "Occupied" if i < 8 else "Available") for i in range(10)] + [("b11", None, None, "Standard", "Occupied")],
        "icu_status": [("u1", "h1", 3, 1, dt.datetime(2024, 6, 1)), ("u2", "h1", 1, 3, dt.datetime(2024, 6, 2)), ("u3", "h1", 2, 2, dt.datetime(2024, 6, 2))],
        "referral": [("r1", "h1", "h2", "Completed", DAY), ("r2", "h1", "h2", "Pending", DAY), ("r3", "h2", "h1", "Completed", DAY)],
        "doctor_schedule": [("s1", "d1", DAY), ("s2", "d1", DAY), ("s3", "d2", DAY)],
        "drug": [("g1", "Drug", "gen", "m", "cat", 2.5), ("g2", "None", "gen", "m", "cat", None), ("g3", "Low", "gen", "m", "cat", 1.0)],
        "prescription_items": [("w1", "x1", "g1", "Once Daily", 4, 10), ("w2", "x1", "g1", "Twice Daily", 5, None)],
        "drug_inventory": [("n1", "h1", "g1", 30, 10, D(2024, 7, 31)), ("n2", "h2", "g1", 12, 11, D(2024, 12, 1)), ("n3", "h1", "g3", 1, 5, D(2024, 7, 1))],
        "drug_transaction": [("t1", "g1", "Purchase", 40, DAY), ("t2", "g1", "Dispensing", 14, LATER), ("t3", "g1", "Return", 1, DAY)],
    }
    return {name: spark.createDataFrame(rows[name], SCHEMAS[name]) for name in SCHEMAS}


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_patient(tables):
    got = by(marts.mart_patient(tables, limits=PatientThresholds(busy=3, regular=2)), "patient_id")
    a, b = got["p1"], got["p2"]
    assert (a.total_visits, a.inpatient_visits, a.outpatient_visits, a.followup_visits) == (4, 2, 1, 1)
    assert (a.hospitals_visited, a.unique_diagnoses) == (2, 2)
    assert (a.total_visit_cost, a.avg_cost_per_visit, a.avg_waiting_time_minutes) == (250.0, 83.33, 13.67)
    assert (a.total_claims, a.approved_claims, a.rejected_claims) == (4, 2, 1)
    # Undecided and zero claims do not enter the rate.
    assert (a.total_denied_amount, a.claim_approval_rate_pct) == (50.0, 30.0)
    assert (a.feedback_count, a.avg_satisfaction_rating, a.min_rating, a.max_rating) == (3, 3.5, 2, 5)
    assert (a.age_group, a.utilization_category) == ("Young Adult (18-35)", "High Utilization")
    assert (b.age_group, b.utilization_category, b.total_visits, b.total_visit_cost) == ("Elderly (70+)", "No Visits", 0, 0.0)
    assert (b.first_visit_date, b.min_rating, b.claim_approval_rate_pct) == (None, None, 0.0)
    assert len(marts.mart_patient(tables).columns) == 32
    assert marts.mart_patient(tables, created_at="2024-01-01").columns[-1] == "created_at"
    assert marts.summary_patient(marts.mart_patient(tables)).count() == 2


def test_hospital(tables):
    got = by(marts.mart_hospital(tables, limits=HospitalThresholds(high_volume=2, medium_volume=1)), "hospital_id")
    one, two, three = got["h1"], got["h2"], got["h3"]
    assert (one.beds_in_system, one.current_occupied_beds, one.bed_occupancy_rate_pct) == (10, 8, 80.0)
    assert (one.latest_icu_occupied, one.latest_icu_available, one.icu_occupancy_rate_pct) == (2, 2, 50.0)
    assert (one.total_departments, one.has_emergency_department) == (2, "Yes")
    assert (one.unique_patients_served, one.unique_doctors_count, one.total_revenue, one.revenue_per_visit) == (1, 1, 250.0, 83.33)
    assert (one.positive_feedback_count, one.negative_feedback_count, one.positive_feedback_rate_pct) == (1, 1, 33.33)
    assert (one.referrals_sent, one.referrals_received) == (2, 1)
    assert (one.volume_category, one.occupancy_category, one.satisfaction_category) == ("High Volume", "Moderate Occupancy", "Good")
    # No capacity gives 0, no feeder row gives NULL.
    assert (two.bed_occupancy_rate_pct, two.icu_occupancy_rate_pct, two.occupancy_category) == (0.0, 0.0, "Unknown")
    assert (two.volume_category, two.has_emergency_department, two.revenue_per_visit) == ("Medium Volume", "No", None)
    assert (three.bed_occupancy_rate_pct, three.icu_occupancy_rate_pct) == (None, None)
    assert (three.volume_category, three.satisfaction_category, three.revenue_per_visit) == ("No Activity", "No Rating", 0.0)
    mart = marts.mart_hospital(tables)
    assert len(mart.columns) == 44
    assert [r.hospital_name for r in marts.topk_hospital(mart, 2).collect()] == ["One", "Two"]


def test_doctor(tables):
    got = by(marts.mart_doctor(tables), "doctor_id")
    one, two = got["d1"], got["d2"]
    assert (one.hospital_name, one.department_name, one.total_visits, one.unique_patients_treated) == ("One", "Emergency", 4, 1)
    assert (one.total_shifts, one.days_scheduled, one.workload_category, one.performance_category) == (2, 1, "Low Workload", "Average Performance")
    assert (two.hospital_name, two.department_name, two.workload_category, two.performance_category) == (None, None, "No Visits", "No Rating")
    assert len(marts.mart_doctor(tables).columns) == 34
    assert marts.summary_doctor(marts.mart_doctor(tables)).count() == 2


def test_claims(tables):
    mart = marts.mart_claims(tables)
    assert len(mart.columns) == 33
    got = {(r.claim_id, r.reviewed_by): r for r in mart.collect()}
    first, second = got["c1", "r1"], got["c1", "r2"]
    # One row per review.
    assert (first.approval_turnaround_days, second.approval_turnaround_days) == (3, 7)
    assert (first.processing_speed_category, second.processing_speed_category) == ("Fast Processing", "Normal Processing")
    assert (first.approval_rate_pct, first.denial_rate_pct, first.approval_category) == (60.0, 40.0, "Partially Approved")
    assert (first.total_claim_items, first.procedures_in_claim, first.drugs_in_claim, first.total_items_amount, first.total_items_quantity) == (3, 1, 1, 18.0, 4)
    assert (got["c2", "r1"].approval_category, got["c2", "r1"].processing_speed_category) == ("Rejected", "Slow Processing")
    pending = got["c3", None]
    assert (pending.approval_category, pending.denied_amount, pending.approval_rate_pct, pending.approval_turnaround_days) == ("Unknown", None, None, 0)
    zero = got["c4", "r1"]
    assert (zero.approval_rate_pct, zero.approval_category, zero.processing_speed_category) == (0.0, "Fully Approved", "Unknown")
    summary = {(r.claim_status, r.claim_value_category): r for r in marts.summary_claims(mart).collect()}
    assert summary["Approved", "Low Value"].total_claims == 2
    assert [r.claim_id for r in marts.topk_claims(mart, 2).collect()] == ["c3", "c1"]


def test_drug(tables):
    got = by(marts.mart_drug(tables, "2024-07-01"), "drug_id")
    one, none, low = got["g1"], got["g2"], got["g3"]
    assert (one.total_prescriptions, one.unique_prescriptions, one.total_quantity_prescribed, one.avg_treatment_duration_days) == (2, 1, 9, 10.0)
    assert (one.hospitals_stocking_drug, one.current_stock_quantity, one.low_stock_locations) == (2, 42, 0)
    assert (one.utilization_rate_pct, one.turnover_rate_pct) == (25.0, 35.0)
    assert (one.total_prescription_value, one.current_inventory_value) == (22.5, 105.0)
    assert (one.stock_status, one.expiration_status, one.demand_category) == ("Adequate Stock", "Monitor Expiration", "Low Demand")
    assert (none.unit_price, none.stock_status, none.expiration_status, none.demand_category) == (None, "Unknown", "Unknown", "No Demand")
    assert (low.stock_status, low.expiration_status) == ("Stock Alert", "Expiring Soon")
    assert len(marts.mart_drug(tables, "2024-07-01").columns) == 36


def test_financial_and_its_summary_count_daily_figures_once(tables):
    mart = marts.mart_financial(tables)
    assert len(mart.columns) == 25
    day = {(r.hospital_id, r.visit_type): r for r in mart.filter("transaction_date = DATE '2024-06-03'").collect()}
    inpatient, outpatient = day["h1", "Inpatient"], day["h1", "Outpatient"]
    for row in (inpatient, outpatient):
        assert (row.procedure_count, row.total_procedure_revenue, row.claim_count) == (2, 10.0, 2)
        assert (row.total_claimed_amount, row.total_approved_amount, row.reimbursement_rate_pct) == (110.0, 60.0, 54.55)
    assert (inpatient.total_revenue, inpatient.net_revenue_after_claims) == (110.0, 50.0)
    once = by(marts.summary_financial(mart), "hospital_name")["One"]
    assert (once.total_visits, once.total_claimed, once.total_approved, once.total_revenue) == (3, 160.0, 60.0, 260.0)
    rows = by(marts.summary_financial(mart, repeat_daily_figures=True), "hospital_name")["One"]
    assert (rows.total_visits, rows.total_claimed, rows.total_approved, rows.total_revenue) == (3, 270.0, 120.0, 270.0)


def test_operational(tables):
    mart = marts.mart_operational(tables)
    assert len(mart.columns) == 42
    rows = {(r.hospital_id, r.operation_date, r.visit_type): r for r in mart.collect()}
    one = rows["h1", DAY, "Inpatient"]
    assert (one.total_visits, one.completion_rate_pct, one.visits_per_doctor, one.day_of_week) == (1, 100.0, 1.0, "Monday")
    assert (one.referrals_sent, one.referrals_received, one.completed_referrals_sent, one.pending_referrals_sent) == (2, 1, 1, 1)
    assert (one.doctors_scheduled, one.total_shifts_scheduled) == (1, 2)
    assert (one.bed_occupancy_rate_pct, one.capacity_status, one.wait_time_efficiency) == (80.0, "High", "Efficient")
    late = rows["h1", LATER, "Follow-up"]
    assert (late.completion_rate_pct, late.cancelled_visits, late.referrals_sent) == (0.0, 1, None)
    bare = rows["h2", LATER, "Inpatient"]
    assert (bare.avg_waiting_time_minutes, bare.wait_time_efficiency, bare.capacity_status) == (0.0, "Unknown", "Unknown")
    once = by(marts.summary_operational(mart), "hospital_name")["One"]
    assert (once.total_visits, once.total_referrals_sent, once.total_referrals_received) == (3, 2, 1)
    repeated = by(marts.summary_operational(mart, repeat_daily_figures=True), "hospital_name")["One"]
    assert (repeated.total_referrals_sent, repeated.avg_wait_time) == (4, once.avg_wait_time)
    found = marts.lookup_operational(mart, "h1", "2024-06-03")
    assert listed(found, "visit_type") == [("Inpatient",), ("Outpatient",)]
    assert [r.operation_date for r in marts.topk_operational(mart, 2).collect()] == [LATER, LATER]
    assert marts.daily_occupancy(mart).count() == 4


def test_unique_ids_are_counted_without_expanding_rows(tables):
    plan = marts.mart_operational(tables)._jdf.queryExecution().optimizedPlan().toString()
    # Only patients and doctors are real distinct counts: three copies of a row, not six.
    assert plan.count("Expand") == 1
