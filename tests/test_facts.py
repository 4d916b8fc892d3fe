from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import listed
from wardflow.operators.upsert import upsert
from wardflow.plans import facts, queries
from wardflow.sources.domain import SCHEMAS

D = dt.date
OLD, NEW, AS_OF = D(2024, 1, 1), D(2024, 6, 1), "2024-07-01"
WM = D(2024, 5, 8)


@pytest.fixture
def make(spark):
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture
def dims(make):
    def members(name, ids):
        rows = [(i, n + 1, 1, D(2000, 1, 1), None) for n, i in enumerate(ids)]
        rows += [(i, 100 + n, 0, D(1990, 1, 1), D(1999, 12, 31)) for n, i in enumerate(ids)]
        schema = f"{name}_id string, {name}_key bigint, scd_is_current int, scd_start_date date, scd_end_date date"
        return make(rows, schema)

    status = [(1, "Approved", "Unknown", "r1"), (2, "Approved", "Unknown", "r2"), (3, "Rejected", None, "r1")]
    return {
        **{n: members(n, ids) for n, ids in dict(patient=["p1", "p2"], hospital=["h1"], doctor=["d1"], department=["e1"], drug=["g1", "g2"]).items()},
        "diagnosis": make([("x1", 1)], "diagnosis_code string, diagnosis_key bigint"),
        "claim_status": make(status, "claim_status_key bigint, claim_status string, rejection_reason string, reviewed_by string"),
    }


CLAIM = "claim_id string, visit_id string, patient_id string, hospital_id string, claim_status string, claim_date date, claim_amount double, approved_amount double"
REVIEW = "approval_id string, claim_id string, approval_date date, rejection_reason string, reviewed_by string"
ITEM = "claim_item_id string, claim_id string, procedure_code string, drug_id string, item_amount double"


def claim(i, status, day, amount=100.0, approved=None, patient="p1"):
    return (i, "v" + i, patient, "h1", status, day, amount, approved)


@pytest.fixture
def claims(make):
    def build(rows, reviews=(), items=()):
        return {
            "claim": make(rows, CLAIM),
            "claim_approval": make(list(reviews), REVIEW),
            "claim_items": make(list(items), ITEM),
            "medical_procedure": make([("c1",), ("c2",)], "procedure_code string"),
        }

    return build


def test_pending_claim_decided_later_is_updated_and_reruns_change_nothing(spark, claims, dims):
    before = claims([claim("1", facts.PENDING, OLD), claim("2", "Approved", OLD, approved=80.0), claim("3", facts.PENDING, NEW)])
    first = facts.fact_claims(before, dims, WM, AS_OF)
    # Decided claims before the watermark are not staged, pending ones are.
    assert listed(first, "claim_id") == [("1",), ("3",)]
    target = spark.createDataFrame(first.collect(), first.schema)

    decided = claims(
        [claim("1", "Approved", OLD, approved=60.0), claim("2", "Approved", OLD, approved=80.0), claim("3", facts.PENDING, NEW)],
        [("a1", "1", D(2024, 1, 9), "Unknown", "r1")],
    )
    batch = facts.fact_claims(decided, dims, NEW, "2024-08-01", target)
    assert listed(batch, "claim_id") == [("1",), ("3",)]
    merged = upsert(target, batch, ["claim_id"], **facts.claim_update_rule())
    got = listed(merged, "claim_id", "approved_amount", "approval_gap", "days_to_decision", "claim_status_key", "reviewed_by")
    assert got == [("1", 60.0, 40.0, 8, 1, "r1"), ("3", None, 100.0, None, -1, None)]
    stamps = {r.claim_id: (r.dwh_loaded_at, r.dwh_updated_at) for r in merged.collect()}
    assert stamps["1"][0].month == 7 and stamps["1"][1].month == 8
    assert stamps["3"][0].month == stamps["3"][1].month == 7
    rerun = facts.fact_claims(decided, dims, NEW, "2024-09-01", merged)
    assert listed(upsert(merged, rerun, ["claim_id"], **facts.claim_update_rule())) == listed(merged)


def test_several_reviews_give_one_row_with_the_last_one(claims, dims):
    silver = claims(
        [claim("1", "Approved", NEW, approved=100.0)],
        [("a1", "1", D(2024, 6, 2), "Unknown", "r1"), ("a2", "1", D(2024, 6, 9), "Unknown", "r2"), ("a0", "1", D(2024, 6, 9), "Unknown", "r1")],
    )
    got = facts.fact_claims(silver, dims, WM, AS_OF)
    assert listed(got, "claim_id", "reviewed_by", "days_to_decision", "claim_status_key") == [("1", "r2", 8, 2)]


def test_status_that_the_dimension_lacks_keeps_the_claim(claims, dims):
    silver = claims([claim("1", "Disputed", NEW)], [("a1", "1", None, None, "r1")])
    assert listed(facts.fact_claims(silver, dims, WM, AS_OF), "claim_status_key") == [(-1,)]
    rejected = claims([claim("1", "Rejected", NEW, approved=0.0)], [("a1", "1", None, None, "r1")])
    assert listed(facts.fact_claims(rejected, dims, WM, AS_OF), "claim_status_key") == [(3,)]


def test_dearest_known_procedure_and_current_drug(claims, dims):
    items = [
        ("i1", "1", "c1", None, 10.0),
        ("i2", "1", "c2", None, 10.0),
        ("i3", "1", "gone", None, 99.0),
        ("i4", "1", None, "g1", 5.0),
        ("i5", "1", None, "unknown drug", 50.0),
        ("i6", "1", None, None, 1.0),
    ]
    silver = claims([claim("1", "Approved", NEW), claim("2", "Approved", NEW)], items=items)
    got = facts.fact_claims(silver, dims, WM, AS_OF)
    assert listed(got, "claim_id", "procedure_code", "drug_key", "item_count") == [("1", "c2", 1, 6), ("2", None, None, 0)]


def test_claims_of_unknown_patients_wait_for_them(claims, dims, make):
    silver = claims([claim("1", "Approved", NEW, patient="late"), claim("2", "Approved", NEW)])
    first = facts.fact_claims(silver, dims, WM, AS_OF)
    assert listed(first, "claim_id", "patient_key") == [("1", -1), ("2", 1)]
    member = make([("late", 9, 1, D(2000, 1, 1), None)], dims["patient"].schema)
    later = {**dims, "patient": dims["patient"].union(member)}
    # Past the watermark by now, tried again; nothing changes while the patient is missing.
    same = upsert(first, facts.fact_claims(silver, dims, AS_OF, AS_OF, first), ["claim_id"], **facts.claim_update_rule())
    assert listed(same, "claim_id", "patient_key") == [("1", -1), ("2", 1)]
    batch = facts.fact_claims(silver, later, AS_OF, AS_OF, first)
    merged = upsert(first, batch, ["claim_id"], **facts.claim_update_rule())
    assert listed(merged, "claim_id", "patient_key") == [("1", 9), ("2", 1)]


def test_a_doctor_who_arrives_on_day_two(visits, dims, make):
    visits["visit"] = visits["visit"].withColumn("doctor_id", F.when(F.col("visit_id") == "v4", "d2").otherwise("d1"))
    first = facts.fact_visits(visits, dims, WM, AS_OF)
    assert listed(first, "visit_id", "doctor_key") == [("v2", 1), ("v4", -1)]
    member = make([("d2", 5, 1, D(2000, 1, 1), None)], dims["doctor"].schema)
    later = {**dims, "doctor": dims["doctor"].union(member)}
    batch = facts.fact_visits(visits, later, "2024-06-30", AS_OF, target=first)
    assert listed(upsert(first, batch, ["visit_id"]), "visit_id", "doctor_key") == [("v2", 1), ("v4", 5)]
    assert facts.fact_visits(visits, dims, "2024-06-30", AS_OF, target=first).count() == 0


@pytest.fixture
def visits(make):
    schema = "visit_id string, patient_id string, hospital_id string, doctor_id string, department_id string, diagnosis_code string, visit_type string, visit_status string, visit_date date, waiting_time int, total_amount double"
    rows = [(v, p, "h1", "d1", "e1", "x1", "Inpatient", "Completed", day, 5, 10.0) for v, p, day in
            [("v1", "p1", OLD), ("v2", "p1", NEW), ("v3", "p2", D(1995, 1, 1)), ("v4", "p2", D(2024, 6, 2))]]
    return {
        "visit": make(rows, schema),
        "visit_procedure": make([("v2",), ("v2",), ("v9",)], "visit_id string"),
        "patient_feedback": make([("p1", "h1", "d1", 4), ("p1", "h1", "d1", None), ("p1", "h1", "d1", 1)], "patient_id string, hospital_id string, doctor_id string, rating int"),
        "referral": make([("p1", "h1", "late", D(2024, 2, 1), "r2"), ("p1", "h1", "first", D(2024, 1, 1), "r9")], "patient_id string, from_hospital_id string, referral_reason string, referral_date date, referral_id string"),
        "prescription": make([("v2",), ("v2",)], "visit_id string"),
    }


def test_visits_fact(visits, dims):
    got = facts.fact_visits(visits, dims, WM, AS_OF)
    columns = ["visit_id", "date_key", "patient_key", "doctor_key", "procedure_count", "prescription_flag", "feedback_rating", "referral_reason"]
    shown = [(*r[:6], None if r[6] is None else float(r[6]), r[7]) for r in listed(got, *columns)]
    assert shown == [("v2", 20240601, 1, 1, 2, 1, 2.5, "first"), ("v4", 20240602, 2, 1, 0, 0, None, None)]
    late = facts.fact_visits(visits, dims, WM, AS_OF, lookback_days=365)
    assert listed(late, "visit_id") == [("v1",), ("v2",), ("v4",)]


def test_visits_by_the_version_of_their_day(visits, dims):
    got = facts.fact_visits(visits, dims, D(1900, 1, 1), AS_OF, mode="as_of")
    assert listed(got, "visit_id", "patient_key") == [("v1", 1), ("v2", 1), ("v3", 101), ("v4", 2)]


def test_pharmacy_flags(make, dims):
    kinds = [("t1", "Purchase", 5), ("t2", "Dispensing", 30), ("t3", "Dispensing", 29), ("t4", "Return", 40), ("t5", "Wastage", 1)]
    moves = [(t, "h1", "g1", kind, q, NEW, "s") for t, kind, q in kinds]
    moves += [("t6", "h1", "g2", "Dispensing", 1, NEW, "s"), ("t7", "h1", "gone", "Dispensing", 1, NEW, "s"), ("t8", "h1", "g1", "Dispensing", 1, OLD, "s")]
    silver = {
        "drug_transaction": make(moves, "transaction_id string, hospital_id string, drug_id string, transaction_type string, quantity int, transaction_date date, performed_by string"),
        "drug": make([("g1", 2.5), ("g2", 1.0)], "drug_id string, unit_amount double"),
        # Two stock rows of one drug: 30 in all, first expiry 60 days away.
        "drug_inventory": make([("h1", "g1", 10, D(2024, 7, 31)), ("h1", "g1", 20, D(2025, 1, 1))], "hospital_id string, drug_id string, quantity_available int, expiration_date date"),
        "prescription_items": make([("x1", "g1"), ("x1", "g1")], "prescription_id string, drug_id string"),
        "prescription": make([("x1", "v1")], "prescription_id string, visit_id string"),
        "visit": make([("v1", "h1", NEW)], "visit_id string, hospital_id string, visit_date date"),
    }
    got = facts.fact_pharmacy(silver, dims, WM, AS_OF)
    columns = ["transaction_id", "total_value", "stockout_flag", "near_expiry_flag", "no_prescription_flag"]
    assert listed(got, *columns) == [
        ("t1", 12.5, 0, 1, 0),
        ("t2", 75.0, 1, 1, 0),
        ("t3", 72.5, 0, 1, 0),
        ("t4", 100.0, 1, 1, 0),
        ("t5", 2.5, 0, 1, 0),
        ("t6", 1.0, 0, 0, 1),
        # Its drug is not known yet.
        ("t7", None, 0, 0, 1),
    ]


def test_two_loads_clean_their_tables_once(spark, monkeypatch):
    """Both loads read the same cleaned rows: details are written once, other rows wait for no shuffle."""
    made = {
        "claim_item": [("CI1", "C1", None, " D1", 2, 5.0), ("CI1", "C1", "PR1", None, 1, 5.0), (None, "C2", None, "D2", None, None)],
        "prescription": [("RX1", "V1", dt.date(1998, 1, 2)), ("RX1", "V2", None), ("RX2", None, dt.date(1998, 1, 3))],
    }
    monkeypatch.setattr(queries.Data, "raw", lambda self, name: spark.createDataFrame(made[name], SCHEMAS[name]))
    once, plain = queries.LoadData(spark, "", twice=True), queries.Data(spark, "")
    for name in ("claim_items", "prescription"):
        assert once[name] is once[name]
        assert listed(once[name]) == listed(plain[name])
    assert once["claim_items"].inputFiles()
