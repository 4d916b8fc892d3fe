from __future__ import annotations

import datetime as dt

import pytest

from tests.conftest import listed
from wardflow.operators import ledger
from wardflow.plans import facts, warehouse

D = dt.date
DAY1, DAY2, DAY3 = "2024-07-01", "2024-07-02", "2024-07-03"


def member_rows(spark, name, ids, created=DAY1):
    schema = f"{name}_id string, {name}_key bigint, scd_is_current int, dwh_created_at timestamp"
    moment = dt.datetime.fromisoformat(created)
    return spark.createDataFrame([(i, n, 1, moment) for i, n in ids.items()], schema)


@pytest.fixture
def moves(spark):
    rows = [("t1", "h1", "g1", D(2024, 4, 1)), ("t2", "h1", "late", D(2024, 5, 1)), ("t3", "late", "later", D(2024, 6, 1)), ("t4", None, "g1", D(2024, 6, 2)), ("t5", "h1", "never", D(2024, 6, 3))]
    schema = "transaction_id string, hospital_id string, drug_id string, transaction_type string, quantity int, transaction_date date, performed_by string"
    return {
        "drug_transaction": spark.createDataFrame([(t, h, g, "Return", 1, day, "s") for t, h, g, day in rows], schema),
        "drug": spark.createDataFrame([("g1", 2.5)], "drug_id string, unit_amount double"),
        "drug_inventory": spark.createDataFrame([], "hospital_id string, drug_id string, quantity_available int, expiration_date date"),
        "prescription_items": spark.createDataFrame([], "prescription_id string, drug_id string"),
        "prescription": spark.createDataFrame([], "prescription_id string, visit_id string"),
        "visit": spark.createDataFrame([], "visit_id string, hospital_id string, visit_date date"),
    }


def waits(lake, name="fact_pharmacy"):
    return listed(lake.table(warehouse.ledger_table(name)), "row_id", "wanted", "wanted_id")


def keys(lake):
    return {r.transaction_id: (r.drug_key, r.hospital_key) for r in lake.table("fact_pharmacy").collect()}


def month_files(lake, month):
    return sorted(f for f in lake.table("fact_pharmacy").inputFiles() if f"month_key={month}" in f)


def test_members_that_arrive_are_filled_in_month_by_month(spark, lake, moves):
    dims = {"drug": member_rows(spark, "drug", {"g1": 1}), "hospital": member_rows(spark, "hospital", {"h1": 1})}
    warehouse.load_fact(lake, "fact_pharmacy", moves, dims, "2024-01-01", DAY1)
    assert keys(lake) == {"t1": (1, 1), "t2": (-1, 1), "t3": (-1, -1), "t4": (1, -1), "t5": (-1, 1)}
    # A NULL id can not arrive.
    first = [("t2", "drug_key", "late"), ("t3", "drug_key", "later"), ("t3", "hospital_key", "late"), ("t5", "drug_key", "never")]
    assert waits(lake) == first

    # Nothing new: no row is touched, whatever waits.
    before = lake.table("fact_pharmacy").inputFiles()
    batch = warehouse.load_fact(lake, "fact_pharmacy", moves, dims, "2024-06-30", DAY2)
    assert batch.count() == 0 and lake.table("fact_pharmacy").inputFiles() == before and waits(lake) == first

    # A drug and a hospital come: a row with one of two members is merged too, and waits for the other.
    april, may = month_files(lake, 202404), month_files(lake, 202405)
    dims["hospital"] = dims["hospital"].union(member_rows(spark, "hospital", {"late": 2}, DAY3))
    batch = warehouse.load_fact(lake, "fact_pharmacy", moves, dims, "2024-06-30", DAY3)
    assert listed(batch, "transaction_id") == [("t3",)] and keys(lake)["t3"] == (-1, 2)
    assert (month_files(lake, 202404), month_files(lake, 202405)) == (april, may)
    assert waits(lake) == [("t2", "drug_key", "late"), ("t3", "drug_key", "later"), ("t5", "drug_key", "never")]

    dims["drug"] = dims["drug"].union(member_rows(spark, "drug", {"late": 2, "later": 3}, "2024-07-05"))
    june = month_files(lake, 202406)
    for _ in range(2):  # a load that is repeated changes nothing
        warehouse.load_fact(lake, "fact_pharmacy", moves, dims, "2024-06-30", "2024-07-05")
    assert keys(lake) == {"t1": (1, 1), "t2": (2, 1), "t3": (3, 2), "t4": (1, -1), "t5": (-1, 1)}
    assert month_files(lake, 202404) == april and month_files(lake, 202406) != june
    assert waits(lake) == [("t5", "drug_key", "never")]
    # What never comes is given up, if asked for.
    warehouse.load_fact(lake, "fact_pharmacy", moves, dims, "2024-06-30", "2024-08-05", forget_after_days=30)
    assert waits(lake) == []


def test_older_members_are_not_looked_at_again(spark):
    dimension = member_rows(spark, "drug", {"a": 1}).union(member_rows(spark, "drug", {"b": 2}, DAY3))
    since = dt.datetime(2024, 7, 2)
    assert listed(ledger.new_members(dimension, "drug_id", since)) == [("b",)]
    assert listed(ledger.new_members(dimension.drop("dwh_created_at"), "drug_id", since)) == [("a",), ("b",)]
    assert listed(ledger.new_members(dimension, "drug_id", None)) == [("a",), ("b",)]


def test_arrival_prunes_the_source_by_date(spark, lake):
    book = spark.createDataFrame([("1", D(2024, 2, 1), "p", "w", "x", None), ("2", D(2024, 3, 1), "p", "w", "y", None)], ledger.SCHEMA)
    again = ledger.arrived(book, {"w": spark.createDataFrame([("y",)], "wanted_id string")})
    source = lake.overwrite("s", spark.createDataFrame([(1, D(2024, 2, 1)), (2, D(2024, 3, 1)), (2, D(2020, 3, 1))], "id int, day date"))
    found = again.of(source, "id", "day")
    assert listed(found) == [(2, D(2024, 3, 1))]
    assert "GreaterThanOrEqual(day,2024-03-01)" in found._jdf.queryExecution().executedPlan().toString()
    assert ledger.arrived(book, {"w": spark.createDataFrame([("z",)], "wanted_id string")}) is None


def test_claims_wait_for_their_decision(spark, lake):
    claim = "claim_id string, visit_id string, patient_id string, hospital_id string, claim_status string, claim_date date, claim_amount double, approved_amount double"
    review = "approval_id string, claim_id string, approval_date date, rejection_reason string, reviewed_by string"
    status = "claim_status_key bigint, claim_status string, rejection_reason string, reviewed_by string"
    dims = {
        "patient": member_rows(spark, "patient", {"p1": 1}),
        "hospital": member_rows(spark, "hospital", {"h1": 1}),
        "drug": member_rows(spark, "drug", {}),
        "claim_status": spark.createDataFrame([(1, "Approved", "Unknown", "r1")], status),
    }

    def silver(amount, reviews):
        # Claim 1 is never called pending: only the ledger knows that it waits.
        rows = [("1", "v", "p1", "h1", "In review", D(2024, 3, 1), 100.0, amount), ("2", "v", "p1", "h1", "Approved", D(2024, 4, 1), 100.0, 90.0)]
        return {
            "claim": spark.createDataFrame(rows, claim),
            "claim_approval": spark.createDataFrame(reviews, review),
            "claim_items": spark.createDataFrame([], "claim_item_id string, claim_id string, procedure_code string, drug_id string, item_amount double"),
            "medical_procedure": spark.createDataFrame([], "procedure_code string"),
        }

    warehouse.load_fact(lake, "fact_claims", silver(None, []), dims, "2024-01-01", DAY1)
    assert waits(lake, "fact_claims") == [("1", facts.DECISION, "1")]
    assert warehouse.load_fact(lake, "fact_claims", silver(None, []), dims, "2024-06-30", DAY2).count() == 0
    reviewed = silver(None, [("a", "1", D(2024, 3, 5), "Unknown", "r1")])
    warehouse.load_fact(lake, "fact_claims", reviewed, dims, "2024-06-30", DAY3)
    got = listed(lake.table("fact_claims"), "claim_id", "days_to_decision", "approved_amount")
    assert got == [("1", 4, None), ("2", None, 90.0)] and waits(lake, "fact_claims") == []
