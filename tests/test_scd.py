from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import listed
from wardflow.operators import scd
from wardflow.plans import dimensions

COLUMNS = "id string, name string, price decimal(8,2), note string"
TRACKED = ["name", "price"]
D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1)


@pytest.fixture
def load(spark):
    schema = scd.dimension_schema("key", COLUMNS)
    empty = spark.createDataFrame([], schema)

    def apply(rows, day, target=None, **options):
        source = spark.createDataFrame(rows, "id string, name string, price double, note string")
        after = scd.scd2_apply(target if target is not None else empty, source, "key", "id", TRACKED, day, **options)
        return spark.createDataFrame(after.collect(), schema)

    return apply


def state(df):
    columns = ["id", "name", "price", "key", "scd_version", "scd_start_date", "scd_end_date", "scd_is_current"]
    return sorted(((r.id, r.scd_version), r.name, r.key, r.scd_start_date, r.scd_end_date, r.scd_is_current) for r in df.select(*columns).collect())


FIRST = [("a", "A", 1.0, "x"), ("b", None, 2.0, "x"), ("c", "C", 3.005, "x")]


def test_first_load_numbers_all_keys(load):
    assert state(load(FIRST, D1)) == [
        (("a", 1), "A", 1, D1, None, 1),
        (("b", 1), None, 2, D1, None, 1),
        (("c", 1), "C", 3, D1, None, 1),
    ]


def test_same_source_again_changes_nothing(load):
    first = load(FIRST, D1)
    again = load(FIRST, D2, first)
    # 3.005 is stored as 3.01; comparing the stored form gives no false change.
    assert listed(again) == listed(first)


def test_changes_new_keys_null_changes_and_missing_keys(load):
    first = load(FIRST, D1)
    second = load([("a", "A2", 1.0, "x"), ("b", "B", 2.0, "x"), ("d", "D", 4.0, "x")], D2, first)
    end = D2 - dt.timedelta(days=1)
    assert state(second) == [
        (("a", 1), "A", 1, D1, end, 0),
        (("a", 2), "A2", 4, D2, None, 1),
        (("b", 1), None, 2, D1, end, 0),
        (("b", 2), "B", 5, D2, None, 1),
        (("c", 1), "C", 3, D1, None, 1),
        (("d", 1), "D", 6, D2, None, 1),
    ]


def test_value_to_null_is_a_change_and_untracked_columns_are_not(load):
    first = load(FIRST, D1)
    second = load([("a", None, 1.0, "x"), ("b", None, 2.0, "other"), ("c", "C", 3.005, "x")], D2, first)
    assert [s for s in state(second) if s[0][0] == "a"] == [
        (("a", 1), "A", 1, D1, D2 - dt.timedelta(days=1), 0),
        (("a", 2), None, 4, D2, None, 1),
    ]
    assert [s[0] for s in state(second) if s[0][0] == "b"] == [("b", 1)]
    assert {r.note for r in second.filter("id = 'b'").collect()} == {"x"}


def test_second_change_on_the_same_day_corrects_in_place(load):
    first = load(FIRST, D1)
    second = load([("a", "A2", 1.0, "x")], D2, first)
    third = load([("a", "A3", 1.0, "x")], D2, second)
    assert [s for s in state(third) if s[0][0] == "a"] == [
        (("a", 1), "A", 1, D1, D2 - dt.timedelta(days=1), 0),
        (("a", 2), "A3", 4, D2, None, 1),
    ]
    versions = load([("a", "A3", 1.0, "x")], D2, second, same_day="version")
    assert [s[0] for s in state(versions) if s[0][0] == "a"] == [("a", 1), ("a", 2), ("a", 3)]


def test_a_null_key_is_one_member(load):
    first = load([(None, "A", 1.0, "x")], D1)
    assert listed(load([(None, "A", 1.0, "x")], D2, first)) == listed(first)
    assert load([(None, "B", 1.0, "x")], D2, first).filter("scd_is_current = 1").count() == 1


def test_first_load_shortcut_equals_apply(spark, load):
    rows = spark.createDataFrame(FIRST, "id string, name string, price double, note string")
    short = scd.scd2_first_load(rows, scd.dimension_schema("key", COLUMNS), "key", "id", D1)
    assert listed(short) == listed(load(FIRST, D1))


def test_invariants_hold_over_random_loads(load):
    rng = random.Random(3)
    target, days = None, [dt.date(2024, 1, 1) + dt.timedelta(days=d) for d in (0, 3, 3, 9)]
    for day in days:
        ids = rng.sample("abcdefghij", 7)
        target = load([(i, rng.choice("XYZ"), float(rng.randint(1, 3)), "n") for i in ids], day, target)
    rows = target.collect()
    assert len({r.key for r in rows}) == len(rows)
    for key in {r.id for r in rows}:
        versions = sorted((r for r in rows if r.id == key), key=lambda r: r.scd_version)
        assert [v.scd_version for v in versions] == list(range(1, len(versions) + 1))
        assert [v.scd_is_current for v in versions] == [0] * (len(versions) - 1) + [1]
        for left, right in zip(versions, versions[1:]):
            assert left.scd_start_date <= left.scd_end_date < right.scd_start_date
        assert versions[-1].scd_end_date is None


def test_changed_parent_gives_its_children_new_versions(spark):
    hospitals = "hospital_id string, hospital_name string, hospital_type string, governorate string, district string, "
    hospitals += "hospital_phone string, total_beds int, icu_capacity int, latitude double, longitude double, "
    hospitals += "manager_name string, manager_email string, manager_phone string"

    def hospital(beds):
        return spark.createDataFrame([("H1", "n", "t", "g", "d", "p", beds, 1, 1.0, 1.0, "m", "e", "p")], hospitals)

    departments = spark.createDataFrame(
        [("DP1", "H1", "Emergency", 2)], "department_id string, hospital_id string, department_name string, floor_number int"
    )
    old, new = {}, {}
    for beds, dims, day, before in ((10, old, D1, {}), (11, new, D2, old)):
        silver = {"hospital": hospital(beds), "department": departments}
        for name in ("hospital", "department"):
            dims[name] = dimensions.load_dimension(name, silver, dims, day, target=before.get(name))
    assert listed(new["department"], "department_key", "hospital_key", "scd_version") == [(1, 1, 1), (2, 2, 2)]


def test_scd1_key_follows_the_natural_order(spark):
    reviews = spark.createDataFrame(
        [("Rejected", "x", "r1"), ("Approved", None, "r2"), ("Approved", "", "r1"), ("Approved", None, "r2")],
        "approval_status string, rejection_reason string, reviewed_by string",
    )
    got = dimensions.dim_claim_status(reviews, D1)
    assert listed(got, "claim_status_key", "claim_status", "rejection_reason", "reviewed_by") == [
        (1, "Approved", None, "r2"),
        (2, "Approved", "", "r1"),
        (3, "Rejected", "x", "r1"),
    ]


def test_date_dimension(spark):
    days = dimensions.dim_date(spark, as_of="2024-01-01")
    assert days.count() == 1096
    (row,) = days.filter("full_date = DATE '2024-12-29'").collect()
    assert (row.date_key, row.week, row.day_of_week, row.is_weekend, row.season) == (20241229, 52, 7, 1, "Winter")
    assert {r.day_name for r in days.filter(F.col("is_weekend") == 1).collect()} == {"Saturday", "Sunday"}
