from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import listed
from wardflow.functions import expressions as e
from wardflow.operators import cleaning as c
from wardflow.plans.silver import RECIPES, clean_table


def test_duplicates_keep_one_repeatable_row_and_null_is_one_key(spark):
    rows = [("a", 2, "x"), ("a", 1, "y"), (None, 5, "p"), (None, 4, "q"), ("b", None, "z"), ("b", 0, "w")]
    df = spark.createDataFrame(rows, "k string, n int, v string")
    want = [("a", 1, "y"), ("b", None, "z"), (None, 4, "q")]
    assert listed(c.remove_duplicates(df, ["k"])) == sorted(want, key=str)
    newest = c.remove_duplicates(df.repartition(4), ["k"], [F.desc("n")])
    assert listed(newest, "k", "n") == sorted([("a", 2), ("b", 0), (None, 5)], key=str)


def test_duplicates_limit_rows_per_key_before_the_shuffle(spark):
    df = spark.range(100).select(F.when(F.col("id") < 60, 0).otherwise(F.col("id")).alias("k"), "id")
    plan = c.remove_duplicates(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_whole_row_key_and_odd_column_names(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "`odd name` string")
    assert listed(c.remove_duplicates(df, ["odd name"])) == [("a",), ("b",)]
    assert listed(c.trim_strings(spark.createDataFrame([(" a ",)], "`a.b` string"))) == [("a",)]


def test_trim_strips_spaces_but_not_tabs(spark):
    df = spark.createDataFrame([("  x ",), ("\ty\t",), (None,), ("",)], "s string")
    assert listed(c.trim_strings(df)) == sorted([("x",), ("\ty\t",), (None,), ("",)], key=str)


def test_case_helpers(spark):
    df = spark.createDataFrame([("ICU el-sayed", 1)], "s string, n int")
    assert listed(c.initcap_strings(df)) == [("Icu El-sayed", 1)]
    assert listed(c.lowercase_strings(df)) == [("icu el-sayed", 1)]


def test_fill_strings_leaves_excluded_columns(spark):
    df = spark.createDataFrame([(None, None)], "fk string, s string")
    assert listed(c.fill_strings(df)) == [("Unknown", "Unknown")]
    assert listed(c.fill_strings(df, exclude=["fk"])) == [(None, "Unknown")]


def test_fill_numbers_goes_by_type(spark):
    schema = "a int, b bigint, c double, d float, e decimal(8,2), f smallint, g tinyint, h string, i date"
    df = spark.createDataFrame([(None,) * 9], schema)
    (row,) = c.fill_numbers(df).collect()
    assert [row[x] for x in "abcde"] == [0, 0, 0.0, 0.0, 0]
    assert [row[x] for x in "fghi"] == [None] * 4
    assert c.fill_numbers(df).dtypes == df.dtypes
    nan = spark.createDataFrame([(float("nan"),)], "c double")
    assert listed(c.fill_numbers(nan)) == [(0.0,)]


def test_dates_that_do_not_parse_become_null(spark):
    df = spark.createDataFrame([("2024-02-30",), ("2024-02-29",), ("",), (None,), ("  ",)], "d string")
    good = (dt.date(2024, 2, 29),)
    assert listed(c.to_dates(df, ["d"])) == sorted([good] + [(None,)] * 4, key=str)
    assert listed(c.blank_dates_to_null(df, ["d"])) == sorted([good] + [(None,)] * 4, key=str)


def test_blank_dates_leave_date_columns_alone(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (None,)], "d date")
    assert listed(c.blank_dates_to_null(df, ["d"])) == listed(df)


@pytest.mark.parametrize(
    "given, loose, strict",
    [
        ("01001234567", "+20-100-123-4567", "+20-100-123-4567"),
        ("+201001234567", "+20-100-123-4567", "+20-100-123-4567"),
        ("201001234567", "+20-100-123-4567", "+20-100-123-4567"),
        ("1001234567", "+20-100-123-4567", "+20-100-123-4567"),
        ("(010) 0123-4567", "+20-100-123-4567", "+20-100-123-4567"),
        ("00201001234567", "+20-020-100-1234", None),
        ("Unknown", "+20---", None),
        ("", "+20---", None),
        (None, None, None),
    ],
)
def test_phone_spellings(spark, given, loose, strict):
    df = spark.createDataFrame([(given,)], "p string")
    shown = df.select(e.egypt_phone("p").alias("a"), e.egypt_phone("p", strict=True).alias("b"))
    assert tuple(shown.first()) == (loose, strict)


def test_leading_zero_is_restored_for_every_number_type(spark):
    df = spark.createDataFrame([(1001234567, 1001234567.0, "1001234567")], "a bigint, b double, c string")
    assert listed(c.restore_leading_zero(df, ["a", "b", "c"])) == [("01001234567",) * 3]


def test_overrides_replace_only_where_given(spark):
    df = spark.createDataFrame([("m1", "old"), ("m2", "old"), (None, "old")], "m string, phone string")
    fixes = spark.createDataFrame([("m1", "new")], "m string, phone string")
    assert listed(c.apply_overrides(df, fixes, "m", ["phone"])) == sorted(
        [("m1", "new"), ("m2", "old"), (None, "old")], key=str
    )


def test_names_and_age(spark):
    df = spark.createDataFrame([("A", None, dt.date(2000, 12, 31))], "f string, l string, birth_date date")
    assert listed(c.concat_columns(df, {"n": ["f", "l"]}), "n") == [("A",)]
    assert c.full_name(df, "n", ["f", "l"]).columns == ["birth_date", "n"]
    assert listed(c.add_age(df, "2001-01-01"), "patient_age") == [(1,)]


def test_cast_strict_and_lenient(spark):
    df = spark.createDataFrame([("12",), ("x",)], "s string")
    assert listed(c.cast(df, {"s": "int"}, strict=False)) == sorted([(12,), (None,)], key=str)
    with pytest.raises(Exception):
        c.cast(df, {"s": "int"}).collect()


def test_rename_and_created_at(spark):
    df = c.add_created_at(c.rename(spark.range(1), {"id": "key"}), "2024-01-01 10:00:00")
    assert df.columns == ["key", "_created_at"]
    assert listed(df.select(F.col("_created_at").cast("string"))) == [("2024-01-01 10:00:00",)]


def test_recipes_cover_all_tables():
    assert len(RECIPES) == 22
    assert all(r.steps.startswith("D") for r in RECIPES.values())


def test_claim_recipe_keeps_pending_amounts_and_references(spark):
    schema = "claim_id string, patient_id string, visit_id string, hospital_id string, claim_status string, "
    schema += "claim_date date, claim_amount double, approved_amount double"
    raw = spark.createDataFrame([("c1", None, "v", "h", " Pending Review ", None, None, None)], schema)
    kept = clean_table(raw, "claim", "2024-01-01").first()
    assert (kept.patient_id, kept.claim_status, kept.claim_amount, kept.approved_amount) == (
        None,
        "Pending Review",
        0.0,
        None,
    )
    filled = clean_table(raw, "claim", "2024-01-01", fill_everything=True).first()
    assert (filled.patient_id, filled.approved_amount) == ("Unknown", 0.0)


def test_tables_without_trim_keep_their_spaces(spark):
    schema = "claim_item_id string, claim_id string, procedure_code string, drug_id string, quantity int, item_amount double"
    raw = spark.createDataFrame([("i", "c", None, " d ", None, None)], schema)
    row = clean_table(raw, "claim_items", "2024-01-01").first()
    assert (row.drug_id, row.procedure_code, row.item_quantity, row.item_amount) == (" d ", None, 0, 0.0)


def test_hospital_override_comes_after_formatting(spark):
    schema = "hospital_id string, manager_name string, manager_phone string, phone string"
    raw = spark.createDataFrame([("H1", "m", "01001234567", "bad"), ("H2", "n", None, "01001234567")], schema)
    fix = spark.createDataFrame([("H1", "as given")], "hospital_id string, hospital_phone string")
    got = clean_table(raw, "hospital", "2024-01-01", {"hospital_id": fix})
    assert listed(got, "hospital_id", "hospital_phone", "manager_phone") == [
        ("H1", "as given", "+20-100-123-4567"),
        ("H2", "+20-100-123-4567", "+20---"),
    ]
