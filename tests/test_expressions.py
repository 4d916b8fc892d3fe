from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import listed
from wardflow.functions import expressions as e
from wardflow.plans.marts.patient import AGE_GROUPS, OLDEST


def one(spark, value, kind, column):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column).first()[0]


@pytest.mark.parametrize("value, want", [(2.675, 2.68), (1.005, 1.01), (-1.005, -1.01), (2.0300000000000002 / 2, 1.02), (None, None)])
def test_rounding_is_half_up_on_what_is_shown(spark, value, want):
    assert one(spark, value, "double", e.round2("v")) == want


def test_zero_denominators(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (None, 2.0), (1.0, 4.0)], "n double, d double")
    got = df.select(
        e.safe_divide("n", "d"), e.percent_when_positive("n", "d"), e.rounded_or_zero(e.safe_divide("n", "d"))
    )
    assert [tuple(r) for r in got.collect()] == [
        (None, 0.0, 0.0),
        (None, 0.0, 0.0),
        (None, None, 0.0),
        (0.25, 25.0, 0.25),
    ]


@pytest.mark.parametrize(
    "age, want",
    [
        (None, OLDEST),
        (-1, "Child (0-17)"),
        (17, "Child (0-17)"),
        (18, "Young Adult (18-35)"),
        (35, "Young Adult (18-35)"),
        (36, "Middle Age (36-55)"),
        (55, "Middle Age (36-55)"),
        (56, "Senior (56-70)"),
        (70, "Senior (56-70)"),
        (71, OLDEST),
    ],
)
def test_age_groups(spark, age, want):
    assert one(spark, age, "int", e.band("v", AGE_GROUPS, OLDEST)) == want


@pytest.mark.parametrize("value, want", [(11, "H"), (10, "M"), (5, "M"), (4, "L"), (None, "none")])
def test_three_bands_include_both_ends(spark, value, want):
    assert one(spark, value, "int", e.high_medium_low("v", 10, 5, ("H", "M", "L"), "none")) == want


def test_date_key_and_flag(spark):
    df = spark.sql("SELECT DATE '2024-02-09' AS d, CAST(NULL AS BOOLEAN) AS b")
    assert listed(df.select(e.date_key("d"), e.flag(df.b))) == [(20240209, 0)]


def test_latest_and_earliest(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z")], "k string, t int, v string")
    got = df.groupBy("k").agg(e.latest("v", "t", "v").alias("l"), e.earliest("v", "t", "v").alias("f"))
    assert listed(got) == [("a", "z", "x")]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(min_value=-(10**6), max_value=10**6), min_size=1, max_size=30))
def test_rounded_sum_does_not_depend_on_order(spark, cents):
    values = [x / 100 for x in cents]
    forward = spark.createDataFrame([(x,) for x in values], "v double").agg(e.round2(sum_()))
    backward = spark.createDataFrame([(x,) for x in reversed(values)], "v double").agg(e.round2(sum_()))
    assert forward.first()[0] == backward.first()[0] == round(sum(cents) / 100, 2)


def sum_():
    from pyspark.sql import functions as F

    return F.sum("v")
