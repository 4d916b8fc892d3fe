from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import listed
from wardflow.operators import joins as j
from wardflow.operators import profile, quality
from wardflow.operators.cleaning import remove_duplicates
from wardflow.operators.ordering import stage


@pytest.fixture
def skewed(spark):
    """A third of the rows share one key, another third has none."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, None).otherwise(F.col("id").cast("string"))
    return spark.range(3000).select("id", key.alias("k"), (F.col("id") % 2).alias("m"))


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("keys", [["k"], ["k", "m"]])
def test_feeder_join_gives_the_rows_of_a_plain_join(spark, skewed, how, keys):
    feeder = skewed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    plain = skewed.join(feeder, keys, how).select("id", "n")
    assert listed(j.join_feeder(skewed, feeder, keys, how), "id", "n") == listed(plain)


@pytest.mark.parametrize("hot", [1, 3000])
def test_hot_keys_of_an_aggregated_feeder_are_split(spark, lake, small_partitions, hot):
    """One hot key, or thousands that meet in a few tasks: the same plan, split by measured sizes."""
    key = F.when(F.col("id") < 60000, F.col("id") % hot).otherwise(F.col("id"))
    rows = lake.overwrite("f", spark.range(90000).repartition(8).select("id", key.alias("k"), F.lit("x" * 50).alias("pad")))
    joined = j.join_feeder(rows, rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")), ["k"])
    assert sum(r.n for r in joined.select("n").collect()) == 30000 + 60000 * 60000 // hot


def test_existence_flag_never_multiplies_rows(spark):
    left = spark.createDataFrame([("a", 1), ("b", 1), (None, 1), ("a", 2)], "k string, d int")
    right = spark.createDataFrame([("a", 1), ("a", 1), (None, 1)], "x string, y int")
    got = j.flag_existing(left, right, {"k": "x", "d": "y"}, "hit")
    assert listed(got) == sorted([("a", 1, 1), ("a", 2, 0), ("b", 1, 0), (None, 1, 0)], key=str)


def test_shared_values(spark):
    df = spark.createDataFrame([("p1", 1), ("p2", 1), ("p3", 2), ("p4", None), ("p5", None)], "id string, phone int")
    assert listed(j.rows_with_shared_value(df, "phone")) == [("p1", 1, 2), ("p2", 1, 2)]


def test_version_valid_on_the_day(spark):
    versions = spark.createDataFrame(
        [
            ("a", 1, dt.date(2024, 1, 1), dt.date(2024, 1, 31), 0),
            ("a", 2, dt.date(2024, 2, 1), None, 1),
        ],
        "id string, key int, scd_start_date date, scd_end_date date, scd_is_current int",
    )
    days = [dt.date(2023, 12, 31), dt.date(2024, 1, 1), dt.date(2024, 1, 31), dt.date(2024, 2, 1), dt.date(2030, 1, 1)]
    facts = spark.createDataFrame([("a", d) for d in days] + [("b", days[0])], "id string, day date")
    left = j.members_as_of(facts, versions, "id", "day", ["key"], "left")
    assert [r.key for r in left.filter("id = 'a'").orderBy("day").collect()] == [None, 1, 1, 2, 2]
    assert left.count() == 6
    assert j.members_as_of(facts, versions, "id", "day", ["key"]).count() == 4
    assert listed(j.current_members(versions, "id", "key")) == [("a", 2)]


# Quality and profiles


def test_row_rules_share_one_pass(spark):
    df = spark.createDataFrame(
        [("1", " x", "a@b.c", "+20-100-123-4567", 1, 2), ("2", "x", "bad", "123", 3, 2), ("3", None, None, None, None, 2)],
        "id string, s string, mail string, phone string, lo int, hi int",
    )
    rules = [
        quality.untrimmed("s"),
        quality.email_shape("mail"),
        quality.phone_shape("phone"),
        quality.is_missing("lo"),
        quality.in_domain("s", ["x"]),
        quality.ordered("lo", "hi"),
    ]
    found = quality.run_checks(df, "t", rules, "id")
    assert [tuple(r) for r in found.collect()] == [
        ("untrimmed", "t", "s", 1, "1"),
        ("email_shape", "t", "mail", 2, "2"),
        ("phone_shape", "t", "phone", 2, "2"),
        ("missing", "t", "lo", 1, "3"),
        ("domain", "t", "s", 1, "1"),
        ("order", "t", "lo,hi", 1, "2"),
    ]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    assert listed(quality.failing_rows(df, quality.email_shape("mail")), "id") == [("2",), ("3",)]


def test_key_and_reference_checks(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "k string")
    assert listed(quality.primary_key_violations(df, "k")) == sorted([("a", 2), (None, 1)], key=str)
    parent = spark.createDataFrame([("a",)], "pk string")
    assert listed(quality.orphan_keys(df, "k", parent, "pk")) == [("b",)]
    assert listed(quality.domain_listing(df, ["k"])) == sorted([("k", "a", 2), ("k", "b", 1), ("k", None, 1)], key=str)


def test_invalid_patients_name_their_rules(spark):
    ok = ("p", "123", dt.date(2000, 1, 1), "Male", "A+", 1001234567, 1101234567)
    future = (None, None, dt.date(2050, 1, 1), "x", "y", 5, 5)
    letters = ("q", "12a", None, None, None, None, None)
    df = spark.createDataFrame(
        [ok, future, letters],
        "patient_id string, national_id string, birth_date date, gender string, blood_type string, phone bigint, emergency_contact bigint",
    )
    bad = quality.invalid_rows(df, quality.patient_rules("2024-01-01"))
    assert listed(bad, "failed_rules") == [
        ("national_id_not_numeric",),
        (
            "patient_id_missing,national_id_missing,birth_date_in_future,negative_age,gender_unknown,"
            "blood_type_unknown,phone_is_emergency_contact,phone_length",
        ),
    ]


def test_profiles(spark):
    df = spark.createDataFrame([("b", 10), ("a", 9), ("a", None), (None, 9), ("b", 100)], "s string, n int")
    assert listed(profile.null_counts(df)) == [("n", 1), ("s", 1)]
    assert listed(profile.column_profile(df)) == [("n", 4, "9", 2, "9", "100"), ("s", 3, "a", 2, "a", "b")]
    assert listed(profile.value_counts(df, ["s", "n"])) == [("n", "9", 2), ("s", "a", 2), ("s", "b", 2)]
    assert [r["summary"] for r in profile.describe(df).collect()] == ["count", "mean", "stddev", "min", "max"]


def test_phone_findings(spark):
    rows = [("1", 1001234567, 1001234567), ("2", 900, 1), ("3", 1301234567, None), ("4", 900, None), ("5", None, None)]
    df = spark.createDataFrame(rows, "id string, phone bigint, emergency_contact bigint")
    got = profile.phone_findings(df).select(
        "id", "phone_length", "equals_emergency_contact", "wrong_length", "wrong_prefix", "shared_phone"
    )
    assert listed(got) == [
        ("1", 10, 1, 0, 0, 0),
        ("2", 3, 0, 1, 1, 1),
        ("3", 10, 0, 0, 1, 0),
        ("4", 3, 0, 1, 1, 1),
        ("5", None, 0, 0, 0, 0),
    ]


@pytest.fixture
def small_partitions(spark):
    low = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in low}
    for k, v in low.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_adaptive_execution_splits_a_hot_key(spark, lake, small_partitions):
    """The session settings cover joins whose two sides are plain shuffles; a staged feeder is one."""
    key = F.when(F.col("id") < 60000, 7).otherwise(F.col("id") % 1000)
    facts = lake.overwrite("f", spark.range(90000).repartition(8).select("id", key.alias("k"), F.lit("x" * 50).alias("pad")))
    dim = lake.overwrite("d", spark.range(1000).select(F.col("id").alias("k"), F.col("id").alias("member_key")))
    for joined in (facts.join(dim, "k", "left"), j.join_feeder(facts, facts.groupBy("k").count(), ["k"])):
        assert len(joined.collect()) == 90000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


# As-of joins


def brute_versions(facts_rows, versions):
    """Every fact compared with every version; of several valid ones the one that starts last."""
    out = []
    for fact, key, day in facts_rows:
        fits = [(s, e is None, e or day, v) for k, v, s, e in versions if key is not None and day is not None and k == key and s <= day and (e is None or day <= e)]
        out.append((fact, key, day, max(fits)[3] if fits else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("period", ["year", "month", "quarter"])
def test_as_of_join_equals_comparing_every_version(spark, period):
    rng, start = random.Random(3), dt.date(2019, 1, 1)
    versions = [("edge", 1, dt.date(2020, 1, 1), dt.date(2019, 12, 31)), ("edge", 2, dt.date(2020, 1, 1), None), ("gap", 3, start, dt.date(2019, 6, 1)), ("gap", 4, dt.date(2021, 6, 1), None), (None, 5, start, None)]
    for k in range(12):
        day, number = start + dt.timedelta(days=rng.randint(0, 90)), 10 * k + 100
        for _ in range(rng.randint(0, 8)):
            to = day + dt.timedelta(days=rng.choice([0, 1, 3, 200, 900]))
            versions.append((f"k{k}", number, day, to))
            day, number = to + dt.timedelta(days=rng.choice([1, 1, 1, 40])), number + 1
        versions.append((f"k{k}", number, day, None))
    keys = [*{v[0] for v in versions if v[0]}, "unknown", None]
    facts = [(i, rng.choice(keys), None if rng.random() < 0.05 else start + dt.timedelta(days=rng.randint(-60, 1600))) for i in range(3000)]
    dim = spark.createDataFrame(versions, "k string, v int, scd_start_date date, scd_end_date date")
    rows = spark.createDataFrame(facts, "id int, k string, day date")
    left = j.members_as_of(rows, dim, "k", "day", ["v"], "left", period)
    assert left.columns == ["id", "k", "day", "v"]
    want = brute_versions(facts, versions)
    assert listed(left) == want
    assert listed(j.members_as_of(rows, dim, "k", "day", ["v"], period=period)) == [r for r in want if r[3] is not None]


def test_as_of_join_of_a_key_with_very_many_versions(spark):
    """A hundred thousand versions and facts of one key, and a day that a third of all facts share."""
    n = 100_000
    days = spark.range(n).select(F.lit("hot").alias("k"), F.col("id").alias("v"), F.expr("date_add(DATE '1800-01-01', cast(id AS int))").alias("scd_start_date"))
    dim = days.withColumn("scd_end_date", F.when(F.col("v") < n - 1, F.col("scd_start_date")))
    facts = spark.range(n).select("id", F.lit("hot").alias("k"), F.expr("CASE WHEN id % 3 = 0 THEN DATE '1900-01-01' ELSE date_add(DATE '1800-01-01', cast(id AS int)) END").alias("day"))
    got = j.members_as_of(facts, dim, "k", "day", ["v"])
    wrong = got.filter("v <> CASE WHEN id % 3 = 0 THEN datediff(DATE '1900-01-01', DATE '1800-01-01') ELSE id END")
    assert got.count() == n and wrong.count() == 0
    # Every fact day meets one version: no join condition but equality is left in the plan.
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "scd_end_date" not in plan


@pytest.mark.parametrize("most", [j.MAX_REPEATED, 1])
def test_few_duplicates_leave_the_same_rows(spark, monkeypatch, most):
    """NULL keys form one group; more repeated keys than may be broadcast are grouped by a shuffle."""
    monkeypatch.setattr(j, "MAX_REPEATED", most)
    rows = [("a", 2, None), ("a", 1, "y"), ("a", 1, "x"), ("b", 1, "z"), (None, 5, "n"), (None, 4, None), ("c", None, None)]
    df = spark.createDataFrame(rows, "k string, n int, t string")
    assert listed(j.remove_few_duplicates(df, ["k"])) == listed(remove_duplicates(df, ["k"]))
    two = df.withColumn("m", F.col("n") % 2)
    assert listed(j.remove_few_duplicates(two, ["k", "m"])) == listed(remove_duplicates(two, ["k", "m"]))


def test_rows_with_keys_of_their_own_are_not_shuffled(spark):
    df = stage(spark.range(1000).selectExpr("concat('k', id) AS k", "repeat('x', 100) AS t"))
    assert "Exchange" not in j.remove_few_duplicates(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    more = stage(df.unionByName(df.filter("k = 'k7'").withColumn("t", F.lit("a"))))
    found = j.remove_few_duplicates(more, ["k"])
    assert found.count() == 1000 and [r["t"] for r in found.filter("k = 'k7'").collect()] == ["a"]
