from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import listed
from wardflow.plans import rollups

ROLLUP = rollups.Rollup("activity", "fact", ("h",), {"cost": "cost"}, {"patients": "p", "doctors": "d"}, "visits")
SCHEMA = "id int, h bigint, p bigint, d bigint, cost double, month_key int"


def made(seed, n, months):
    rng = random.Random(seed)
    pick = [-1, 1, 2, 32768, 32769, 65537, 10**10, None]
    return [(i, rng.choice([1, 2, None]), rng.choice(pick), rng.randint(1, 40), rng.randint(0, 10**6) / 100, rng.choice(months)) for i in range(n)]


def plain(fact):
    totals = fact.groupBy("h").agg(
        F.count("id").alias("visits"), F.sum(F.col("cost").cast("decimal(38,8)")).cast("double").alias("cost"),
        F.count_distinct("p").alias("patients"), F.count_distinct("d").alias("doctors"),
    )
    return listed(totals, "h", "visits", "cost", "patients", "doctors")


def shown(df):
    return listed(df, "h", "visits", "cost", "patients", "doctors")


@pytest.fixture
def months_read(monkeypatch):
    """Months whose states were computed, for each refresh."""
    seen, real = [], rollups.add_states

    def watched(rows, rollup):
        seen.append([r[0] for r in listed(rows.select("month_key").distinct())])
        return real(rows, rollup)

    monkeypatch.setattr(rollups, "add_states", watched)
    return seen


def test_kept_up_summary_equals_a_full_rebuild(spark, lake, months_read):
    rows = spark.createDataFrame(made(1, 400, [1, 2, 3, None]), SCHEMA)
    lake.replace_partitions("fact", rows, ["month_key"])
    assert shown(rollups.refresh(lake, ROLLUP)) == plain(lake.table("fact"))
    # One month is written anew, with fewer rows and other keys, and one is added.
    lake.replace_partitions("fact", spark.createDataFrame(made(2, 50, [2, 4]), SCHEMA), ["month_key"])
    assert shown(rollups.refresh(lake, ROLLUP)) == plain(lake.table("fact"))
    # Rows are appended to a month; a month goes; nothing happens.
    lake.append("fact", spark.createDataFrame(made(3, 30, [3]), SCHEMA))
    assert shown(rollups.refresh(lake, ROLLUP)) == plain(lake.table("fact"))
    lake.drop_partitions("fact", [{"month_key": 1}, {"month_key": None}])
    assert shown(rollups.refresh(lake, ROLLUP)) == plain(lake.table("fact"))
    rollups.refresh(lake, ROLLUP)
    assert months_read[0] == sorted([1, 2, 3, None], key=str) and months_read[1:] == [[2, 4], [3], [], []]
    assert {r[0] for r in lake.table(ROLLUP.states).select("month_key").distinct().collect()} == {2, 3, 4}


def test_a_refresh_that_stopped_is_done_again(spark, lake, monkeypatch):
    lake.replace_partitions("fact", spark.createDataFrame(made(1, 200, [1, 2]), SCHEMA), ["month_key"])
    rollups.refresh(lake, ROLLUP)
    lake.replace_partitions("fact", spark.createDataFrame(made(5, 100, [2, 3]), SCHEMA), ["month_key"])
    write = type(lake).replace_partitions

    def stops(self, name, *args, **kwargs):
        if name == ROLLUP.bitmaps:
            raise RuntimeError("lost")
        return write(self, name, *args, **kwargs)

    monkeypatch.setattr(type(lake), "replace_partitions", stops)
    with pytest.raises(RuntimeError):
        rollups.refresh(lake, ROLLUP)
    monkeypatch.setattr(type(lake), "replace_partitions", write)
    assert shown(rollups.refresh(lake, ROLLUP)) == plain(lake.table("fact"))


def test_an_empty_fact(spark, lake):
    lake.replace_partitions("fact", spark.createDataFrame([], SCHEMA), ["month_key"])
    assert rollups.refresh(lake, ROLLUP).count() == 0
    lake.replace_partitions("fact", spark.createDataFrame(made(1, 20, [1]), SCHEMA), ["month_key"])
    assert shown(rollups.refresh(lake, ROLLUP)) == plain(lake.table("fact"))


def test_groups_of_few_keys_have_small_states(spark):
    """A state of one key is a word, not a block of thousands of bits, and is combined in a hash table."""
    rows = spark.range(2000).selectExpr("id AS h", "id % 3 AS p", "id % 70 - 5 AS d", "1 AS month_key")
    bitmaps = rollups.key_bitmaps(rows, ROLLUP)
    assert bitmaps.count() == 4000
    assert dict(bitmaps.dtypes)["bits"] == "bigint"
    plan = bitmaps._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    whole = rollups.key_bitmaps(rows.withColumn("h", rows["h"] % 2), ROLLUP)
    # Odd numbers from -5 to 64: the words of the negative keys, of 0 to 63 and of 64.
    assert sorted(r["bucket"] for r in whole.filter("measure = 'doctors' AND h = 1").collect()) == [-1, 0, 1]


def test_states_without_words_are_computed_from_all_months(spark, lake):
    """A summary whose bitmaps an earlier form of the library kept elsewhere is built anew."""
    lake.replace_partitions("fact", spark.createDataFrame(made(1, 100, [1, 2]), SCHEMA), ["month_key"])
    rollups.refresh(lake, ROLLUP)
    spark.sql(f"ALTER TABLE {lake.full_name(ROLLUP.bitmaps)} RENAME TO {lake.full_name('activity_bitmaps')}")
    assert shown(rollups.refresh(lake, ROLLUP)) == plain(lake.table("fact"))
