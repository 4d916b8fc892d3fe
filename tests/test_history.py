from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import listed
from wardflow.operators import scd
from wardflow.sinks import history

COLUMNS = "id string, name string, price decimal(8,2)"
D1, D2, D3, D4 = (dt.date(2024, m, 1) for m in (1, 2, 3, 4))


@pytest.fixture
def schema(spark):
    return scd.dimension_schema("key", COLUMNS)


@pytest.fixture
def load(spark, lake, schema):
    def run(rows, day, **options):
        source = spark.createDataFrame(rows, "id string, name string, price double")
        return history.load_history(lake, "dim", source, schema, "key", "id", ["name", "price"], day, **options)

    return run


def states(df):
    return listed(df, "id", "scd_version", "name", "key", "scd_start_date", "scd_end_date", "scd_is_current")


def files(lake, current):
    found = [f.removeprefix("file://") for f in lake.table("dim").inputFiles() if f"scd_is_current={current}/" in f]
    return {f: os.stat(f).st_mtime_ns for f in found}


LOADS = [
    ([("a", "A", 1.0), ("b", None, 2.0), ("c", "C", 3.0)], D1),
    ([("a", "A2", 1.0), ("b", "B", 2.0), ("d", "D", 4.0)], D2),
    ([("a", "A3", 1.0), ("c", "C", 3.5), ("e", None, None)], D3),
    ([("a", "A3", 1.0), ("b", "B", 9.0)], D3),
    ([("a", "A4", 1.0)], D4),
]


def test_tables_equal_the_whole_dimension_computed_at_once(spark, load, schema):
    target = spark.createDataFrame([], schema)
    for rows, day in LOADS:
        source = spark.createDataFrame(rows, "id string, name string, price double")
        target = spark.createDataFrame(scd.scd2_apply(target, source, "key", "id", ["name", "price"], day).collect(), schema)
        published = load(rows, day)
        assert states(published) == states(target)
    assert listed(published, *schema.names) == listed(target, *schema.names)


def test_closed_files_are_left_alone(lake, load):
    load(*LOADS[0])
    load(*LOADS[1])
    closed = files(lake, 0)
    assert len(closed) > 0
    load(*LOADS[2])
    after = files(lake, 0)
    assert {f: after[f] for f in closed} == closed and len(after) > len(closed)
    # No change at all writes nothing at all.
    before = {**after, **files(lake, 1)}
    load(LOADS[2][0], D4)
    assert {**files(lake, 0), **files(lake, 1)} == before


def test_a_load_reads_no_older_history(lake, load):
    for rows, day in LOADS[:3]:
        load(rows, day)
    old = [f for f in files(lake, 0) if f"scd_end_date={D2 - dt.timedelta(days=1)}" in f]
    assert old
    for f in old:
        os.rename(f, f + ".away")  # whoever reads it now fails
    load(*LOADS[4])
    for f in old:
        os.rename(f + ".away", f)
    assert listed(scd.current_rows(lake.table("dim")).filter("id = 'a'"), "name", "scd_version") == [("A4", 4)]


def test_a_load_that_stopped_between_its_two_steps(lake, load, monkeypatch):
    load(*LOADS[0])
    write, calls = type(lake).replace_partitions, []

    def stops(self, *args, **kwargs):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return write(self, *args, **kwargs)

    monkeypatch.setattr(type(lake), "replace_partitions", stops)
    with pytest.raises(RuntimeError):
        load(*LOADS[1])
    monkeypatch.setattr(type(lake), "replace_partitions", write)
    assert lake.table("dim").filter("id = 'a'").count() == 2
    # The next load is one of a later day.
    after = load(LOADS[1][0], D3)
    end = D3 - dt.timedelta(days=1)
    assert states(after) == [
        ("a", 1, "A", 1, D1, end, 0),
        ("a", 2, "A2", 4, D3, None, 1),
        ("b", 1, None, 2, D1, end, 0),
        ("b", 2, "B", 5, D3, None, 1),
        ("c", 1, "C", 3, D1, None, 1),
        ("d", 1, "D", 6, D3, None, 1),
    ]


def test_an_unpartitioned_dimension_is_taken_over(spark, lake, load, schema):
    source = spark.createDataFrame(LOADS[0][0], "id string, name string, price double")
    lake.overwrite("dim", scd.scd2_first_load(source, schema, "key", "id", D1))
    after = load(*LOADS[1])
    assert lake.partition_columns("dim") == list(history.PARTITIONS) and after.count() == 6
    plan = scd.current_rows(lake.table("dim")).select(F.col("id"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(scd_is_current" in plan
