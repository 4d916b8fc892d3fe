from __future__ import annotations

import datetime as dt
import threading
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import listed
from wardflow.operators.upsert import assert_unique, column_changes, snapshot_diff, unequal_buckets, upsert, upsert_partitions
from wardflow.operators import watermark as wm
from wardflow.operators.ordering import stage
from wardflow.plans import bronze, warehouse
from wardflow.session import drop_old_stages
from wardflow.sinks.store import conform, counted, validate_load
from wardflow.sources.files import discover_csv, read_csv, with_source_metadata
from wardflow.sources.jdbc import Split, jdbc_options
from wardflow.sources.rows import date_spine, inline_rows


def frame(spark, rows, schema="k string, v int"):
    return spark.createDataFrame(rows, schema)


def test_overwrite_may_read_the_table_it_replaces(spark, lake):
    lake.overwrite("t", frame(spark, [("a", 1)]))
    lake.overwrite("t", lake.table("t").withColumn("w", F.col("v") + 1))
    assert listed(lake.table("t")) == [("a", 1, 2)]


def test_append_keeps_declared_columns_and_evolving_append_adds_new_ones(spark, lake):
    lake.append("t", frame(spark, [("a", 1)]))
    lake.append("t", frame(spark, [(2, "b")], "v bigint, k string"))
    assert listed(lake.table("t")) == [("a", 1), ("b", 2)]
    lake.append_evolving("t", frame(spark, [("c", 3, "new")], "k string, v int, w string"))
    lake.append_evolving("t", frame(spark, [("d", 4)]))
    assert listed(lake.table("t")) == [("a", 1, None), ("b", 2, None), ("c", 3, "new"), ("d", 4, None)]


def test_partition_replacement_keeps_the_other_days(spark, lake):
    schema = "v int, day string"
    lake.replace_partitions("t", frame(spark, [(1, "d1"), (2, "d2")], schema), ["day"])
    lake.replace_partitions("t", frame(spark, [(9, "d2"), (3, "d3")], schema), ["day"])
    assert listed(lake.table("t")) == [(1, "d1"), (3, "d3"), (9, "d2")]


def test_partition_replacement_from_threads_in_a_static_session(spark, lake):
    """Loads side by side, whatever the session's mode: all other days stay, the settings too."""
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "static")
    try:
        rows = spark.range(400).select("id", (F.col("id") % 4).cast("int").alias("day"))
        names = [f"t{i}" for i in range(6)]
        for name in names:
            lake.replace_partitions(name, rows, ["day"])
        with ThreadPoolExecutor(4) as pool:
            list(pool.map(lambda n: lake.replace_partitions(n, rows.filter("day = 2").limit(7), ["day"]), names))
        assert {lake.table(n).count() for n in names} == {307}
        assert spark.conf.get(setting) == "static"
    finally:
        spark.conf.set(setting, before)


def test_names_are_matched_without_case(spark, lake):
    lake.append("t", frame(spark, [(1, "a")], "id int, name string"))
    lake.append("t", frame(spark, [("b", 2)], "NAME string, ID int"))
    assert listed(lake.table("t")) == [(1, "a"), (2, "b")] and lake.table("t").columns == ["id", "name"]
    lake.replace_partitions("p", frame(spark, [(1, "x")], "v int, day string"), ["day"])
    lake.replace_partitions("p", frame(spark, [("y", 2, 3)], "DAY string, V int, More int"), ["day"], evolve=True)
    assert listed(lake.table("p"), "v", "more", "day") == [(1, None, "x"), (2, 3, "y")]
    target = frame(spark, [("a", 1), ("b", 2)])
    merged = upsert(target, frame(spark, [(5, "a"), (6, "c")], "V int, K string"), ["k"])
    assert listed(merged) == [("a", 5), ("b", 2), ("c", 6)] and merged.columns == ["k", "v"]
    assert listed(upsert(target, frame(spark, [(5, "a")], "V int, K string"), ["K"], ["V"])) == [("a", 5), ("b", 2)]
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        twice = spark.range(1).select(F.lit(1).alias("id"), F.lit(2).alias("ID"))
        for write in (lake.append, conform):
            with pytest.raises(ValueError, match="differ only in case"):
                write("t", twice) if write == lake.append else write(twice, lake.table("t").schema)
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")


def test_partitions_are_moved_one_by_one_and_stay_whole(spark, lake):
    """A reader that looks again and again finds each month as it was or as it will be."""
    rows = spark.range(3000).select("id", (F.col("id") % 3).cast("int").alias("month"))
    lake.replace_partitions("t", rows.withColumn("load", F.lit(0)), ["month"])
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            spark.catalog.refreshTable(lake.full_name("t"))
            seen.extend(listed(spark.table(lake.full_name("t")).groupBy("month").agg(F.count("id"), F.count_distinct("load"))))

    reader = threading.Thread(target=read)
    reader.start()
    for load in range(1, 5):
        lake.replace_partitions("t", rows.filter("month > 0").withColumn("load", F.lit(load)), ["month"])
    stop.set()
    reader.join()
    assert len(seen) > 6 and set(seen) == {(m, 1000, 1) for m in range(3)}
    assert listed(lake.table("t").groupBy("load", "month").count()) == [(0, 0, 1000), (4, 1, 1000), (4, 2, 1000)]
    # Superseded snapshots go, and of the first one the two months that were replaced.
    assert lake.drop_old_snapshots("t") == 5 and lake.table("t").count() == 3000


def test_a_failed_load_leaves_every_partition(spark, lake):
    lake.replace_partitions("t", frame(spark, [(1, "d1"), (2, "d2")], "v int, day string"), ["day"])
    broken = frame(spark, [(1, "d1"), (0, "d2")], "v int, day string").withColumn("v", F.expr("CASE WHEN v = 0 THEN raise_error('x') ELSE 9 END").cast("int"))
    with pytest.raises(Exception, match="x"):
        lake.replace_partitions("t", broken, ["day"])
    assert listed(lake.table("t")) == [(1, "d1"), (2, "d2")]


def test_partition_values_of_all_kinds(spark, lake):
    values = ["01", "a b", "it's", "x=y/z", "50%", "ü+", None]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "v int, p string")
    lake.replace_partitions("t", rows, ["p"])
    lake.replace_partitions("t", rows.withColumn("v", F.col("v") + 10), ["p"])
    assert listed(lake.table("t"), "p", "v") == sorted([(v, i + 10) for i, v in enumerate(values)], key=str)
    emptied = [{"p": v} for v in values[2:]]
    lake.replace_partitions("t", rows.filter("p = '01'"), ["p"], emptied=emptied)
    assert listed(lake.table("t"), "p", "v") == [("01", 0), ("a b", 11)]
    # What was taken out does not come back with rows that are appended to the same partition.
    lake.append("t", rows.filter("p IS NULL OR p = '50%'"))
    assert listed(lake.table("t"), "p", "v") == sorted([("01", 0), ("a b", 11), ("50%", 4), (None, 6)], key=str)
    lake.drop_old_snapshots("t")
    assert lake.table("t").count() == 4


def test_an_emptied_partition_rewrites_no_other(spark, lake):
    schema = "k string, v int, month int"
    upsert_partitions(lake, "f", frame(spark, [("a", 1, 1), ("b", 1, 2), ("c", 1, 3)], schema), ["k"], "month")
    before = {f for f in lake.table("f").inputFiles() if "month=1" in f}
    merged = upsert_partitions(lake, "f", frame(spark, [("c", 2, 2)], schema), ["k"], "month")
    assert listed(merged) == [("a", 1, 1), ("b", 1, 2), ("c", 2, 2)]
    assert {f for f in merged.inputFiles() if "month=1" in f} == before
    assert listed(spark.sql(f"SHOW PARTITIONS {lake.full_name('f')}")) == [("month=1",), ("month=2",)]


def test_a_partitioned_snapshot_is_published_without_a_gap(spark, lake):
    rows = spark.range(20).select("id", (F.col("id") % 4).cast("int").alias("p"))
    lake.overwrite("t", rows, ["p"])
    entry = spark.sql(f"DESCRIBE TABLE EXTENDED {lake.full_name('t')}").filter("col_name = 'Created Time'").first()
    lake.overwrite("t", rows.filter("p > 1").withColumn("w", F.lit(1)), ["p"])
    assert listed(lake.table("t").groupBy("p", "w").count()) == [(2, 1, 5), (3, 1, 5)]
    assert spark.sql(f"DESCRIBE TABLE EXTENDED {lake.full_name('t')}").filter("col_name = 'Created Time'").first() == entry


def test_writers_refuse_or_add_unknown_columns(spark, lake):
    wide = frame(spark, [("b", 2, "x")], "k string, v int, w string")
    for write in (lake.append, lambda n, df, **how: lake.replace_partitions(n, df, ["v"], **how)):
        name = f"t{id(write)}"
        lake.overwrite(name, frame(spark, [("a", 1)]), ["v"])
        with pytest.raises(ValueError, match="no columns"):
            write(name, wide)
        write(name, wide, evolve=True)
        assert listed(lake.table(name), "k", "v", "w") == [("a", 1, None), ("b", 2, "x")]


def test_table_can_be_read_by_name_while_it_is_published(spark, lake):
    lake.overwrite("t", frame(spark, [("a", 1)]))
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            seen.append(spark.catalog.tableExists(lake.full_name("t")) and len(spark.table(lake.full_name("t")).columns))

    reader = threading.Thread(target=read)
    reader.start()
    for i in range(5):
        lake.overwrite("t", frame(spark, [("a", i)]).withColumns({f"c{j}": F.lit(j) for j in range(i)}))
    stop.set()
    reader.join()
    assert set(seen) <= {2, 3, 4, 5, 6} and len(seen) > 5
    assert lake.table("t").columns[:2] == ["k", "v"] and listed(lake.table("t"), "v", "c3") == [(4, 3)]
    assert lake.drop_old_snapshots("t") == 5 and lake.table("t").count() == 1


def test_old_stages_are_removed_by_age(spark):
    rows = stage(spark.range(3))
    assert drop_old_stages(spark, 3600) == 0 and rows.count() == 3


def test_conform_casts_orders_and_fills(spark):
    want = T.StructType.fromDDL("v bigint, missing date, k string")
    got = conform(frame(spark, [("a", 1)]), want)
    assert got.schema == want and listed(got) == [(1, None, "a")]


def test_counts_come_from_the_write(spark, lake):
    watched, watch = counted(frame(spark, [("a", None), (None, None), ("b", 1)]))
    table = lake.overwrite("t", watched)
    assert watch.get == {"rows": 3, "nulls_0": 1, "nulls_1": 2}
    assert validate_load(3, table) == "SUCCESS" and validate_load(4, table) == "MISMATCH"


# Merging


def test_upsert_inserts_updates_and_respects_the_rule(spark):
    target = frame(spark, [("a", None, "old"), ("b", 1, "old"), (None, None, "old")], "k string, v int, n string")
    source = frame(spark, [("a", 5, "new"), ("b", 6, "new"), ("c", 7, "new"), (None, 8, "new")], "k string, v int, n string")
    every = upsert(target, source, ["k"])
    assert listed(every) == listed(source)
    only_open = upsert(target, source, ["k"], ["v"], F.col("tgt.v").isNull())
    assert listed(only_open) == sorted([("a", 5, "old"), ("b", 1, "old"), ("c", 7, "new"), (None, 8, "old")], key=str)
    assert listed(upsert(every, source, ["k"])) == listed(every)


def test_merge_source_must_be_unique(spark):
    with pytest.raises(ValueError, match="duplicate key"):
        assert_unique(frame(spark, [("a", 1), ("a", 2)]), ["k"])


def test_partitioned_upsert_touches_only_affected_partitions(spark, lake):
    schema = "k string, v int, month int"
    upsert_partitions(lake, "f", frame(spark, [("a", 1, 1), ("b", 1, 2), ("c", 1, 3)], schema), ["k"], "month")
    upsert_partitions(lake, "f", frame(spark, [("b", 2, 2), ("d", 2, 2)], schema), ["k"], "month")
    assert listed(lake.table("f")) == [("a", 1, 1), ("b", 2, 2), ("c", 1, 3), ("d", 2, 2)]
    # A row that moves to another partition leaves no copy behind, even the last one.
    upsert_partitions(lake, "f", frame(spark, [("c", 3, 2)], schema), ["k"], "month")
    assert listed(lake.table("f")) == [("a", 1, 1), ("b", 2, 2), ("c", 3, 2), ("d", 2, 2)]
    before = listed(lake.table("f"))
    upsert_partitions(lake, "f", frame(spark, [("c", 3, 2)], schema), ["k"], "month")
    assert listed(lake.table("f")) == before


def test_merge_over_thousands_of_partitions_with_a_new_column(spark, lake):
    rows = spark.range(2400).select(F.col("id").alias("k"), F.lit("old").alias("v"), (F.col("id") % 1200).cast("int").alias("p"))
    lake.overwrite("t", rows.repartition(4, "p"), ["p"])
    batch = rows.filter("k % 2 = 0 AND k < 2400").withColumns({"v": F.lit("new"), "w": F.lit(1)})
    merged = upsert_partitions(lake, "t", batch.repartition(4, "p"), ["k"], "p")
    assert listed(merged.groupBy("v", "w").count()) == sorted([("old", None, 1200), ("new", 1, 1200)], key=str)


def test_snapshot_diff_labels_rows(spark):
    before = frame(spark, [("same", 1), ("gone", 2), ("changed", 3), ("null", None)])
    after = frame(spark, [("same", 1), ("new", 4), ("changed", 5), ("null", None)])
    assert listed(snapshot_diff(before, after, ["k"])) == [
        ("changed", 5, "update"),
        ("gone", 2, "delete"),
        ("new", 4, "insert"),
    ]


def test_snapshot_diff_compares_only_buckets_that_changed(spark, lake):
    rows = spark.range(20000).select("id", F.expr("CASE WHEN id % 7 > 0 THEN cast(id AS string) END").alias("v"), F.col("id").cast("double").alias("x"))
    before = lake.overwrite("a", rows)
    after = lake.overwrite("b", rows.filter("id <> 5").withColumn("v", F.when(F.col("id") == 8, None).when(F.col("id") == 14, "new").otherwise(F.col("v"))).repartition(5))
    changing = unequal_buckets(before, after, ["id"], 512)
    assert 1 <= changing.count() <= 3
    diff = snapshot_diff(before, after, ["ID"], 512)
    assert listed(diff, "id", "v", "change_type") == [(14, "new", "update"), (5, "5", "delete"), (8, None, "update")]
    # What is shuffled by key is no more than the rows of those buckets.
    key = F.pmod(F.xxhash64(F.lit("0"), "id"), F.lit(512)).cast("int")
    near = rows.filter(key.isin(*[r[0] for r in changing.collect()])).count()
    assert 3 <= near < 400
    assert snapshot_diff(before, lake.overwrite("c", rows.repartition(3)), ["id"]).count() == 0


def test_digests_see_nulls_that_move_and_swapped_rows(spark):
    one = frame(spark, [("k", "a", None), ("l", "x", "y")], "id string, u string, w string")
    two = frame(spark, [("k", None, "a"), ("l", "x", "y")], "id string, u string, w string")
    swapped = frame(spark, [("l", "a", None), ("k", "x", "y")], "id string, u string, w string")
    assert listed(snapshot_diff(one, two, ["id"])) == [("k", None, "a", "update")]
    assert len(listed(snapshot_diff(one, swapped, ["id"], 1))) == 2
    keyless = frame(spark, [(None, "a", "b")], one.schema)
    assert listed(snapshot_diff(keyless, one.union(keyless), ["id"]), "change_type") == [("insert",), ("insert",)]


def test_snapshot_diff_with_columns_that_came_went_or_changed(spark):
    before = frame(spark, [(1, "a", 5), (2, "b", None), (3, "c", None)], "id int, Name string, old int")
    after = frame(spark, [(1, "a", None), (2, "b", None), (3, "c", 1.5)], "ID bigint, name string, fresh double")
    assert column_changes(before, after) == [
        ("ID", "retyped", "int", "bigint"), ("old", "removed", "int", None), ("fresh", "added", None, "double"),
    ]
    got = snapshot_diff(before, after, ["id"])
    assert got.columns == ["ID", "name", "fresh", "old", "change_type"]
    assert listed(got) == [(1, "a", None, None, "update"), (3, "c", 1.5, None, "update")]
    assert column_changes(after, after) == [] and snapshot_diff(after, after, ["id"]).count() == 0
    assert {r.change_type for r in snapshot_diff(after.limit(0), after, ["id"]).collect()} == {"insert"}


# Watermarks


def test_watermark_life(spark):
    control = wm.wm_init(spark.createDataFrame([], wm.SCHEMA), wm.seed_rows(spark))
    assert listed(wm.wm_init(control, wm.seed_rows(spark))) == listed(control)
    assert wm.wm_read(control, "fact_claims") == dt.date(2024, 5, 8)
    assert wm.wm_read(control, "unknown") == dt.date(1900, 1, 1)
    loads = [
        ("fact_claims", dt.date(2024, 6, 1), 3),
        ("fact_visits", None, 0),
        ("fact_pharmacy", dt.date(2020, 1, 1), 2),
    ]
    moved = wm.wm_advance(control, frame(spark, loads, "table_name string, max_date date, row_count bigint"))
    assert listed(moved, "table_name", "last_loaded_date") == [
        ("fact_claims", dt.date(2024, 6, 1)),
        ("fact_pharmacy", dt.date(2024, 5, 8)),
        ("fact_visits", dt.date(2024, 5, 8)),
    ]


def test_watermark_filter_reaches_the_scan(spark, lake):
    days = frame(spark, [(dt.date(2024, 1, 1), "x"), (dt.date(2024, 2, 1), "y")], "day date, s string")
    table = lake.overwrite("t", days)
    kept = table.filter(wm.after_watermark("day", dt.date(2024, 1, 15), F.col("s") == "x"))
    assert kept.count() == 2
    assert "Or(GreaterThan(day,2024-01-15),EqualTo(s,x))" in kept._jdf.queryExecution().executedPlan().toString()
    assert table.filter(wm.after_watermark("day", dt.date(2024, 2, 1), lookback_days=31)).count() == 1


# Files


def test_bronze_load_measures_and_records_failures(spark, lake):
    folder = f"{lake.root}/in"
    frame(spark, [("a", None), ("b", 2)]).write.option("header", True).csv(f"{folder}/Good.csv")
    frame(spark, [("a", 1)]).write.option("header", True).csv(f"{folder}/bad.csv")
    first = bronze.ingest_folder(lake, folder, "r1", "2024-01-01", {"bad": "k string, k string"})
    got = {r.table_name.split(".")[-1]: r for r in first.collect()}
    assert (got["good"].row_count, got["good"].total_null_values, got["good"].null_percentage) == (2, 1, 25.0)
    assert got["good"].status == "SUCCESS" and got["good"].file_size_bytes > 0
    assert (got["bad"].status, got["bad"].row_count) == ("FAILED", 0) and got["bad"].error_message
    bronze.ingest_folder(lake, folder, "r2", "2024-01-02")
    # Another day adds its partition and leaves the first one.
    days = lake.table("good").groupBy("ingestion_date").count()
    assert listed(days.select(F.col("ingestion_date").cast("string"), "count")) == [("2024-01-01", 2), ("2024-01-02", 2)]
    history = bronze.metrics_history(lake.table(bronze.METRICS_TABLE)).collect()
    assert [r.pipeline_run_id for r in history] == ["r2", "r2", "r1", "r1"]


def test_bronze_spellings_subfolders_new_columns_and_any_error(spark, lake, monkeypatch):
    folder = f"{lake.root}/in"
    frame(spark, [("a", 1)]).coalesce(1).write.option("header", True).csv(f"{folder}/Claim.csv")
    frame(spark, [("b", 2)]).coalesce(1).write.option("header", True).csv(f"{folder}/sub/claim.csv")
    frame(spark, [("c", 3)]).write.option("header", True).csv(f"{folder}/other.csv")
    got = {r.table_name.split(".")[-1]: r for r in bronze.ingest_folder(lake, folder, "r1", "2024-01-01").collect()}
    assert (got["claim"].status, got["claim"].row_count, got["other"].row_count) == ("SUCCESS", 2, 1)
    assert listed(lake.table("claim"), "k", "v") == [("a", 1), ("b", 2)]

    wide = f"{lake.root}/in2"
    frame(spark, [("d", 4, "x")], "k string, v int, w string").write.option("header", True).csv(f"{wide}/claim.csv")
    bronze.ingest_folder(lake, wide, "r2", "2024-01-02")
    assert listed(lake.table("claim"), "k", "w") == [("a", None), ("b", None), ("d", "x")]

    load = bronze.load_table
    broken = lambda store, name, *rest: 1 // 0 if name == "claim" else load(store, name, *rest)
    monkeypatch.setattr(bronze, "load_table", broken)
    got = {r.table_name.split(".")[-1]: r.status for r in bronze.ingest_folder(lake, folder, "r3", "2024-01-03").collect()}
    assert got == {"claim": "FAILED", "other": "SUCCESS"}


def text_files(folder, **lines):
    """Files of given lines; a double underscore in a name parts folder and file."""
    for name, content in lines.items():
        path = Path(folder, f"{name.replace('__', '/')}.csv")
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("".join(f"{line}\n" for line in content))


def loaded(spark, lake, folder, run="r1", day="2024-01-01", schemas=None):
    return {r.table_name.split(".")[-1]: r for r in bronze.ingest_folder(lake, folder, run, day, schemas).collect()}


def test_files_are_read_by_their_own_headers(spark, lake):
    folder = f"{lake.root}/in"
    text_files(
        folder,
        t=["id,name", "1,a"],
        sub__T=["NAME,Id", "b,2", "c,3"],
        x__t=["id", "4"],
        y__t=["note,name,ID", "n,d,5"],
        z__t=["", "  ", "id,name", "", "6,f"],
        q__t=[],
    )
    got = loaded(spark, lake, folder)["t"]
    assert (got.status, got.row_count, got.column_count, got.rejected_rows) == ("SUCCESS", 6, 3, 0)
    rows = [(1, "a", None), (2, "b", None), (3, "c", None), (4, None, None), (5, "d", "n"), (6, "f", None)]
    assert listed(lake.table("t"), "id", "name", "note") == rows and got.total_null_values == 6
    assert dict(lake.table("t").dtypes)["Id"] == "int"  # spelled as in the first file
    # A second day with another spelling is stored, and its NULLs are those of the table.
    later = f"{lake.root}/in2"
    text_files(later, t=["ID,Name", "7,g", "8,"])
    got = loaded(spark, lake, later, "r2", "2024-01-02")["t"]
    assert (got.status, got.row_count, got.total_null_values) == ("SUCCESS", 2, 1)
    assert listed(lake.table("t").filter("pipeline_run_id = 'r2'"), "id", "name") == [(7, "g"), (8, None)]


def test_types_of_several_headers_are_brought_together(spark, lake):
    folder = f"{lake.root}/in"
    text_files(folder, t=["a,b,c", "1,2,3"], u__t=["b,a,c", "2.5,x,3000000000"])
    assert loaded(spark, lake, folder)["t"].status == "SUCCESS"
    assert [dict(lake.table("t").dtypes)[c] for c in "abc"] == ["string", "double", "bigint"]
    assert listed(lake.table("t"), "a", "b", "c") == [("1", 2.0, 3), ("x", 2.5, 3000000000)]


def test_rows_that_do_not_fit_are_set_aside_and_counted(spark, lake):
    folder, schemas = f"{lake.root}/in", {"t": "id int, day date"}
    text_files(folder, t=["day,id", "2024-01-01,1", "never,2", "2024-01-02", "2024-01-03,3,4"], ok__u=["k", "1"])
    got = loaded(spark, lake, folder, schemas=schemas)
    assert (got["t"].row_count, got["t"].rejected_rows, got["t"].status) == (1, 3, "SUCCESS")
    assert (got["u"].row_count, got["u"].rejected_rows) == (1, 0) and not lake.exists("u_rejects")
    rejects = lake.table("t_rejects")
    assert listed(rejects, "raw_row", "pipeline_run_id") == [("2024-01-02", "r1"), ("2024-01-03,3,4", "r1"), ("never,2", "r1")]
    assert all(r.source_file_path.endswith("/t.csv") for r in rejects.collect())
    # Loading the day again replaces its rejects; without any, they are taken out.
    loaded(spark, lake, folder, "r2", schemas=schemas)
    assert listed(lake.table("t_rejects").groupBy("pipeline_run_id").count()) == [("r2", 3)]
    better = f"{lake.root}/in2"
    text_files(better, t=["id,day", "9,2024-02-01"])
    loaded(spark, lake, better, "r3", schemas=schemas)
    assert lake.table("t_rejects").count() == 0 and listed(lake.table("t"), "id", "pipeline_run_id") == [(9, "r3")]
    # A day that comes without rows holds none, and other days stay.
    nothing = f"{lake.root}/in3"
    text_files(nothing, t=["id,day"])
    loaded(spark, lake, folder, "r4", "2024-01-05", schemas)
    assert loaded(spark, lake, nothing, "r5", schemas=schemas)["t"].row_count == 0
    assert listed(lake.table("t"), "id", "pipeline_run_id") == [(1, "r4")]


def test_a_name_twice_in_a_header_fails_its_table_alone(spark, lake):
    folder = f"{lake.root}/in"
    text_files(folder, t=["id,ID", "1,2"], u=["id", "3"], v=['"a,b",c', "4,5"])
    got = loaded(spark, lake, folder)
    assert got["t"].status == "FAILED" and "twice" in got["t"].error_message
    assert got["u"].status == "SUCCESS" and listed(lake.table("v"), "`a,b`", "c") == [(4, 5)]


def test_steps_go_on_after_any_error(spark, lake):
    steps = {"missing": lambda: {}["visit_silver"], "broken": lambda: 1 // 0, "fine": lambda: None}
    assert listed(warehouse.run_steps(lake, steps, "2024-01-01"), "step", "status") == [
        ("broken", "failed"), ("fine", "success"), ("missing", "failed"),
    ]
    assert lake.table("run_audit").count() == 3
    assert {r.status for r in warehouse.build_marts(lake, "2024-01-01").collect()} == {"failed"}


def test_discovery_takes_files_and_folders(spark, lake):
    folder = f"{lake.root}/in"
    frame(spark, [("a", 1)]).coalesce(1).write.csv(f"{folder}/My Table.csv")
    assert listed(discover_csv(spark, folder), "table_name", "source_name") == [("my table", "My Table.csv")]


def test_csv_inference_and_file_columns(spark, lake):
    folder = f"{lake.root}/x.csv"
    frame(spark, [("0100", None)], "phone string, nothing string").write.option("header", True).csv(folder)
    assert dict(read_csv(spark, folder).dtypes) == {"phone": "int", "nothing": "string"}
    typed = with_source_metadata(read_csv(spark, folder, "phone string, nothing string"))
    row = typed.first()
    assert row.phone == "0100" and row.source_file.endswith(".csv") and row.source_file_size > 0


def test_jdbc_options_split_the_read_and_keep_secrets_out(monkeypatch):
    monkeypatch.setenv("JDBC_USER", "u")
    monkeypatch.delenv("JDBC_PASSWORD", raising=False)
    options = jdbc_options("jdbc:x", "t", split=Split("id", 1, 1000, 16))
    assert options == {
        "url": "jdbc:x",
        "dbtable": "t",
        "fetchsize": "10000",
        "user": "u",
        "partitionColumn": "id",
        "lowerBound": "1",
        "upperBound": "1000",
        "numPartitions": "16",
    }


def test_inline_rows_and_spine(spark):
    assert listed(inline_rows(spark, [(None,)], "x string")) == [(None,)]
    assert date_spine(spark, "2024-01-01", "2026-12-31").count() == 1096
    assert date_spine(spark, "2024-01-01", "2024-01-01").count() == 1


def test_arriving_files_are_merged_once(spark, lake):
    from wardflow.streaming.incremental import arriving_csv, merge_available

    folder, schema = f"{lake.root}/arriving", "k string, v int, month int"

    def arrive(rows):
        frame(spark, rows, schema).coalesce(1).write.mode("append").option("header", True).csv(folder)

    def run():
        stream = arriving_csv(spark, folder, schema)
        merge_available(stream, lake, "s", ["k"], "month", f"{lake.root}/progress").awaitTermination()
        return listed(lake.table("s"))

    arrive([("a", 1, 1), ("a", 1, 1), ("b", 1, 1)])
    assert run() == [("a", 1, 1), ("b", 1, 1)]
    arrive([("b", 2, 1), ("c", 3, 2)])
    want = [("a", 1, 1), ("b", 2, 1), ("c", 3, 2)]
    assert run() == want and run() == want
