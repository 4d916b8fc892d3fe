from __future__ import annotations

import math
import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wardflow.operators import ordering, quality
from wardflow.operators.ordering import exact_quantiles, number_series, with_position


def test_position_equals_global_row_number(spark):
    df = spark.range(5000).select(F.concat(F.lit("P"), F.col("id").cast("string")).alias("k")).repartition(7)
    ours = with_position(df, ["k"], "n")
    plain = df.withColumn("m", F.row_number().over(Window.orderBy("k")))
    assert ours.join(plain, "k").filter("n <> m").count() == 0
    assert ours.count() == 5000


def test_position_starts_after_an_offset_and_puts_null_first(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "k string")
    got = {r.k: r.n for r in with_position(df, ["k"], "n", first=11).collect()}
    assert got == {None: 11, "a": 12, "b": 13}


def test_position_of_an_empty_table(spark):
    assert with_position(spark.createDataFrame([], "k string"), ["k"], "n").count() == 0


def test_rows_are_never_moved_to_one_partition(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    plan = with_position(df, ["k"], "n")._jdf.queryExecution().executedPlan().toString()
    # The only single-partition step runs on one row per partition, after its aggregate.
    lines = [line.lstrip(" :+-") for line in plan.splitlines()]
    alone = [i for i, line in enumerate(lines) if line.startswith("Exchange SinglePartition")]
    assert len(alone) == 1 and lines[alone[0] + 1].startswith("HashAggregate(keys=[_part")


@pytest.mark.parametrize("values", [[1], [1, 2], [1, 2, 3, 4], [5, 5, 5, 5, 1], list(range(101)), [3, 1, 2, 2, None]])
def test_quartiles_match_interpolation(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x int")
    got = {r.probability: r.value for r in exact_quantiles(number_series(df, ["x"]), [0.25, 0.5, 0.75]).collect()}
    known = sorted(v for v in values if v is not None)
    if len(known) == 1:
        want = [known[0]] * 3
    else:
        want = statistics.quantiles(known, n=4, method="inclusive")
    assert [got[0.25], got[0.5], got[0.75]] == pytest.approx(want)


def test_quantiles_of_every_kind_of_number(spark):
    """Against a sort of all values: signs, magnitudes, long tails, neighbours among doubles, infinities, NaN."""
    rng, inf = random.Random(4), float("inf")
    kinds = {
        "signs": [rng.uniform(-1000, 1000) for _ in range(2001)],
        "magnitudes": [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300) for _ in range(1500)],
        "tight": [1.0 + rng.randint(0, 40) * 2.0**-52 for _ in range(900)],
        "tiny": [rng.randint(0, 30) * 5e-324 for _ in range(500)],
        "tail": [2.0**k for k in range(1000)] + [0.5] * 999,
        "cents": [rng.randint(0, 9_999_999) / 100 for _ in range(5000)],
        "ends": [-inf, -inf, -1.0, 0.0, -0.0, 3.0, inf, inf],
        "nan": [1.0, 2.0, float("nan")],
    }
    rows = [(name, v) for name, values in kinds.items() for v in values] + [("same", 7.25)] * 50
    df = spark.createDataFrame(rows, "series string, value double").repartition(5)
    wanted = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {(r.series, r.probability): r.value for r in exact_quantiles(df, wanted).collect()}
    for name, values in kinds.items():
        ordered = sorted(values, key=lambda v: (v != v, v))
        for p in wanted:
            at = p * (len(ordered) - 1)
            low, high = ordered[math.floor(at)], ordered[math.ceil(at)]
            want = low if math.floor(at) == math.ceil(at) else low + (high - low) * (at - math.floor(at))
            assert got[name, p] == want or (want != want and got[name, p] != got[name, p]), (name, p)
    assert {got["same", p] for p in wanted} == {7.25}
    assert exact_quantiles(df.limit(0), wanted).count() == 0


def test_quantiles_shuffle_buckets_and_not_values(spark, monkeypatch):
    seen = []
    real = ordering._bucket_counts
    monkeypatch.setattr(ordering, "_bucket_counts", lambda *a: seen.append(real(*a)) or seen[-1])
    df = spark.range(30000).select(F.lit("s").alias("series"), (F.col("id") * 1.37).alias("value"))
    assert exact_quantiles(df, [0.5]).first().value == pytest.approx(14999.5 * 1.37)
    assert len(seen) >= 2
    for counts in seen:
        plan = counts._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan and "HashAggregate" in plan
    assert seen[0].count() < 1000 and seen[1].count() <= 2 * ordering.BUCKETS


def test_one_pass_ranks_several_tables_and_hot_values(spark):
    many = spark.range(9000).select(F.when(F.col("id") < 6000, 7).otherwise(F.col("id")).alias("x"))
    few = spark.createDataFrame([(1.0, None), (3.0, None)], "a double, empty double")
    fences = quality.iqr_fences({"many": (many, ["x"]), "few": (few, ["a", "empty"])})
    assert fences[("few", "a")] == (1.5, 2.5)
    want = many.selectExpr("percentile(x, 0.25) AS a", "percentile(x, 0.75) AS b").first()
    assert fences[("many", "x")] == (want.a, want.b)
    assert ("few", "empty") not in fences


def test_outlier_fence_reaches_the_scan(spark, lake):
    numbers = spark.range(100).select(F.col("id").alias("k"), F.col("id").cast("double").alias("x"), (-F.col("id")).cast("double").alias("y"))
    table = lake.overwrite("n", numbers)
    far = quality.outlier_values(table, "k", {"x": (25.0, 30.0), "y": (-90.0, -10.0)})
    assert {(r.column_name, r.value) for r in far.collect()} == {("x", float(v)) for v in range(100) if v < 17.5 or v > 37.5}
    plan = far._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(x,17.5)" in plan and plan.count("FileScan") == 1
    assert quality.outlier_values(table, "k", {}).count() == 0
