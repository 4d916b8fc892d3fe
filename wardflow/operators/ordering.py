"""Global positions and exact quantiles without a single-task sort."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.operators.cleaning import quoted
from wardflow.session import fresh_path

# monotonically_increasing_id: partition in the upper bits, row number in the lower 33.
_ROW_BITS = 33


def stage(df: DataFrame) -> DataFrame:
    """Write to the shared scratch folder and read back, so every reader sees the same rows.

    Cuts the lineage like a checkpoint does, but keeps columns and sizes visible to
    the planner of whatever reads it.
    """
    spark = df.sparkSession
    folder = fresh_path(spark, "stage")
    df.write.mode("errorifexists").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def _ranged(df: DataFrame, order_by: Sequence[Column]) -> DataFrame:
    """Range-partition and sort; ``_part`` and ``_row`` fix each row's place for good."""
    placed = (
        df.repartitionByRange(*order_by).sortWithinPartitions(*order_by).withColumn("_slot", F.monotonically_increasing_id())
    )
    return stage(placed).withColumns(
        {
            "_part": F.shiftright("_slot", _ROW_BITS),
            "_row": F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
        }
    )


def _starts(totals: DataFrame) -> DataFrame:
    """Running total before each part: one row per part, so a handful of rows."""
    before = Window.partitionBy().orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))


def with_position(df: DataFrame, order_by: Sequence[str], target: str, first: int | Column = 1) -> DataFrame:
    """Number all rows 1, 2, 3, … in the order of ``order_by``, in parallel.

    Rows are range-partitioned and staged once; each partition numbers its own
    rows and adds the row count of the partitions before it. ``order_by`` must be
    unique for a repeatable result. NULLs come first.
    """
    ranged = _ranged(df, [quoted(c) for c in order_by])
    starts = _starts(ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")))
    start = first if isinstance(first, Column) else F.lit(first)
    # One row per partition: bounded by the shuffle partition count, safe to broadcast.
    numbered = ranged.join(F.broadcast(starts), "_part")
    return numbered.withColumn(target, F.col("_start") + F.col("_row") + start).drop("_slot", "_part", "_row", "_start")


def number_series(df: DataFrame, columns: Sequence[str], prefix: str = "") -> DataFrame:
    """Numeric columns as ``(series, value)`` rows; the series is prefix + column."""
    return (
        df.select(*[quoted(c).cast("double").alias(c) for c in columns])
        .unpivot([], list(columns), "series", "value")
        .filter("value IS NOT NULL")
        .withColumn("series", F.concat(F.lit(prefix), F.col("series")))
    )


#: Buckets that a range of values is cut into, round by round.
BUCKETS = 4096
#: Buckets of the first round in each power of e: every double falls into one of some 90,000.
COARSE = 64


def _coarse_bucket(value: Column) -> Column:
    """A bucket by sign and magnitude, in the order of the values; infinities and NaN have their own."""
    size = F.floor(F.log1p(F.abs(value)) * COARSE)
    far = F.lit(1 << 30)
    finite = F.when(value < 0, -size - 1).otherwise(size)
    return F.when(F.isnan(value), far + 1).when(F.abs(value) == float("inf"), F.signum(value) * far).otherwise(finite).cast("long")


def _bucket_counts(values: DataFrame, group: Sequence[str], bucket: Column) -> DataFrame:
    """Each bucket's rows, counted before the shuffle, its extremes, and the ranks it covers in its group."""
    counts = values.groupBy(*group, bucket.alias("_bucket")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("value").alias("_min"), F.max("value").alias("_max")
    )
    upto = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumn("_last", F.sum("_n").over(upto) - 1).withColumn("_first", F.col("_last") - F.col("_n") + 1)


def exact_quantiles(series: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """Interpolated quantiles ``(series, probability, value)`` of ``(series, value)`` rows.

    No value is sorted or shuffled. Rows are counted in buckets by magnitude, the buckets
    that hold the wanted ranks are known by their least and greatest value, and only
    their rows are staged; these are counted in finer buckets, round by round, until a
    bucket is one value. What is shuffled, gathered and broadcast is bounded by the number of buckets,
    series and ranks, whatever the number of rows. One pass serves all series.
    """
    spark = series.sparkSession
    counts = _bucket_counts(series, ["series"], _coarse_bucket(F.col("value")))
    size = F.sum("_n").over(Window.partitionBy("series"))
    asked = F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("probability")
    hits = counts.withColumn("_size", size).select("*", asked).withColumn("_at", F.col("probability") * (F.col("_size") - 1))
    hits = hits.select("*", F.explode(F.array_distinct(F.array(F.floor("_at"), F.ceil("_at")))).alias("_rank"))
    hits = hits.filter(F.col("_rank").between(F.col("_first"), F.col("_last")))
    # At most two rows for each series and probability.
    found = hits.select("series", "probability", "_at", "_rank", "_first", "_min", "_max").collect()
    ranges = {(r["series"], r["_rank"]): (r["_min"], r["_max"], r["_rank"] - r["_first"]) for r in found}
    near = None
    while still := {k: v for k, v in ranges.items() if v[0] < v[1]}:
        wanted = [(name, rank, *place) for (name, rank), place in still.items()]
        wanted = spark.createDataFrame(wanted, "series string, _rank bigint, _low double, _high double, _inside bigint")
        bounds = F.broadcast(wanted.select("series", "_low", "_high").distinct())
        held = (series if near is None else near).join(bounds, "series").filter("value BETWEEN _low AND _high")
        if near is None:
            near = stage(held.select("series", "value"))
            held = near.join(bounds, "series").filter("value BETWEEN _low AND _high")
        share = (F.col("value") - F.col("_low")) / (F.col("_high") - F.col("_low"))
        bucket = F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1))
        narrowed = _bucket_counts(held, ["series", "_low", "_high"], bucket)
        hits = narrowed.join(F.broadcast(wanted), ["series", "_low", "_high"])
        for r in hits.filter(F.col("_inside").between(F.col("_first"), F.col("_last"))).collect():
            ranges[r["series"], r["_rank"]] = r["_min"], r["_max"], r["_inside"] - r["_first"]

    def value(row, rank: int) -> float:
        return ranges[row["series"], rank][0]

    told = {}
    for row in found:
        low, high = math.floor(row["_at"]), math.ceil(row["_at"])
        bottom = value(row, low)
        told[row["series"], row["probability"]] = bottom if low == high else bottom + (value(row, high) - bottom) * (row["_at"] - low)
    rows = [(name, p, v) for (name, p), v in told.items()]
    return spark.createDataFrame(rows, "series string, probability double, value double")
