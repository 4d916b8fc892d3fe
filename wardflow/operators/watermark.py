"""High-water dates of the incremental facts, kept in a small control table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.functions.expressions import Clock, as_column, as_date, latest

SCHEMA = "table_name string, last_loaded_date date"

# The day before the study period, and the fallback without a row.
FIRST_WATERMARK = dt.date(2024, 5, 8)
NO_WATERMARK = dt.date(1900, 1, 1)
FACTS = ("fact_visits", "fact_claims", "fact_pharmacy")


def seed_rows(spark: SparkSession, names: Iterable[str] = FACTS, date: dt.date = FIRST_WATERMARK) -> DataFrame:
    return spark.createDataFrame([(n, date) for n in names], SCHEMA)


def wm_init(control: DataFrame, seeds: DataFrame) -> DataFrame:
    """One row per table: the control row where there is one, else the seed.

    A second run changes nothing.
    """
    both = control.withColumn("known", F.lit(True)).unionByName(seeds.withColumn("known", F.lit(False)))
    return both.groupBy("table_name").agg(latest("last_loaded_date", "known", "last_loaded_date").alias("last_loaded_date"))


def wm_read(control: DataFrame, name: str, default: dt.date = NO_WATERMARK) -> dt.date:
    row = control.filter(F.col("table_name") == name).agg(F.max("last_loaded_date")).first()
    return row[0] or default


def wm_advance(control: DataFrame, loaded: DataFrame) -> DataFrame:
    """Move to the newest loaded date of each table in ``loaded`` (table_name, max_date, row_count).

    A table without loaded rows keeps its date, and a date never moves back.
    """
    moved = loaded.filter((F.col("row_count") > 0) & F.col("max_date").isNotNull())
    return (
        control.alias("c")
        .join(moved.alias("l"), F.col("c.table_name") == F.col("l.table_name"), "left")
        .select(
            F.col("c.table_name").alias("table_name"),
            F.greatest(F.col("c.last_loaded_date"), F.col("l.max_date")).alias("last_loaded_date"),
        )
    )


def load_summary(staged: DataFrame, name: str, date_column: str) -> DataFrame:
    """Row count and newest date of a load, in one aggregate."""
    return staged.agg(
        F.lit(name).alias("table_name"),
        F.max(date_column).alias("max_date"),
        F.count(F.lit(1)).alias("row_count"),
    )


def after_watermark(
    date_column: str | Column, watermark: Clock, also: Column | None = None, lookback_days: int = 0
) -> Column:
    """Rows newer than the watermark (minus a lookback for late rows), or matching ``also``.

    The watermark is a literal, so the predicate reaches the Parquet scan.
    """
    newer = as_column(date_column) > F.date_sub(as_date(watermark), lookback_days)
    return newer if also is None else newer | also
