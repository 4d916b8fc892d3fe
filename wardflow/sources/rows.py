"""Rows that come from code: typed inline rows and the date spine."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.functions.expressions import Clock, as_date


def inline_rows(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str) -> DataFrame:
    """A small typed table; the schema is explicit, so all-NULL columns are fine."""
    return spark.createDataFrame(list(rows), schema)


def date_spine(
    spark: SparkSession, start: Clock | Column, end: Clock | Column, bounds: DataFrame | None = None
) -> DataFrame:
    """One row per day from start to end, both included.

    With ``bounds`` (a one-row DataFrame) the ends may be columns of it.
    """
    base = bounds if bounds is not None else spark.range(1)
    days = F.sequence(as_date(start), as_date(end), F.expr("interval 1 day"))
    return base.select(F.explode(days).alias("full_date"))
