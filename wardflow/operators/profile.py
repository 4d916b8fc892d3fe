"""Column profiles, each in one pass over the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.operators.cleaning import quoted
from wardflow.operators.joins import join_feeder


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, null_count)`` from a single aggregate over all columns."""
    names = list(columns if columns is not None else df.columns)
    counts = df.agg(*[F.count_if(quoted(c).isNull()).alias(c) for c in names])
    return counts.unpivot([], names, "column_name", "null_count")


def _as_text_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[quoted(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "value"
    )


def value_counts(df: DataFrame, columns: Sequence[str], minimum: int = 2) -> DataFrame:
    """``(column_name, value, value_count)`` of values that occur at least ``minimum`` times.

    One scan for all columns; equal values are counted before the shuffle.
    """
    counts = _as_text_rows(df, columns).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("value_count"))
    return counts.filter(F.col("value_count") >= minimum)


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct values, most frequent value (smallest of equals), its count, minimum, maximum.

    NULL counts as a value for the distinct count and the mode. Minimum and maximum
    follow the column's own type and are shown as text.
    """
    names = list(columns if columns is not None else df.columns)
    counts = value_counts(df, names, minimum=1)
    frequent = counts.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("unique_values"),
        F.max("value_count").alias("appearance_count"),
        F.min_by("value", F.struct((-F.col("value_count")).alias("n"), "value")).alias("most_frequent_value"),
    )
    extremes = [F.min(quoted(c)).cast("string").alias(f"low_{i}") for i, c in enumerate(names)]
    extremes += [F.max(quoted(c)).cast("string").alias(f"high_{i}") for i, c in enumerate(names)]
    pairs = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"low_{i}").alias("min_value"),
                F.col(f"high_{i}").alias("max_value"),
            )
            for i, c in enumerate(names)
        ]
    )
    ranges = df.agg(*extremes).select(F.inline(pairs))
    return frequent.join(ranges, "column_name").select(
        "column_name", "unique_values", "most_frequent_value", "appearance_count", "min_value", "max_value"
    )


def describe(df: DataFrame) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum of text and number columns."""
    known = (T.NumericType, T.StringType)
    return df.describe(*[f.name for f in df.schema.fields if isinstance(f.dataType, known)])


def phone_findings(
    df: DataFrame, phone: str = "phone", emergency: str = "emergency_contact", prefixes: Sequence[str] = ("10", "11", "12", "15")
) -> DataFrame:
    """Each row's phone with the four findings as 0/1 columns.

    A phone is shared when it occurs on more than one row. Uses are counted before
    the shuffle, and the rows of a phone that very many rows share are split.
    """
    shared = (
        df.groupBy(phone).agg(F.count(F.lit(1)).alias("uses")).filter(quoted(phone).isNotNull() & (F.col("uses") > 1))
    )
    text = quoted(phone).cast("string")

    def mark(condition):
        return F.coalesce(condition, F.lit(False)).cast("int")

    return join_feeder(df, shared, [phone]).select(
        *df.columns,
        F.length(text).alias("phone_length"),
        mark(quoted(phone) == quoted(emergency)).alias("equals_emergency_contact"),
        mark(F.length(text) != 10).alias("wrong_length"),
        mark(~F.substring(text, 1, 2).isin(*prefixes)).alias("wrong_prefix"),
        F.col("uses").isNotNull().cast("int").alias("shared_phone"),
    )
