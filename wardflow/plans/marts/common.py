"""Feeders and column helpers that several marts share.

Cleaned tables hold one row per id, so ``count`` and ``count_if`` equal a distinct
count of the id and need no row expansion; only real distinct counts of *other*
columns use ``count_distinct``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.expressions import Clock, as_timestamp, latest, rounded_or_zero, zero_if_null

Tables = Mapping[str, DataFrame]


def rows(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def rows_where(condition: Column, name: str) -> Column:
    return F.count_if(condition).alias(name)


def is_(column: str, value: str) -> Column:
    return F.col(column) == value


def visit_activity() -> list[Column]:
    """Counts by type, waiting time and period of a group of visits."""
    return [
        rows("total_visits"),
        rows_where(is_("visit_type", "Outpatient"), "outpatient_visits"),
        rows_where(is_("visit_type", "Inpatient"), "inpatient_visits"),
        rows_where(is_("visit_type", "Follow-up"), "followup_visits"),
        F.avg("waiting_time").alias("avg_wait"),
        F.sum("total_amount").alias("amount"),
        F.avg("total_amount").alias("avg_amount"),
        F.min("visit_date").alias("first_visit_date"),
        F.max("visit_date").alias("last_visit_date"),
    ]


def feedback_by(feedback: DataFrame, key: str) -> DataFrame:
    rating = F.col("rating")
    return feedback.groupBy(key).agg(
        rows("feedback_count"),
        F.avg("rating").alias("avg_rating"),
        F.min("rating").alias("min_rating"),
        F.max("rating").alias("max_rating"),
        rows_where(rating >= 4, "positive_feedback_count"),
        rows_where(rating <= 2, "negative_feedback_count"),
    )


def beds_by(beds: DataFrame, *keys: str) -> DataFrame:
    return beds.groupBy(*keys).agg(
        rows("beds_tracked"),
        rows_where(is_("availability_status", "Available"), "beds_available"),
        rows_where(is_("availability_status", "Occupied"), "beds_occupied"),
        rows_where(is_("bed_type", "ICU"), "icu_beds"),
        rows_where(is_("bed_type", "Standard"), "standard_beds"),
    )


def latest_icu(icu_status: DataFrame) -> DataFrame:
    """Newest ICU report per hospital; the id breaks ties."""
    report = latest(F.struct("occupied_beds", "available_beds", "update_time"), "update_time", "icu_status_id")
    return (
        icu_status.groupBy("hospital_id")
        .agg(report.alias("report"))
        .select(
            "hospital_id",
            F.col("report.occupied_beds").alias("icu_occupied"),
            F.col("report.available_beds").alias("icu_available"),
            F.col("report.update_time").alias("icu_time"),
        )
    )


def zeros(*names: str, **renamed: str) -> list[Column]:
    """``coalesce(x, 0)`` under the same name, or ``new=old`` under a new one."""
    return [zero_if_null(n).alias(n) for n in names] + [zero_if_null(o).alias(n) for n, o in renamed.items()]


def money(**renamed: str | Column) -> list[Column]:
    """Two decimals with 0 for missing, as ``new=old``."""
    return [rounded_or_zero(old).alias(new) for new, old in renamed.items()]


def finished(df: DataFrame, created_at: Clock | None) -> DataFrame:
    return df if created_at is None else df.withColumn("created_at", as_timestamp(created_at))


def top(mart: DataFrame, columns: Sequence[str], order: Sequence[Column], k: int = 10) -> DataFrame:
    """First k rows; ``order`` ends in the grain, so ties are settled."""
    return mart.orderBy(*order).limit(k).select(*columns)
