from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.functions.expressions import (
    Clock,
    as_date,
    band,
    high_medium_low,
    percent_when_positive,
    ratio_when_positive,
    round2,
    safe_divide,
)
from wardflow.operators.joins import feed
from wardflow.plans.marts.common import (
    Tables,
    beds_by,
    finished,
    is_,
    latest_icu,
    money,
    rows,
    rows_where,
    top,
    zeros,
)


@dataclass(frozen=True)
class OperationalThresholds:
    short_wait: float = 30
    long_wait: float = 60
    critical: float = 85
    high: float = 70
    busy_day: int = 100
    normal_day: int = 50


REFERRAL_MEASURES = (
    "referrals_sent",
    "completed_referrals_sent",
    "pending_referrals_sent",
    "referrals_received",
    "completed_referrals_received",
    "pending_referrals_received",
)


def referral_sides(referrals: DataFrame) -> DataFrame:
    """Daily referrals of each hospital: one part for sent, one for received.

    Both parts carry all six measures, zero where the measure is the other side's.
    """

    def side(hospital: str, suffix: str) -> DataFrame:
        counted = referrals.groupBy(
            F.col(hospital).alias("hospital_id"), F.col("referral_date").alias("operation_date")
        ).agg(
            rows(f"referrals_{suffix}"),
            rows_where(is_("referral_status", "Completed"), f"completed_referrals_{suffix}"),
            rows_where(is_("referral_status", "Pending"), f"pending_referrals_{suffix}"),
        )
        absent = {m: F.lit(0).cast("long") for m in REFERRAL_MEASURES if m not in counted.columns}
        return counted.withColumns(absent)

    return side("from_hospital_id", "sent").unionByName(side("to_hospital_id", "received"))


def mart_operational(
    tables: Tables, created_at: Clock | None = None, limits: OperationalThresholds = OperationalThresholds()
) -> DataFrame:
    """Daily operation per hospital, department and visit type."""
    day, hospital = ["hospital_id", "operation_date"], ["hospital_id"]
    visits = (
        tables["visit"]
        .groupBy("hospital_id", "department_id", F.col("visit_date").alias("operation_date"), "visit_type")
        .agg(
            rows("visits"),
            F.count_distinct("patient_id").alias("patients"),
            F.count_distinct("doctor_id").alias("doctors"),
            F.avg("waiting_time").alias("avg_wait"),
            F.min("waiting_time").alias("min_wait"),
            F.max("waiting_time").alias("max_wait"),
            rows_where(is_("visit_status", "Completed"), "completed"),
            rows_where(is_("visit_status", "Cancelled"), "cancelled"),
        )
    )
    # Summed to one row per hospital and day before the join, so nothing multiplies.
    referrals = referral_sides(tables["referral"]).groupBy(*day).agg(
        *[F.sum(m).alias(m) for m in REFERRAL_MEASURES]
    )
    shifts = (
        tables["doctor_schedule"]
        .join(tables["doctor"].select("doctor_id", "hospital_id"), "doctor_id")
        .groupBy("hospital_id", F.col("shift_date").alias("operation_date"))
        .agg(F.count_distinct("doctor_id").alias("scheduled"), rows("shifts"))
    )
    hospitals = tables["hospital"].select(
        "hospital_id",
        "hospital_name",
        "hospital_type",
        "governorate",
        F.col("total_beds").alias("hospital_capacity_beds"),
        F.col("icu_capacity").alias("hospital_icu_capacity"),
    )
    joined = feed(
        visits,
        [
            (referrals, day),
            (shifts, day),
            (beds_by(tables["bed"], "hospital_id", "department_id"), ["hospital_id", "department_id"]),
            (
                tables["department"].select("department_id", "hospital_id", "department_name"),
                ["hospital_id", "department_id"],
            ),
            (hospitals, hospital),
            (latest_icu(tables["icu_status"]), hospital),
        ],
    )
    occupancy = safe_divide(F.col("beds_occupied") * 100.0, "hospital_capacity_beds")
    result = joined.select(
        "hospital_id",
        "hospital_name",
        "hospital_type",
        "governorate",
        "department_id",
        "department_name",
        "operation_date",
        F.date_format("operation_date", "EEEE").alias("day_of_week"),
        F.year("operation_date").alias("visit_year"),
        F.month("operation_date").alias("visit_month"),
        "visit_type",
        *zeros(
            total_visits="visits",
            unique_patients="patients",
            doctors_on_duty="doctors",
            completed_visits="completed",
            cancelled_visits="cancelled",
        ),
        percent_when_positive("completed", "visits").alias("completion_rate_pct"),
        *money(avg_waiting_time_minutes="avg_wait"),
        *zeros(min_waiting_time_minutes="min_wait", max_waiting_time_minutes="max_wait"),
        "hospital_capacity_beds",
        *zeros("beds_tracked", available_beds="beds_available", occupied_beds="beds_occupied"),
        percent_when_positive("beds_occupied", "hospital_capacity_beds").alias("bed_occupancy_rate_pct"),
        *zeros(icu_beds_tracked="icu_beds", standard_beds_tracked="standard_beds"),
        "hospital_icu_capacity",
        *zeros(current_icu_occupied="icu_occupied", current_icu_available="icu_available"),
        percent_when_positive("icu_occupied", "hospital_icu_capacity").alias("icu_occupancy_rate_pct"),
        F.col("icu_time").alias("icu_last_updated"),
        "referrals_sent",
        "referrals_received",
        "completed_referrals_sent",
        "pending_referrals_sent",
        *zeros(doctors_scheduled="scheduled", total_shifts_scheduled="shifts"),
        F.when(F.col("visits") > 0, ratio_when_positive("visits", "doctors"))
        .otherwise(F.lit(0.0))
        .alias("visits_per_doctor"),
        band(
            "avg_wait",
            [
                ("<", limits.short_wait, "Efficient"),
                ("<=", limits.long_wait, "Moderate"),
                (">", limits.long_wait, "Needs Improvement"),
            ],
            "Unknown",
        ).alias("wait_time_efficiency"),
        high_medium_low(occupancy, limits.critical, limits.high, ("Critical", "High", "Normal"), "Unknown").alias(
            "capacity_status"
        ),
        high_medium_low(
            "visits",
            limits.busy_day,
            limits.normal_day,
            ("High Volume", "Medium Volume", "Low Volume"),
            "No Activity",
        ).alias("daily_volume_category"),
    )
    return finished(result, created_at)


def summary_operational(mart: DataFrame, repeat_daily_figures: bool = False) -> DataFrame:
    """Monthly summary per hospital.

    Referral counts belong to a hospital-day and count once;
    ``repeat_daily_figures`` adds them for every department and visit type row.
    """
    group = ["hospital_name", "hospital_type", "visit_year", "visit_month"]
    averaged = {
        "avg_wait_time": "avg_waiting_time_minutes",
        "avg_bed_occupancy": "bed_occupancy_rate_pct",
        "avg_icu_occupancy": "icu_occupancy_rate_pct",
        "avg_completion_rate": "completion_rate_pct",
    }
    if repeat_daily_figures:
        daily = mart.withColumnsRenamed({"referrals_sent": "sent", "referrals_received": "received"})
        means = [F.avg(old).alias(new) for new, old in averaged.items()]
    else:
        # Sums and counts, so that the mean over mart rows stays exact in two levels.
        daily = mart.groupBy("hospital_id", "operation_date", *group).agg(
            F.sum("total_visits").alias("total_visits"),
            F.max("referrals_sent").alias("sent"),
            F.max("referrals_received").alias("received"),
            *[F.sum(old).alias(f"{new}_sum") for new, old in averaged.items()],
            *[F.count(old).alias(f"{new}_n") for new, old in averaged.items()],
        )
        means = [safe_divide(F.sum(f"{new}_sum"), F.sum(f"{new}_n")).alias(new) for new in averaged]
    grouped = daily.groupBy(*group).agg(
        F.sum("total_visits").alias("total_visits"),
        *means,
        F.sum("sent").alias("total_referrals_sent"),
        F.sum("received").alias("total_referrals_received"),
    )
    return grouped.withColumns({name: round2(name) for name in averaged}).orderBy(
        F.desc("visit_year"), F.desc("visit_month"), F.desc("total_visits"), "hospital_name"
    )


def topk_operational(mart: DataFrame, k: int = 10) -> DataFrame:
    columns = [
        "hospital_name",
        "operation_date",
        "day_of_week",
        "department_name",
        "total_visits",
        "avg_waiting_time_minutes",
        "bed_occupancy_rate_pct",
        "wait_time_efficiency",
        "capacity_status",
    ]
    order = [F.desc("operation_date"), F.desc("total_visits")]
    return top(mart, columns, [*order, F.asc("hospital_id"), F.asc("department_id"), F.asc("visit_type")], k)


def lookup_operational(mart: DataFrame, hospital_id: str, day: Clock) -> DataFrame:
    """All rows of one hospital on one day."""
    return mart.filter((F.col("hospital_id") == hospital_id) & (F.col("operation_date") == as_date(day)))


def daily_occupancy(mart: DataFrame) -> DataFrame:
    """Occupied beds per department and day, sorted."""
    return mart.select("hospital_id", "department_id", "operation_date", "visit_type", "occupied_beds").orderBy(
        "hospital_id", "department_id", "operation_date", "visit_type"
    )
