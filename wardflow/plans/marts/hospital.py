from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.functions.expressions import (
    Clock,
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
    feedback_by,
    finished,
    is_,
    latest_icu,
    money,
    rows,
    rows_where,
    top,
    visit_activity,
    zeros,
)


@dataclass(frozen=True)
class HospitalThresholds:
    high_volume: int = 10000
    medium_volume: int = 5000
    high_occupancy: float = 80
    moderate_occupancy: float = 60
    excellent: float = 4
    good: float = 3


def referrals_by(referrals: DataFrame, side: str, name: str) -> DataFrame:
    return referrals.groupBy(F.col(side).alias("hospital_id")).agg(rows(name))


def mart_hospital(
    tables: Tables, created_at: Clock | None = None, limits: HospitalThresholds = HospitalThresholds()
) -> DataFrame:
    """Capacity, activity, revenue, satisfaction and referrals of each hospital."""
    key = ["hospital_id"]
    visits = (
        tables["visit"]
        .groupBy("hospital_id")
        .agg(
            *visit_activity(),
            F.count_distinct("patient_id").alias("patients"),
            F.count_distinct("doctor_id").alias("doctors"),
        )
    )
    departments = (
        tables["department"]
        .groupBy("hospital_id")
        .agg(rows("total_departments"), rows_where(is_("department_name", "Emergency"), "emergency_departments"))
    )
    joined = feed(
        tables["hospital"],
        [
            (visits, key),
            (beds_by(tables["bed"], "hospital_id"), key),
            (latest_icu(tables["icu_status"]), key),
            (departments, key),
            (feedback_by(tables["patient_feedback"], "hospital_id"), key),
            (referrals_by(tables["referral"], "from_hospital_id", "referrals_sent"), key),
            (referrals_by(tables["referral"], "to_hospital_id", "referrals_received"), key),
        ],
    )
    occupancy = safe_divide(F.col("beds_occupied") * 100.0, "total_beds")
    result = joined.select(
        "hospital_id",
        "hospital_name",
        "hospital_type",
        "governorate",
        "district",
        "manager_name",
        "total_beds",
        "icu_capacity",
        *zeros(
            beds_in_system="beds_tracked",
            current_available_beds="beds_available",
            current_occupied_beds="beds_occupied",
        ),
        percent_when_positive("beds_occupied", "total_beds").alias("bed_occupancy_rate_pct"),
        *zeros(
            icu_beds_tracked="icu_beds",
            standard_beds_tracked="standard_beds",
            latest_icu_occupied="icu_occupied",
            latest_icu_available="icu_available",
        ),
        percent_when_positive("icu_occupied", "icu_capacity").alias("icu_occupancy_rate_pct"),
        F.col("icu_time").alias("latest_icu_update"),
        *zeros("total_departments"),
        F.when(F.col("emergency_departments") > 0, "Yes").otherwise("No").alias("has_emergency_department"),
        *zeros("total_visits", "outpatient_visits", "inpatient_visits", "followup_visits"),
        *zeros(unique_patients_served="patients", unique_doctors_count="doctors"),
        *money(avg_waiting_time_minutes="avg_wait"),
        "first_visit_date",
        "last_visit_date",
        *money(total_revenue="amount", avg_revenue_per_visit="avg_amount"),
        ratio_when_positive("amount", "total_visits").alias("revenue_per_visit"),
        *zeros("feedback_count"),
        *money(avg_patient_rating="avg_rating"),
        "min_rating",
        "max_rating",
        *zeros("positive_feedback_count", "negative_feedback_count"),
        percent_when_positive("positive_feedback_count", "feedback_count").alias("positive_feedback_rate_pct"),
        *zeros("referrals_sent", "referrals_received"),
        high_medium_low(
            "total_visits",
            limits.high_volume,
            limits.medium_volume,
            ("High Volume", "Medium Volume", "Low Volume"),
            "No Activity",
        ).alias("volume_category"),
        high_medium_low(
            occupancy,
            limits.high_occupancy,
            limits.moderate_occupancy,
            ("High Occupancy", "Moderate Occupancy", "Low Occupancy"),
            "Unknown",
        ).alias("occupancy_category"),
        band(
            "avg_rating",
            [(">=", limits.excellent, "Excellent"), (">=", limits.good, "Good"), ("<", limits.good, "Needs Improvement")],
            "No Rating",
        ).alias("satisfaction_category"),
    )
    return finished(result, created_at)


def summary_hospital(mart: DataFrame) -> DataFrame:
    return (
        mart.groupBy("hospital_type", "volume_category", "satisfaction_category")
        .agg(
            rows("total_hospitals"),
            round2(F.avg("total_visits")).alias("avg_visits_per_hospital"),
            round2(F.avg("bed_occupancy_rate_pct")).alias("avg_bed_occupancy_pct"),
            round2(F.avg("icu_occupancy_rate_pct")).alias("avg_icu_occupancy_pct"),
            round2(F.avg("avg_patient_rating")).alias("avg_rating"),
            round2(F.avg("total_revenue")).alias("avg_revenue_per_hospital"),
            round2(F.avg("avg_waiting_time_minutes")).alias("avg_wait_time"),
        )
        .orderBy("hospital_type", "volume_category", "satisfaction_category")
    )


def topk_hospital(mart: DataFrame, k: int = 10) -> DataFrame:
    columns = [
        "hospital_name",
        "hospital_type",
        "total_visits",
        "bed_occupancy_rate_pct",
        "icu_occupancy_rate_pct",
        "avg_patient_rating",
        "total_revenue",
        "volume_category",
        "satisfaction_category",
    ]
    return top(mart, columns, [F.desc("total_visits"), F.asc("hospital_id")], k)
