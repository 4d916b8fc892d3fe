from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.functions.expressions import Clock, band, high_medium_low, percent_when_positive, round2
from wardflow.operators.joins import feed
from wardflow.plans.marts.common import Tables, feedback_by, finished, money, rows, top, visit_activity, zeros


@dataclass(frozen=True)
class DoctorThresholds:
    heavy: int = 100
    medium: int = 50
    strong: float = 4
    average: float = 3


def mart_doctor(
    tables: Tables, created_at: Clock | None = None, limits: DoctorThresholds = DoctorThresholds()
) -> DataFrame:
    """Visits, revenue, ratings and shifts of each doctor."""
    visits = (
        tables["visit"]
        .groupBy("doctor_id")
        .agg(
            *visit_activity(),
            F.count_distinct("patient_id").alias("patients"),
            F.count_distinct("diagnosis_code").alias("diagnoses"),
        )
    )
    shifts = (
        tables["doctor_schedule"]
        .groupBy("doctor_id")
        .agg(
            rows("total_shifts"),
            F.count_distinct("shift_date").alias("days_scheduled"),
            F.min("shift_date").alias("first_shift_date"),
            F.max("shift_date").alias("last_shift_date"),
        )
    )
    joined = feed(
        tables["doctor"],
        [
            (tables["hospital"].select("hospital_id", "hospital_name", "hospital_type"), ["hospital_id"]),
            (tables["department"].select("department_id", "department_name"), ["department_id"]),
            (visits, ["doctor_id"]),
            (feedback_by(tables["patient_feedback"], "doctor_id"), ["doctor_id"]),
            (shifts, ["doctor_id"]),
        ],
    )
    result = joined.select(
        "doctor_id",
        "doctor_name",
        "hospital_id",
        "hospital_name",
        "hospital_type",
        "department_id",
        "department_name",
        "specialty",
        "years_experience",
        "employment_status",
        *zeros("total_visits", "outpatient_visits", "inpatient_visits", "followup_visits"),
        *zeros(unique_patients_treated="patients"),
        *money(avg_waiting_time_minutes="avg_wait"),
        "first_visit_date",
        "last_visit_date",
        *zeros(unique_diagnoses_handled="diagnoses"),
        *money(total_revenue="amount", avg_revenue_per_visit="avg_amount"),
        *zeros("feedback_count"),
        *money(avg_patient_rating="avg_rating"),
        "min_rating",
        "max_rating",
        *zeros("positive_feedback_count", "negative_feedback_count"),
        percent_when_positive("positive_feedback_count", "feedback_count").alias("positive_feedback_rate_pct"),
        *zeros("total_shifts", "days_scheduled"),
        "first_shift_date",
        "last_shift_date",
        high_medium_low(
            "total_visits",
            limits.heavy,
            limits.medium,
            ("High Workload", "Medium Workload", "Low Workload"),
            "No Visits",
        ).alias("workload_category"),
        band(
            "avg_rating",
            [
                (">=", limits.strong, "High Performance"),
                (">=", limits.average, "Average Performance"),
                ("<", limits.average, "Needs Improvement"),
            ],
            "No Rating",
        ).alias("performance_category"),
    )
    return finished(result, created_at)


def summary_doctor(mart: DataFrame) -> DataFrame:
    return (
        mart.groupBy("specialty", "workload_category", "performance_category")
        .agg(
            rows("total_doctors"),
            round2(F.avg("total_visits")).alias("avg_visits_per_doctor"),
            round2(F.avg("unique_patients_treated")).alias("avg_patients_per_doctor"),
            round2(F.avg("avg_patient_rating")).alias("avg_rating"),
            round2(F.avg("total_revenue")).alias("avg_revenue_per_doctor"),
            round2(F.avg("avg_waiting_time_minutes")).alias("avg_wait_time"),
        )
        .orderBy("specialty", "workload_category", "performance_category")
    )


def topk_doctor(mart: DataFrame, k: int = 10) -> DataFrame:
    columns = [
        "doctor_name",
        "specialty",
        "hospital_name",
        "total_visits",
        "unique_patients_treated",
        "avg_patient_rating",
        "total_revenue",
        "workload_category",
        "performance_category",
    ]
    return top(mart, columns, [F.desc("total_visits"), F.asc("doctor_id")], k)
