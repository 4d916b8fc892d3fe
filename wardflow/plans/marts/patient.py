from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.functions.expressions import Clock, band, high_medium_low, round2, rounded_or_zero, safe_divide
from wardflow.operators.joins import feed
from wardflow.plans.marts.common import (
    Tables,
    feedback_by,
    finished,
    is_,
    money,
    rows,
    rows_where,
    visit_activity,
    zeros,
)


@dataclass(frozen=True)
class PatientThresholds:
    busy: int = 10
    regular: int = 5


# Age groups, first match wins; a missing age falls to the last one.
AGE_GROUPS = [
    ("<", 18, "Child (0-17)"),
    ("<=", 35, "Young Adult (18-35)"),
    ("<=", 55, "Middle Age (36-55)"),
    ("<=", 70, "Senior (56-70)"),
]
OLDEST = "Elderly (70+)"


def claims_by_patient(claims: DataFrame) -> DataFrame:
    return claims.groupBy("patient_id").agg(
        rows("total_claims"),
        rows_where(is_("claim_status", "Approved"), "approved_claims"),
        rows_where(is_("claim_status", "Rejected"), "rejected_claims"),
        F.sum("claim_amount").alias("claimed"),
        F.sum("approved_amount").alias("approved"),
        F.sum(F.col("claim_amount") - F.col("approved_amount")).alias("denied"),
        F.avg(safe_divide("approved_amount", "claim_amount")).alias("approval_share"),
    )


def mart_patient(
    tables: Tables, created_at: Clock | None = None, limits: PatientThresholds = PatientThresholds()
) -> DataFrame:
    """Patient profile with visits, cost, claims and satisfaction."""
    visits = (
        tables["visit"]
        .groupBy("patient_id")
        .agg(
            *visit_activity(),
            F.count_distinct("hospital_id").alias("hospitals_visited"),
            F.count_distinct("diagnosis_code").alias("unique_diagnoses"),
        )
    )
    joined = feed(
        tables["patient"],
        [
            (visits, ["patient_id"]),
            (claims_by_patient(tables["claim"]), ["patient_id"]),
            (feedback_by(tables["patient_feedback"], "patient_id"), ["patient_id"]),
        ],
    )
    result = joined.select(
        "patient_id",
        "patient_name",
        "gender",
        "birth_date",
        F.col("patient_age").alias("age"),
        band("patient_age", AGE_GROUPS, OLDEST).alias("age_group"),
        "blood_type",
        "governorate",
        "city",
        *zeros("total_visits", "outpatient_visits", "inpatient_visits", "followup_visits", "hospitals_visited"),
        *money(avg_waiting_time_minutes="avg_wait"),
        "first_visit_date",
        "last_visit_date",
        *zeros("unique_diagnoses"),
        *money(total_visit_cost="amount", avg_cost_per_visit="avg_amount"),
        *zeros("total_claims", "approved_claims", "rejected_claims"),
        *money(total_claimed_amount="claimed", total_approved_amount="approved", total_denied_amount="denied"),
        rounded_or_zero(F.col("approval_share") * 100).alias("claim_approval_rate_pct"),
        *zeros("feedback_count"),
        *money(avg_satisfaction_rating="avg_rating"),
        "min_rating",
        "max_rating",
        high_medium_low(
            "total_visits",
            limits.busy,
            limits.regular,
            ("High Utilization", "Medium Utilization", "Low Utilization"),
            "No Visits",
        ).alias("utilization_category"),
    )
    return finished(result, created_at)


def summary_patient(mart: DataFrame) -> DataFrame:
    return (
        mart.groupBy("age_group", "gender", "utilization_category")
        .agg(
            rows("total_patients"),
            rows("patient_count"),
            round2(F.avg("total_visits")).alias("avg_visits_per_patient"),
            round2(F.avg("total_visit_cost")).alias("avg_total_cost"),
            round2(F.avg("avg_satisfaction_rating")).alias("avg_satisfaction"),
            round2(F.avg("claim_approval_rate_pct")).alias("avg_claim_approval_rate"),
        )
        .orderBy("age_group", "gender", "utilization_category")
    )
