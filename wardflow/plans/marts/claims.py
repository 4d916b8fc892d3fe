from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.functions.expressions import Clock, band, high_medium_low, percent_when_positive, round2
from wardflow.operators.joins import feed
from wardflow.plans.marts.common import Tables, finished, is_, money, rows, top, zeros


@dataclass(frozen=True)
class ClaimThresholds:
    high_value: float = 10000
    medium_value: float = 5000
    fast_days: int = 3
    normal_days: int = 7


def items_by_claim(items: DataFrame) -> DataFrame:
    return items.groupBy("claim_id").agg(
        rows("items"),
        F.count_distinct("procedure_code").alias("procedures"),
        F.count_distinct("drug_id").alias("drugs"),
        F.sum("item_amount").alias("items_amount"),
        F.sum("item_quantity").alias("items_quantity"),
    )


def mart_claims(
    tables: Tables, created_at: Clock | None = None, limits: ClaimThresholds = ClaimThresholds()
) -> DataFrame:
    """Claims with their reviews (one row per review), items, visit and hospital."""
    reviews = tables["claim_approval"].select(
        "claim_id", "reviewed_by", "approval_status", "approval_date", "rejection_reason"
    )
    joined = feed(
        tables["claim"],
        [
            (items_by_claim(tables["claim_items"]), ["claim_id"]),
            (reviews, ["claim_id"]),
            (tables["visit"].select("visit_id", "visit_type", "diagnosis_code", "symptoms"), ["visit_id"]),
            (
                tables["hospital"].select("hospital_id", "hospital_name", "hospital_type", "governorate"),
                ["hospital_id"],
            ),
        ],
    )
    amount, approved = F.col("claim_amount"), F.col("approved_amount")
    denied = amount - approved
    days = F.datediff("approval_date", "claim_date")
    approved_claim = is_("claim_status", "Approved")
    result = joined.select(
        "claim_id",
        "patient_id",
        "visit_id",
        "hospital_id",
        "hospital_name",
        "hospital_type",
        "governorate",
        "claim_date",
        F.year("claim_date").alias("claim_year"),
        F.month("claim_date").alias("claim_month"),
        F.quarter("claim_date").alias("claim_quarter"),
        "visit_type",
        "diagnosis_code",
        "symptoms",
        round2(amount).alias("claim_amount"),
        round2(approved).alias("approved_amount"),
        round2(denied).alias("denied_amount"),
        "claim_status",
        percent_when_positive(approved, amount).alias("approval_rate_pct"),
        percent_when_positive(denied, amount).alias("denial_rate_pct"),
        "reviewed_by",
        "approval_status",
        "approval_date",
        "rejection_reason",
        F.coalesce(days, F.lit(0)).alias("approval_turnaround_days"),
        *zeros(total_claim_items="items", procedures_in_claim="procedures", drugs_in_claim="drugs"),
        *money(total_items_amount="items_amount"),
        *zeros(total_items_quantity="items_quantity"),
        high_medium_low(
            amount, limits.high_value, limits.medium_value, ("High Value", "Medium Value", "Low Value"), "Unknown"
        ).alias("claim_value_category"),
        F.when(approved_claim & (approved == amount), "Fully Approved")
        .when(approved_claim & (approved < amount), "Partially Approved")
        .when(is_("claim_status", "Rejected"), "Rejected")
        .otherwise("Unknown")
        .alias("approval_category"),
        band(
            days,
            [
                ("<=", limits.fast_days, "Fast Processing"),
                ("<=", limits.normal_days, "Normal Processing"),
                (">", limits.normal_days, "Slow Processing"),
            ],
            "Unknown",
        ).alias("processing_speed_category"),
    )
    return finished(result, created_at)


def summary_claims(mart: DataFrame) -> DataFrame:
    return (
        mart.groupBy("claim_status", "claim_value_category")
        .agg(
            F.count_distinct("claim_id").alias("total_claims"),
            round2(F.avg("claim_amount")).alias("avg_claim_amount"),
            round2(F.avg("approved_amount")).alias("avg_approved_amount"),
            round2(F.avg("approval_rate_pct")).alias("avg_approval_rate"),
            round2(F.avg("approval_turnaround_days")).alias("avg_turnaround_days"),
            round2(F.sum("claim_amount")).alias("total_claim_amount"),
            round2(F.sum("approved_amount")).alias("total_approved_amount"),
        )
        .orderBy("claim_status", "claim_value_category")
    )


def topk_claims(mart: DataFrame, k: int = 10) -> DataFrame:
    columns = [
        "claim_id",
        "hospital_name",
        "claim_date",
        "visit_type",
        "claim_amount",
        "approved_amount",
        "claim_status",
        "approval_rate_pct",
        "approval_turnaround_days",
        "claim_value_category",
    ]
    return top(mart, columns, [F.desc("claim_date"), F.asc("claim_id"), F.asc("approval_date")], k)
