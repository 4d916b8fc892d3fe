from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.functions.expressions import (
    Clock,
    percent_when_positive,
    ratio_when_positive,
    round2,
    rounded_or_zero,
)
from wardflow.operators.joins import feed
from wardflow.plans.marts.common import Tables, finished, money, rows, top, zeros


def mart_financial(tables: Tables, created_at: Clock | None = None) -> DataFrame:
    """Revenue per hospital, day, visit type and department.

    Procedure and claim figures exist per hospital and day only and are repeated
    on each row of that day; ``summary_financial`` counts them once.
    """
    day = ["hospital_id", "transaction_date"]
    visits = (
        tables["visit"]
        .groupBy("hospital_id", F.col("visit_date").alias("transaction_date"), "visit_type", "department_id")
        .agg(rows("visits"), F.sum("total_amount").alias("visit_revenue"))
    )
    procedures = (
        tables["visit_procedure"]
        .select("visit_id", F.col("procedure_date").alias("transaction_date"), "procedure_amount")
        .join(tables["visit"].select("visit_id", "hospital_id"), "visit_id")
        .groupBy(*day)
        .agg(rows("procedures"), F.sum("procedure_amount").alias("procedure_revenue"))
    )
    claims = (
        tables["claim"]
        .groupBy("hospital_id", F.col("claim_date").alias("transaction_date"))
        .agg(
            rows("claims"),
            F.sum("claim_amount").alias("claimed"),
            F.sum("approved_amount").alias("approved"),
            F.sum(F.col("claim_amount") - F.col("approved_amount")).alias("denied"),
        )
    )
    joined = feed(
        visits,
        [
            (procedures, day),
            (claims, day),
            (
                tables["hospital"].select("hospital_id", "hospital_name", "hospital_type", "governorate"),
                ["hospital_id"],
            ),
            (
                tables["department"].select("department_id", "hospital_id", "department_name"),
                ["department_id", "hospital_id"],
            ),
        ],
    )
    earned = F.coalesce("visit_revenue", F.lit(0.0)) + F.coalesce("procedure_revenue", F.lit(0.0))
    result = joined.select(
        "hospital_id",
        "hospital_name",
        "hospital_type",
        "governorate",
        "transaction_date",
        F.year("transaction_date").alias("revenue_year"),
        F.month("transaction_date").alias("revenue_month"),
        F.quarter("transaction_date").alias("revenue_quarter"),
        "visit_type",
        "department_id",
        "department_name",
        *zeros(visit_count="visits"),
        *money(total_visit_revenue="visit_revenue"),
        *zeros(procedure_count="procedures"),
        *money(total_procedure_revenue="procedure_revenue"),
        *zeros(claim_count="claims"),
        *money(total_claimed_amount="claimed", total_approved_amount="approved", total_denied_amount="denied"),
        rounded_or_zero(earned).alias("total_revenue"),
        percent_when_positive("approved", "claimed").alias("reimbursement_rate_pct"),
        rounded_or_zero(earned - F.coalesce("approved", F.lit(0.0))).alias("net_revenue_after_claims"),
        ratio_when_positive("visit_revenue", "visits").alias("avg_revenue_per_visit"),
        ratio_when_positive("procedure_revenue", "procedures").alias("avg_revenue_per_procedure"),
        ratio_when_positive("approved", "claims").alias("avg_approved_per_claim"),
    )
    return finished(result, created_at)


def summary_financial(mart: DataFrame, repeat_daily_figures: bool = False) -> DataFrame:
    """Quarterly totals per hospital.

    Procedure and claim figures of a hospital-day count once. With
    ``repeat_daily_figures`` they are added for every department and visit type
    row, which over-counts them.
    """
    group = ["hospital_name", "hospital_type", "revenue_year", "revenue_quarter"]
    if repeat_daily_figures:
        daily = mart.withColumnsRenamed({"total_claimed_amount": "claimed", "total_approved_amount": "approved"})
        daily = daily.withColumnsRenamed({"total_revenue": "revenue", "net_revenue_after_claims": "net"})
    else:
        once = [("total_procedure_revenue", "procedures"), ("total_claimed_amount", "claimed")]
        once += [("total_approved_amount", "approved"), ("reimbursement_rate_pct", "reimbursement_rate_pct")]
        daily = (
            mart.groupBy("hospital_id", "transaction_date", *group)
            .agg(
                F.sum("visit_count").alias("visit_count"),
                F.sum("total_visit_revenue").alias("visits"),
                *[F.max(old).alias(new) for old, new in once],
            )
            .withColumn("revenue", F.col("visits") + F.col("procedures"))
            .withColumn("net", F.col("revenue") - F.col("approved"))
        )
    return (
        daily.groupBy(*group)
        .agg(
            F.sum("visit_count").alias("total_visits"),
            round2(F.sum("revenue")).alias("total_revenue"),
            round2(F.sum("claimed")).alias("total_claimed"),
            round2(F.sum("approved")).alias("total_approved"),
            round2(F.avg("reimbursement_rate_pct")).alias("avg_reimbursement_rate"),
            round2(F.sum("net")).alias("net_revenue"),
        )
        .orderBy(F.desc("revenue_year"), F.desc("revenue_quarter"), F.desc("total_revenue"), "hospital_name")
    )


def topk_financial(mart: DataFrame, k: int = 10) -> DataFrame:
    columns = [
        "hospital_name",
        "transaction_date",
        "visit_type",
        "department_name",
        "visit_count",
        "total_revenue",
        "reimbursement_rate_pct",
        "net_revenue_after_claims",
    ]
    order = [F.desc("transaction_date"), F.desc("total_revenue")]
    return top(mart, columns, [*order, F.asc("hospital_id"), F.asc("visit_type"), F.asc("department_id")], k)
