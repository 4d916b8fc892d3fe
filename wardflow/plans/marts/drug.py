from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.functions.expressions import Clock, as_date, high_medium_low, round2, rounded_or_zero, safe_divide
from wardflow.operators.joins import feed
from wardflow.plans.marts.common import Tables, finished, is_, money, rows, rows_where, top, zeros


@dataclass(frozen=True)
class DrugThresholds:
    high_demand: int = 1000
    medium_demand: int = 500
    expiring_days: int = 30
    shelf_days: int = 90


def prescribed_by_drug(items: DataFrame) -> DataFrame:
    return items.groupBy("drug_id").agg(
        rows("prescribed_items"),
        F.count_distinct("prescription_id").alias("prescriptions"),
        F.sum("quantity").alias("prescribed_quantity"),
        F.avg("quantity").alias("avg_quantity"),
        F.avg("duration_days").alias("avg_days"),
        rows_where(is_("frequency", "Once Daily"), "once_daily"),
        rows_where(is_("frequency", "Twice Daily"), "twice_daily"),
        rows_where(is_("frequency", "Three Times Daily"), "thrice_daily"),
    )


def stock_by_drug(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("drug_id").agg(
        F.count_distinct("hospital_id").alias("stocking_hospitals"),
        F.sum("quantity_available").alias("stock"),
        F.avg("quantity_available").alias("avg_stock"),
        F.sum("reorder_level").alias("reorder"),
        F.avg("reorder_level").alias("avg_reorder"),
        F.min("expiration_date").alias("earliest_expiration_date"),
        F.max("expiration_date").alias("latest_expiration_date"),
        rows_where(F.col("quantity_available") < F.col("reorder_level"), "low_stock"),
    )


def moves_by_drug(transactions: DataFrame) -> DataFrame:
    def moved(kind: str, name: str):
        return F.sum(F.when(is_("transaction_type", kind), F.col("quantity")).otherwise(0)).alias(name)

    return transactions.groupBy("drug_id").agg(
        rows("moves"),
        rows_where(is_("transaction_type", "Purchase"), "purchases"),
        rows_where(is_("transaction_type", "Dispensing"), "dispensings"),
        moved("Purchase", "purchased"),
        moved("Dispensing", "dispensed"),
        F.min("transaction_date").alias("first_transaction_date"),
        F.max("transaction_date").alias("last_transaction_date"),
    )


def mart_drug(
    tables: Tables, as_of: Clock, created_at: Clock | None = None, limits: DrugThresholds = DrugThresholds()
) -> DataFrame:
    """Prescribing, stock and movement of each drug; expiry is judged on ``as_of``."""
    joined = feed(
        tables["drug"],
        [
            (prescribed_by_drug(tables["prescription_items"]), ["drug_id"]),
            (stock_by_drug(tables["drug_inventory"]), ["drug_id"]),
            (moves_by_drug(tables["drug_transaction"]), ["drug_id"]),
        ],
    )
    stock, reorder = F.col("stock"), F.col("reorder")
    dispensed, purchased = F.col("dispensed"), F.col("purchased")
    days_left = F.datediff("earliest_expiration_date", as_date(as_of))
    result = joined.select(
        "drug_id",
        "drug_name",
        "generic_name",
        "manufacturer",
        "drug_category",
        round2("unit_amount").alias("unit_price"),
        *zeros(
            total_prescriptions="prescribed_items",
            unique_prescriptions="prescriptions",
            total_quantity_prescribed="prescribed_quantity",
        ),
        *money(avg_quantity_per_prescription="avg_quantity", avg_treatment_duration_days="avg_days"),
        *zeros(
            once_daily_prescriptions="once_daily",
            twice_daily_prescriptions="twice_daily",
            thrice_daily_prescriptions="thrice_daily",
            hospitals_stocking_drug="stocking_hospitals",
            current_stock_quantity="stock",
        ),
        *money(avg_stock_per_hospital="avg_stock"),
        *zeros(total_reorder_level="reorder"),
        *money(avg_reorder_level="avg_reorder"),
        "earliest_expiration_date",
        "latest_expiration_date",
        *zeros(
            low_stock_locations="low_stock",
            total_transactions="moves",
            purchase_transactions="purchases",
            dispensing_transactions="dispensings",
            total_purchased_quantity="purchased",
            total_dispensed_quantity="dispensed",
        ),
        "first_transaction_date",
        "last_transaction_date",
        rounded_or_zero(F.col("prescribed_quantity") * F.col("unit_amount")).alias("total_prescription_value"),
        rounded_or_zero(stock * F.col("unit_amount")).alias("current_inventory_value"),
        F.when((dispensed > 0) & (stock > 0), round2(safe_divide(dispensed * 100.0, dispensed + stock)))
        .otherwise(F.lit(0.0))
        .alias("utilization_rate_pct"),
        F.when((purchased > 0) & (dispensed > 0), round2(safe_divide(dispensed * 100.0, purchased)))
        .otherwise(F.lit(0.0))
        .alias("turnover_rate_pct"),
        high_medium_low(
            "prescribed_items",
            limits.high_demand,
            limits.medium_demand,
            ("High Demand", "Medium Demand", "Low Demand"),
            "No Demand",
        ).alias("demand_category"),
        F.when(F.col("low_stock") > 0, "Stock Alert")
        .when(stock < reorder, "Reorder Needed")
        .when(stock >= reorder, "Adequate Stock")
        .otherwise("Unknown")
        .alias("stock_status"),
        high_medium_low(
            days_left,
            limits.shelf_days,
            limits.expiring_days,
            ("Good Shelf Life", "Monitor Expiration", "Expiring Soon"),
            "Unknown",
        ).alias("expiration_status"),
    )
    return finished(result, created_at)


def summary_drug(mart: DataFrame) -> DataFrame:
    return (
        mart.groupBy("drug_category", "demand_category")
        .agg(
            rows("total_drugs"),
            round2(F.avg("total_prescriptions")).alias("avg_prescriptions"),
            round2(F.avg("current_stock_quantity")).alias("avg_stock"),
            round2(F.sum("total_prescription_value")).alias("total_prescription_value"),
            round2(F.sum("current_inventory_value")).alias("total_inventory_value"),
            round2(F.avg("turnover_rate_pct")).alias("avg_turnover_rate"),
            rows_where(is_("stock_status", "Stock Alert"), "drugs_with_stock_alert"),
        )
        .orderBy("drug_category", "demand_category")
    )


def topk_drug(mart: DataFrame, k: int = 10) -> DataFrame:
    columns = [
        "drug_name",
        "drug_category",
        "total_prescriptions",
        "current_stock_quantity",
        "total_prescription_value",
        "demand_category",
        "stock_status",
        "expiration_status",
    ]
    return top(mart, columns, [F.desc("total_prescriptions"), F.asc("drug_id")], k)
