"""Date, type-1 and type-2 dimensions of the star schema."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.functions.expressions import Clock, as_date, as_timestamp, band, date_key, flag
from wardflow.operators.joins import current_members
from wardflow.operators.scd import dimension_schema, scd1, scd2_apply, scd2_first_load
from wardflow.sinks.history import load_history
from wardflow.sinks.store import TableStore
from wardflow.sources.rows import date_spine

# Default range of the date dimension.
FIRST_DAY, LAST_DAY = "2024-01-01", "2026-12-31"

# Season by month.
SEASONS = {"Winter": (12, 1, 2), "Spring": (3, 4, 5), "Summer": (6, 7, 8), "Autumn": (9, 10, 11)}


def season_of(month: Column) -> Column:
    names = list(SEASONS)
    label = F.when(month.isin(*SEASONS[names[0]]), names[0])
    for name in names[1:]:
        label = label.when(month.isin(*SEASONS[name]), name)
    return label


def dim_date(
    spark: SparkSession,
    start: Clock | Column = FIRST_DAY,
    end: Clock | Column = LAST_DAY,
    as_of: Clock | None = None,
    bounds: DataFrame | None = None,
) -> DataFrame:
    """One row per day; weekdays count from Monday = 1, Saturday and Sunday are the weekend."""
    day = F.col("full_date")
    weekday = F.weekday(day) + 1
    calendar = date_spine(spark, start, end, bounds).select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week"),
        F.dayofmonth(day).alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        flag(weekday >= 6).alias("is_weekend"),
        season_of(F.month(day)).alias("season"),
    )
    if as_of is None:
        return calendar
    return calendar.withColumns({"dwh_created_at": as_timestamp(as_of), "dwh_updated_at": as_timestamp(as_of)})


def dim_diagnosis(diagnosis: DataFrame, as_of: Clock) -> DataFrame:
    columns = ["diagnosis_code", "diagnosis_name", "diagnosis_category", "severity_level"]
    return scd1(diagnosis, "diagnosis_key", ["diagnosis_code"], columns, as_of)


def dim_procedure(medical_procedure: DataFrame, as_of: Clock) -> DataFrame:
    columns = ["procedure_code", "procedure_name", "procedure_category", "expected_amount", "complexity_score"]
    return scd1(medical_procedure, "procedure_key", ["procedure_code"], columns, as_of)


def dim_claim_status(claim_approval: DataFrame, as_of: Clock) -> DataFrame:
    """One member per (status, reason, reviewer) that occurs; a missing reason sorts as empty text."""
    combinations = claim_approval.select(
        F.col("approval_status").alias("claim_status"), "rejection_reason", "reviewed_by"
    ).distinct()
    ordered = combinations.withColumn("reason_order", F.coalesce("rejection_reason", F.lit("")))
    columns = ["claim_status", "rejection_reason", "reviewed_by"]
    keyed = scd1(
        ordered,
        "claim_status_key",
        ["claim_status", "reason_order", "rejection_reason", "reviewed_by"],
        [*columns, "reason_order"],
        as_of,
    )
    return keyed.drop("reason_order")


# Type-2 dimensions --------------------------------------------------------------


def stage_patient(silver: Mapping[str, DataFrame], dims: Mapping[str, DataFrame], as_of: Clock) -> DataFrame:
    age = F.datediff(as_date(as_of), F.col("birth_date")) / F.lit(365.25)
    # An unknown birth date is in neither young group.
    group = band(age, [("<", 18.0, "Child"), ("<", 60.0, "Adult")], "Senior")
    return silver["patient"].withColumn("age_group", group)


def _as_is(table: str) -> Callable[[Mapping[str, DataFrame], Mapping[str, DataFrame], Clock], DataFrame]:
    return lambda silver, dims, as_of: silver[table]


def stage_drug(silver: Mapping[str, DataFrame], dims: Mapping[str, DataFrame], as_of: Clock) -> DataFrame:
    return silver["drug"].withColumnRenamed("unit_amount", "unit_price")


def stage_department(silver: Mapping[str, DataFrame], dims: Mapping[str, DataFrame], as_of: Clock) -> DataFrame:
    hospitals = current_members(dims["hospital"], "hospital_id", "hospital_key")
    return silver["department"].join(hospitals, "hospital_id")


def stage_doctor(silver: Mapping[str, DataFrame], dims: Mapping[str, DataFrame], as_of: Clock) -> DataFrame:
    hospitals = current_members(dims["hospital"], "hospital_id", "hospital_key")
    departments = current_members(dims["department"], "department_id", "department_key")
    return silver["doctor"].join(hospitals, "hospital_id").join(departments, "department_id")


@dataclass(frozen=True)
class Dimension:
    surrogate: str
    key: str
    columns: str
    tracked: tuple[str, ...]
    stage: Callable[[Mapping[str, DataFrame], Mapping[str, DataFrame], Clock], DataFrame]

    @property
    def schema(self) -> T.StructType:
        return dimension_schema(self.surrogate, self.columns)


# In load order: a dimension comes after those whose keys it carries.
DIMENSIONS: dict[str, Dimension] = {
    "patient": Dimension(
        "patient_key",
        "patient_id",
        "patient_id string, national_id string, patient_name string, gender string, birth_date date, "
        "age_group string, patient_phone string, street string, city string, governorate string, "
        "blood_type string, emergency_contact string",
        ("patient_phone", "street", "city", "emergency_contact"),
        stage_patient,
    ),
    "hospital": Dimension(
        "hospital_key",
        "hospital_id",
        "hospital_id string, hospital_name string, hospital_type string, governorate string, district string, "
        "hospital_phone string, total_beds int, icu_capacity int, latitude decimal(9,6), longitude decimal(9,6), "
        "manager_name string, manager_email string, manager_phone string",
        ("total_beds", "icu_capacity", "hospital_type", "manager_name"),
        _as_is("hospital"),
    ),
    "department": Dimension(
        "department_key",
        "department_id",
        "department_id string, department_name string, floor_number int, hospital_key bigint",
        ("department_name", "floor_number", "hospital_key"),
        stage_department,
    ),
    "doctor": Dimension(
        "doctor_key",
        "doctor_id",
        "doctor_id string, doctor_name string, specialty string, years_experience int, doctor_phone string, "
        "employment_status string, hospital_key bigint, department_key bigint",
        ("department_key", "hospital_key", "employment_status", "specialty"),
        stage_doctor,
    ),
    "drug": Dimension(
        "drug_key",
        "drug_id",
        "drug_id string, drug_name string, generic_name string, manufacturer string, drug_category string, "
        "unit_price decimal(8,2)",
        ("unit_price", "drug_category", "manufacturer"),
        stage_drug,
    ),
}


def publish_dimension(
    store: TableStore,
    name: str,
    silver: Mapping[str, DataFrame],
    dims: Mapping[str, DataFrame],
    as_of: Clock,
    same_day: str = "replace",
) -> DataFrame:
    """Load one type-2 dimension into its table; history that was closed before is left as it is."""
    spec = DIMENSIONS[name]
    business = [f.name for f in T.StructType.fromDDL(spec.columns).fields]
    source = spec.stage(silver, dims, as_of).select(*business)
    return load_history(store, f"dim_{name}", source, spec.schema, spec.surrogate, spec.key, spec.tracked, as_of, same_day)


def load_dimension(
    name: str,
    silver: Mapping[str, DataFrame],
    dims: Mapping[str, DataFrame],
    as_of: Clock,
    target: DataFrame | None = None,
    same_day: str = "replace",
) -> DataFrame:
    """Next state of one type-2 dimension; ``target`` is its state before, if any."""
    spec = DIMENSIONS[name]
    business = [f.name for f in T.StructType.fromDDL(spec.columns).fields]
    source = spec.stage(silver, dims, as_of).select(*business)
    if target is None:
        return scd2_first_load(source, spec.schema, spec.surrogate, spec.key, as_of)
    return scd2_apply(target, source, spec.surrogate, spec.key, spec.tracked, as_of, same_day)
