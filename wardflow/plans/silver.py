"""The 22 cleaned tables as one table of steps and one runner."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from wardflow.functions.expressions import Clock
from wardflow.operators import cleaning as c
from wardflow.operators.joins import remove_few_duplicates


@dataclass(frozen=True)
class Recipe:
    """How one raw table is cleaned.

    ``steps``: D one row per key, T trim, S fill strings, N fill numbers,
    B blank text in ``dates`` (columns that a source may deliver as text). ``references`` are foreign keys that keep their NULLs, so that
    later IS NOT NULL tests and distinct counts stay right; ``pending`` are
    amounts whose NULL means "not decided yet".
    """

    source: str
    key: str
    steps: str
    references: tuple[str, ...] = ()
    pending: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()
    before: tuple[Callable[[DataFrame], DataFrame], ...] = ()
    after: tuple[Callable[[DataFrame, Clock], DataFrame], ...] = field(default=())


def _doctor_names(df: DataFrame) -> DataFrame:
    named = c.concat_columns(c.rename(df, {"phone": "doctor_phone"}), {"doctor_name": ["first_name", "last_name"]})
    return named.drop("first_name", "last_name")


def _patient_names(df: DataFrame) -> DataFrame:
    return c.full_name(c.rename(df, {"phone": "patient_phone"}), "patient_name", ["first_name", "last_name"])


def _patient_contacts(df: DataFrame, as_of: Clock) -> DataFrame:
    phones = ["patient_phone", "emergency_contact"]
    return c.format_phones(c.restore_leading_zero(c.add_age(df, as_of), phones), phones)


def _department_contacts(df: DataFrame, as_of: Clock) -> DataFrame:
    phoned = c.format_phones(c.restore_leading_zero(df, ["manager_phone"]), ["manager_phone"])
    return c.cast(phoned, {"floor_number": "int"})


def _hospital_phones(df: DataFrame, as_of: Clock) -> DataFrame:
    return c.format_phones(df, ["manager_phone", "hospital_phone"])


RECIPES: dict[str, Recipe] = {
    "bed": Recipe("bed", "bed_id", "DTS", references=("hospital_id", "department_id")),
    "claim": Recipe(
        "claim",
        "claim_id",
        "DTNSB",
        references=("patient_id", "visit_id", "hospital_id"),
        pending=("approved_amount",),
        dates=("claim_date",),
    ),
    "claim_approval": Recipe("claim_approval", "approval_id", "DSNB", references=("claim_id",), dates=("approval_date",)),
    "claim_items": Recipe(
        "claim_item",
        "claim_item_id",
        "DSN",
        references=("claim_id", "procedure_code", "drug_id"),
        before=(lambda df: c.rename(df, {"quantity": "item_quantity"}),),
    ),
    "department": Recipe(
        "department", "department_id", "DTSN", references=("hospital_id",), after=(_department_contacts,)
    ),
    "diagnosis": Recipe("diagnosis", "diagnosis_code", "DTS"),
    "doctor": Recipe(
        "doctor", "doctor_id", "DTS", references=("hospital_id", "department_id"), before=(_doctor_names,)
    ),
    "doctor_schedule": Recipe("doctor_schedule", "schedule_id", "DSB", references=("doctor_id",), dates=("shift_date",)),
    "drug": Recipe("drug", "drug_id", "DTSN"),
    "drug_inventory": Recipe("drug_inventory", "inventory_id", "DTSNB", references=("hospital_id", "drug_id"), dates=("expiration_date",)),
    "drug_transaction": Recipe("drug_transaction", "transaction_id", "DTSNB", references=("hospital_id", "drug_id"), dates=("transaction_date",)),
    "hospital": Recipe(
        "hospital",
        "hospital_id",
        "DTS",
        before=(lambda df: c.rename(df, {"phone": "hospital_phone"}),),
        after=(_hospital_phones,),
    ),
    "icu_status": Recipe("icu_status", "icu_status_id", "DTSN", references=("hospital_id",)),
    "medical_procedure": Recipe("medical_procedure", "procedure_code", "DTSN"),
    "medical_record": Recipe("medical_record", "record_id", "DTSB", references=("patient_id",), dates=("record_date",)),
    "patient": Recipe("patient", "patient_id", "DTS", before=(_patient_names,), after=(_patient_contacts,)),
    "patient_feedback": Recipe(
        "patient_feedback", "feedback_id", "DTS", references=("patient_id", "hospital_id", "doctor_id")
    ),
    "prescription": Recipe("prescription", "prescription_id", "DTSB", references=("visit_id",), dates=("prescription_date",)),
    "prescription_items": Recipe(
        "prescription_item", "prescription_item_id", "DTS", references=("prescription_id", "drug_id")
    ),
    "referral": Recipe(
        "referral", "referral_id", "DTSB", references=("patient_id", "from_hospital_id", "to_hospital_id"), dates=("referral_date",)
    ),
    "visit": Recipe(
        "visit",
        "visit_id",
        "DTSNB",
        references=("patient_id", "doctor_id", "hospital_id", "department_id", "diagnosis_code"),
        dates=("visit_date",),
    ),
    "visit_procedure": Recipe(
        "visit_procedure", "visit_procedure_id", "DTSNB", references=("visit_id", "procedure_code"), dates=("procedure_date",)
    ),
}


def clean_table(
    raw: DataFrame,
    name: str,
    as_of: Clock,
    overrides: Mapping[str, DataFrame] | None = None,
    fill_everything: bool = False,
    few_repeats: bool = False,
) -> DataFrame:
    """Run one recipe.

    ``overrides`` maps a key column to a correction table that is applied last,
    after formatting (hospital contacts by manager and by hospital).
    ``fill_everything`` drops the exemptions for foreign keys and pending amounts
    and fills every NULL string and number. ``few_repeats`` looks for repeated keys first,
    by a job of its own, and spares all other rows the shuffle.
    """
    recipe = RECIPES[name]
    kept = () if fill_everything else recipe.references + recipe.pending
    df = raw
    for prepare in recipe.before:
        df = prepare(df)
    if "D" in recipe.steps:
        df = (remove_few_duplicates if few_repeats else c.remove_duplicates)(df, [recipe.key])
    # Trimming and filling touch each column on its own, so they share one projection.
    df = c.tidy(
        df,
        trim="T" in recipe.steps,
        text=c.UNKNOWN if "S" in recipe.steps else None,
        number=0 if "N" in recipe.steps else None,
        exclude=kept,
    )
    if "B" in recipe.steps:
        df = c.blank_dates_to_null(df, recipe.dates)
    for finish in recipe.after:
        df = finish(df, as_of)
    for key, table in (overrides or {}).items():
        df = c.apply_overrides(df, table, key, [col for col in table.columns if col != key])
    return df
