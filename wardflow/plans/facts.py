"""Staging queries of the three incremental facts.

Each returns one row per business id, so the result can be upserted and a rerun
changes nothing. ``silver`` and ``dims`` map table names to DataFrames.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.expressions import Clock, as_timestamp, date_key, earliest, flag, latest
from wardflow.operators import ledger
from wardflow.operators.joins import current_members, flag_existing, join_feeder, members_as_of
from wardflow.operators.ordering import stage
from wardflow.operators.watermark import after_watermark

Tables = Mapping[str, DataFrame]

UNKNOWN_MEMBER = -1
NEAR_EXPIRY_DAYS = 60
PENDING = "Pending Review"
LEAVES_STOCK = ("Dispensing", "Wastage", "Return")

# Declared columns of the claims fact; the last one only serves the watermark.
FACT_CLAIMS = (
    "claim_id string, visit_id string, date_key int, patient_key bigint, hospital_key bigint, "
    "procedure_code string, drug_key bigint, claim_status_key bigint, claim_amount double, "
    "approved_amount double, approval_gap double, days_to_decision int, item_count bigint, "
    "reviewed_by string, dwh_loaded_at timestamp, dwh_updated_at timestamp, claim_date date"
)

# What a decision may change on a claim that was loaded while pending.
CLAIM_DECISION_COLUMNS = (
    "approved_amount",
    "approval_gap",
    "days_to_decision",
    "claim_status_key",
    "reviewed_by",
    "dwh_updated_at",
    "patient_key",
    "hospital_key",
)

# Members whose rows may arrive after a fact that refers to them: key and natural id.
VISIT_MEMBERS = {
    "patient_key": "patient_id",
    "hospital_key": "hospital_id",
    "doctor_key": "doctor_id",
    "department_key": "department_id",
    "diagnosis_key": "diagnosis_code",
}
CLAIM_MEMBERS = {"patient_key": "patient_id", "hospital_key": "hospital_id"}
MOVE_MEMBERS = {"drug_key": "drug_id", "hospital_key": "hospital_id"}
#: What an undecided claim waits for.
DECISION = "decision"


def _member(df: DataFrame, dims: Tables, name: str, date_column: str, mode: str, *extra: str) -> DataFrame:
    """Key of the current version, or of the version valid on the row's date; -1 where there is none."""
    key, surrogate = f"{name}_id", f"{name}_key"
    if mode == "as_of":
        found = members_as_of(df, dims[name], key, date_column, [surrogate, *extra], how="left")
    else:
        found = df.join(current_members(dims[name], key, surrogate, *extra), key, "left")
    return found.withColumn(surrogate, F.coalesce(surrogate, F.lit(UNKNOWN_MEMBER)).cast("long"))


def _unknown(members: Iterable[str], prefix: str = "") -> Column:
    return reduce(or_, [F.col(f"{prefix}{m}") == UNKNOWN_MEMBER for m in members])


def unresolved(fact: DataFrame, key: str, members: Iterable[str]) -> DataFrame:
    """Ids of loaded rows that still refer to an unknown member."""
    return fact.filter(_unknown(members)).select(key)


def to_load(
    rows: DataFrame, recent: Column, key: str, date_column: str, retry: DataFrame | None, again: ledger.Again | None
) -> DataFrame:
    """Rows after the watermark and older ones to load once more; staged once.

    ``again`` comes from a ledger: something of these rows has arrived, and their dates
    prune the source. ``retry`` holds ids whose rows, with ``_retry``, are merely tried.
    """
    recent = F.coalesce(recent, F.lit(False))
    batch = rows.filter(recent).withColumn("_retry", F.lit(False))
    if again is not None:
        batch = batch.unionByName(again.of(rows.filter(~recent), key, date_column).withColumn("_retry", F.lit(False)))
    if retry is not None:
        tried = rows.filter(~recent).join(retry, key, "left_semi").withColumn("_retry", F.lit(True))
        batch = batch.unionByName(tried)
    return stage(batch)


def _members_waited_for(members: Mapping[str, str]) -> Column:
    """What a row waits for, from surrogate key column -> natural id column."""
    return ledger.waiting({name: (F.col(name) == UNKNOWN_MEMBER, F.col(natural)) for name, natural in members.items()})


def _worth_merging(df: DataFrame, members: Iterable[str]) -> DataFrame:
    """Without rows that were tried again and still refer to an unknown member."""
    return df.filter(~(F.col("_retry") & _unknown(members)))


def only_of(details: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Detail rows of the batch: the rest is dropped before anything is grouped.

    A small batch is broadcast and filters the scan; a large one is shuffled by the
    key that the details are grouped by next.
    """
    return details.join(batch.select(*keys).distinct(), list(keys), "left_semi")


def fact_visits(
    silver: Tables,
    dims: Tables,
    watermark: Clock,
    as_of: Clock,
    mode: str = "current",
    lookback_days: int = 0,
    target: DataFrame | None = None,
    again: ledger.Again | None = None,
    with_waits: bool = False,
) -> DataFrame:
    """Visits after the watermark with dimension keys and visit measures.

    ``dims`` needs patient, hospital, doctor, department (type 2) and diagnosis (type 1).
    A member that is not there yet gets the key -1. ``again`` names older visits of which
    a member has arrived; without a ledger, given the loaded fact as ``target``, its visits
    with such a key are tried again. ``with_waits`` adds what each visit still waits for.
    """
    retry = None if target is None else unresolved(target, "visit_id", VISIT_MEMBERS)
    recent = after_watermark("visit_date", watermark, lookback_days=lookback_days)
    batch = to_load(silver["visit"], recent, "visit_id", "visit_date", retry, again)
    visits = batch
    for name in ("patient", "hospital", "doctor", "department"):
        visits = _member(visits, dims, name, "visit_date", mode)
    visits = visits.join(dims["diagnosis"].select("diagnosis_code", "diagnosis_key"), "diagnosis_code", "left")
    visits = visits.withColumn("diagnosis_key", F.coalesce("diagnosis_key", F.lit(UNKNOWN_MEMBER)).cast("long"))
    visits = _worth_merging(visits, VISIT_MEMBERS)

    procedures = (
        only_of(silver["visit_procedure"], batch, ["visit_id"])
        .groupBy("visit_id")
        .agg(F.count(F.lit(1)).alias("procedure_count"))
    )
    rated = ["patient_id", "hospital_id", "doctor_id"]
    ratings = (
        only_of(silver["patient_feedback"], batch, rated)
        .groupBy(*rated)
        .agg(F.avg(F.col("rating").cast("decimal(3,1)")).alias("feedback_rating"))
    )
    referrals = (
        only_of(silver["referral"].withColumn("hospital_id", F.col("from_hospital_id")), batch, ["patient_id", "hospital_id"])
        .groupBy("patient_id", "hospital_id")
        .agg(earliest("referral_reason", "referral_date", "referral_id").alias("referral_reason"))
    )
    # One row per visit on both sides, so no key is hot.
    joined = visits.join(procedures, "visit_id", "left")
    prescribed = only_of(silver["prescription"], batch, ["visit_id"]).select("visit_id").distinct()
    joined = joined.join(prescribed.withColumn("prescribed", F.lit(1)), "visit_id", "left")
    joined = join_feeder(joined, ratings, rated)
    joined = join_feeder(joined, referrals, ["patient_id", "hospital_id"])
    return joined.select(
        "visit_id",
        date_key("visit_date").alias("date_key"),
        "patient_key",
        "hospital_key",
        "doctor_key",
        "department_key",
        "diagnosis_key",
        "visit_type",
        F.col("total_amount").alias("total_cost"),
        "waiting_time",
        F.coalesce("procedure_count", F.lit(0)).alias("procedure_count"),
        F.coalesce("prescribed", F.lit(0)).alias("prescription_flag"),
        "feedback_rating",
        "visit_status",
        "referral_reason",
        "visit_date",
        as_timestamp(as_of).alias("dwh_loaded_at"),
        *([_members_waited_for(VISIT_MEMBERS)] if with_waits else []),
    )


def claims_to_stage(
    claims: DataFrame,
    watermark: Clock,
    retry: DataFrame | None = None,
    lookback_days: int = 0,
    again: ledger.Again | None = None,
) -> DataFrame:
    """New and undecided claims, and older ones that the target holds undecided or without a member.

    The first part is a plain predicate that reaches the scan; the second one is a
    semi join, so a decision or a member that arrives late is always picked up.
    """
    pending = F.col("claim_status") == PENDING
    recent = after_watermark("claim_date", watermark, pending, lookback_days)
    return to_load(claims, recent, "claim_id", "claim_date", retry, again)


def undecided(fact: DataFrame) -> DataFrame:
    """Ids of loaded claims that have no decision yet."""
    return fact.filter("approved_amount IS NULL AND days_to_decision IS NULL").select("claim_id")


def fact_claims(
    silver: Tables,
    dims: Tables,
    watermark: Clock,
    as_of: Clock,
    target: DataFrame | None = None,
    mode: str = "current",
    lookback_days: int = 0,
    again: ledger.Again | None = None,
    with_waits: bool = False,
) -> DataFrame:
    """Claims to merge, one row per claim, with ``claim_date`` for the watermark.

    ``dims`` needs patient, hospital, drug (type 2) and claim_status (type 1). An unknown
    patient or hospital gets the key -1 until it arrives. ``again`` names older claims of
    which a decision or a member has arrived; without a ledger, given the loaded fact as
    ``target``, its undecided claims and those with the key -1 are tried again.
    ``with_waits`` adds what each claim still waits for.
    """
    retry = None
    if target is not None:
        retry = undecided(target).union(unresolved(target, "claim_id", CLAIM_MEMBERS)).distinct()
    batch = claims_to_stage(silver["claim"], watermark, retry, lookback_days, again)
    claims = batch
    for name in ("patient", "hospital"):
        claims = _member(claims, dims, name, "claim_date", mode)

    # The last review decides when a claim was reviewed more than once.
    decision = (
        only_of(silver["claim_approval"], batch, ["claim_id"])
        .groupBy("claim_id")
        .agg(
            latest(F.struct("approval_date", "rejection_reason", "reviewed_by"), "approval_date", "approval_id").alias(
                "decision"
            )
        )
        .select("claim_id", "decision.*")
    )
    items = stage(
        only_of(silver["claim_items"], batch, ["claim_id"]).select(
            "claim_id", "procedure_code", "drug_id", F.struct("item_amount", "claim_item_id").alias("rank")
        )
    )
    # NULL codes never reach a join: an item has a procedure or a drug, so they are many.
    procedures = join_feeder(
        items.filter("procedure_code IS NOT NULL"), silver["medical_procedure"].select("procedure_code"), ["procedure_code"], "inner"
    )
    drugs = join_feeder(
        items.filter("drug_id IS NOT NULL"), current_members(dims["drug"], "drug_id", "drug_key"), ["drug_id"], "inner"
    )
    no_rank = F.lit(None).cast(items.schema["rank"].dataType)
    none = {"n": F.lit(0), "procedure_rank": no_rank, "drug_rank": no_rank, "procedure_code": F.lit(None).cast("string")}
    none["drug_key"] = F.lit(None).cast("long")

    def part(df: DataFrame, **given: Column) -> DataFrame:
        return df.select("claim_id", *[value.alias(name) for name, value in {**none, **given}.items()])

    parts = [
        part(items, n=F.lit(1)),
        part(procedures, procedure_rank=F.col("rank"), procedure_code=F.col("procedure_code")),
        part(drugs, drug_rank=F.col("rank"), drug_key=F.col("drug_key")),
    ]
    items = reduce(DataFrame.unionByName, parts).groupBy("claim_id").agg(
        F.sum("n").alias("item_count"),
        F.max_by("procedure_code", "procedure_rank").alias("procedure_code"),
        F.max_by("drug_key", "drug_rank").alias("drug_key"),
    )
    joined = claims.join(decision, "claim_id", "left").join(items, "claim_id", "left")
    status = dims["claim_status"].select(
        F.col("claim_status").alias("s_status"),
        F.col("rejection_reason").alias("s_reason"),
        F.col("reviewed_by").alias("s_reviewer"),
        "claim_status_key",
    )
    joined = joined.join(
        status,
        (F.col("claim_status") == F.col("s_status"))
        & F.col("rejection_reason").eqNullSafe(F.col("s_reason"))
        & F.col("reviewed_by").eqNullSafe(F.col("s_reviewer")),
        "left",
    )
    moment = as_timestamp(as_of)
    gap = F.col("claim_amount") - F.coalesce("approved_amount", F.lit(0.0))
    open_ = F.col("approved_amount").isNull() & F.col("approval_date").isNull()
    wanted = {name: (F.col(name) == UNKNOWN_MEMBER, F.col(natural)) for name, natural in CLAIM_MEMBERS.items()}
    waits = ledger.waiting({**wanted, DECISION: (open_, F.col("claim_id"))})
    return joined.select(
        "claim_id",
        "visit_id",
        date_key("claim_date").alias("date_key"),
        "patient_key",
        "hospital_key",
        "procedure_code",
        "drug_key",
        F.coalesce("claim_status_key", F.lit(UNKNOWN_MEMBER)).cast("long").alias("claim_status_key"),
        "claim_amount",
        "approved_amount",
        gap.alias("approval_gap"),
        F.datediff("approval_date", "claim_date").alias("days_to_decision"),
        F.coalesce("item_count", F.lit(0)).alias("item_count"),
        "reviewed_by",
        moment.alias("dwh_loaded_at"),
        moment.alias("dwh_updated_at"),
        "claim_date",
        *([waits] if with_waits else []),
    )


def decided_claims(silver: Tables, days: tuple[dt.date, dt.date]) -> DataFrame:
    """Ids of the claims of some days that have a decision, as ``wanted_id``."""
    near = silver["claim"].filter(F.col("claim_date").between(*map(F.lit, days)))
    reviewed = silver["claim_approval"].filter("approval_date IS NOT NULL").select("claim_id").distinct()
    decided = near.filter("approved_amount IS NOT NULL").select("claim_id")
    return decided.unionByName(near.select("claim_id").join(reviewed, "claim_id", "left_semi")).select(F.col("claim_id").alias("wanted_id"))


def claim_update_rule():
    """A loaded claim changes only when a decision or a member arrives that it did not have."""
    waiting = F.col("tgt.approved_amount").isNull() & F.col("tgt.days_to_decision").isNull()
    decided = F.col("src.approved_amount").isNotNull() | F.col("src.days_to_decision").isNotNull()
    found = [(F.col(f"tgt.{m}") == UNKNOWN_MEMBER) & (F.col(f"src.{m}") != UNKNOWN_MEMBER) for m in CLAIM_MEMBERS]
    return {"update_columns": CLAIM_DECISION_COLUMNS, "update_when": (waiting & decided) | reduce(or_, found)}


def fact_pharmacy(
    silver: Tables,
    dims: Tables,
    watermark: Clock,
    as_of: Clock,
    mode: str = "current",
    lookback_days: int = 0,
    target: DataFrame | None = None,
    again: ledger.Again | None = None,
    with_waits: bool = False,
) -> DataFrame:
    """Drug movements after the watermark with stock, expiry and prescription flags.

    ``dims`` needs drug and hospital (type 2); unknown members get the key -1. ``again``
    names older movements of which a member has arrived; without a ledger, given the
    loaded fact as ``target``, those with the key -1 are tried again. ``with_waits`` adds
    what each movement still waits for.
    """
    retry = None if target is None else unresolved(target, "transaction_id", MOVE_MEMBERS)
    recent = after_watermark("transaction_date", watermark, lookback_days=lookback_days)
    batch = to_load(silver["drug_transaction"], recent, "transaction_id", "transaction_date", retry, again)
    moves = batch
    for name in ("drug", "hospital"):
        moves = _member(moves, dims, name, "transaction_date", mode)
    moves = _worth_merging(moves, MOVE_MEMBERS)
    # Several stock rows may exist per hospital and drug: one total, first expiry.
    stock = (
        only_of(silver["drug_inventory"], batch, ["hospital_id", "drug_id"])
        .groupBy("hospital_id", "drug_id")
        .agg(F.sum("quantity_available").alias("stock"), F.min("expiration_date").alias("first_expiry"))
    )
    # A movement is covered by a visit of the same day and hospital: from those visits to
    # their prescriptions, and only then to the items.
    days = batch.select("hospital_id", F.col("transaction_date").alias("visit_date"))
    visits = only_of(silver["visit"].select("visit_id", "hospital_id", "visit_date"), days, ["hospital_id", "visit_date"])
    covering = stage(silver["prescription"].select("prescription_id", "visit_id").join(visits, "visit_id"))
    covered = (
        only_of(silver["prescription_items"].select("prescription_id", "drug_id"), covering, ["prescription_id"])
        .join(covering, "prescription_id")
        .select("drug_id", "hospital_id", "visit_date")
    )
    priced = moves.join(silver["drug"].select("drug_id", "unit_amount"), "drug_id", "left")
    joined = join_feeder(priced, stock, ["hospital_id", "drug_id"])
    joined = flag_existing(
        joined, covered, {"drug_id": "drug_id", "hospital_id": "hospital_id", "transaction_date": "visit_date"}, "prescribed"
    )
    kind, quantity = F.col("transaction_type"), F.col("quantity")
    return joined.select(
        "transaction_id",
        "transaction_date",
        date_key("transaction_date").alias("date_key"),
        "drug_key",
        "hospital_key",
        "transaction_type",
        "quantity",
        "unit_amount",
        (quantity * F.col("unit_amount")).alias("total_value"),
        flag(kind.isin(*LEAVES_STOCK) & (F.col("stock") - quantity <= 0)).alias("stockout_flag"),
        flag(F.datediff("first_expiry", "transaction_date") <= NEAR_EXPIRY_DAYS).alias("near_expiry_flag"),
        flag((kind == "Dispensing") & (F.col("prescribed") == 0)).alias("no_prescription_flag"),
        "performed_by",
        as_timestamp(as_of).alias("dwh_loaded_at"),
        *([_members_waited_for(MOVE_MEMBERS)] if with_waits else []),
    )
