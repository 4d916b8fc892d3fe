"""Whole-lakehouse loads: cleaned tables, star schema, marts.

Each step publishes a table before the next one reads it, and a watermark moves
only after its fact is published, so a run that stops half-way can be repeated.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.functions.expressions import Clock
from wardflow.operators import ledger as lg
from wardflow.operators import watermark as wm
from wardflow.operators.ordering import stage
from wardflow.operators.upsert import upsert_partitions
from wardflow.plans import dimensions as d
from wardflow.plans import facts as f
from wardflow.plans.marts import MARTS
from wardflow.plans.rollups import ROLLUPS, refresh
from wardflow.plans.silver import RECIPES, clean_table
from wardflow.sinks.store import TableStore, conform

AUDIT_SCHEMA = "step string, status string, duration_s double, error string, run_timestamp string"
CONTROL = "etl_watermark"


def run_steps(store: TableStore, steps: Mapping[str, Callable[[], object]], run_at: Clock) -> DataFrame:
    """Run steps in order and keep going after a failure of any kind.

    The audit row of a step is appended before the next one starts.
    """
    audit = []
    for name, action in steps.items():
        started = time.monotonic()
        status, error = "success", None
        try:
            action()
        except Exception as failure:  # noqa: BLE001
            status, error = "failed", f"{type(failure).__name__}: {failure}"
        audit.append((name, status, round(time.monotonic() - started, 3), error, str(run_at)))
        store.append("run_audit", store.spark.createDataFrame(audit[-1:], AUDIT_SCHEMA))
    return store.spark.createDataFrame(audit, AUDIT_SCHEMA)


def build_silver(
    store: TableStore,
    raw: Callable[[str], DataFrame],
    as_of: Clock,
    overrides: Mapping[str, Mapping[str, DataFrame]] | None = None,
    names: Iterable[str] = tuple(RECIPES),
) -> DataFrame:
    """Clean and publish all tables; ``raw(source)`` returns a raw table."""

    def step(name: str) -> Callable[[], object]:
        fixes = (overrides or {}).get(name)
        return lambda: store.overwrite(f"{name}_silver", clean_table(raw(RECIPES[name].source), name, as_of, fixes))

    return run_steps(store, {name: step(name) for name in names}, as_of)


def silver_tables(store: TableStore) -> dict[str, DataFrame]:
    return {name: store.table(f"{name}_silver") for name in RECIPES if store.exists(f"{name}_silver")}


def build_dimensions(store: TableStore, as_of: Clock) -> None:
    silver = silver_tables(store)
    store.overwrite("dim_date", d.dim_date(store.spark, as_of=as_of))
    store.overwrite("dim_diagnosis", d.dim_diagnosis(silver["diagnosis"], as_of))
    store.overwrite("dim_procedure", d.dim_procedure(silver["medical_procedure"], as_of))
    store.overwrite("dim_claim_status", d.dim_claim_status(silver["claim_approval"], as_of))
    dims: dict[str, DataFrame] = {}
    for name in d.DIMENSIONS:
        dims[name] = d.publish_dimension(store, name, silver, dims, as_of)


def dimension_tables(store: TableStore) -> dict[str, DataFrame]:
    names = ["diagnosis", "procedure", "claim_status", *d.DIMENSIONS]
    return {name: store.table(f"dim_{name}") for name in names}


@dataclass(frozen=True)
class FactLoad:
    """How one fact is loaded: its staging query, key, date and merge rules, and its members."""

    build: Callable[..., DataFrame]
    key: str
    date_column: str
    members: Mapping[str, str]
    schema: str | None = None
    rules: Callable[[], dict] = dict


FACTS = {
    "fact_claims": FactLoad(f.fact_claims, "claim_id", "claim_date", f.CLAIM_MEMBERS, f.FACT_CLAIMS, f.claim_update_rule),
    "fact_visits": FactLoad(f.fact_visits, "visit_id", "visit_date", f.VISIT_MEMBERS),
    "fact_pharmacy": FactLoad(f.fact_pharmacy, "transaction_id", "transaction_date", f.MOVE_MEMBERS),
}


def ledger_table(fact: str) -> str:
    return f"{fact}_waiting"


def load_fact(
    store: TableStore,
    name: str,
    silver: Mapping[str, DataFrame],
    dims: Mapping[str, DataFrame],
    since: Clock,
    as_of: Clock,
    mode: str = "current",
    lookback_days: int = 0,
    forget_after_days: int | None = None,
    keys_may_move: bool = True,
) -> DataFrame:
    """Merge new rows, and those of which something has arrived, into one fact; returns the batch.

    A row whose member, or a claim whose decision, is missing is noted in the fact's
    ledger. The next load compares that small table with the members created since, and
    loads only the rows it names again. The ledger moves after the fact, so a load that
    stops in between is repeated without harm.
    """
    load = FACTS[name]
    book = store.table_or_empty(ledger_table(name), T.StructType.fromDDL(lg.SCHEMA))
    again = _arrived(name, load, stage(book), silver, dims) if store.exists(ledger_table(name)) else None
    month = F.floor(F.col("date_key") / 100).cast("int")
    built = load.build(silver, dims, since, as_of, mode=mode, lookback_days=lookback_days, again=again, with_waits=True)
    if load.schema is not None:
        waits = built.schema[lg.WAITS]
        built = conform(built, T.StructType([*T.StructType.fromDDL(load.schema), waits]))
    # Staged once: the merge, the ledger and the newest date are read from the same rows.
    batch = stage(built.withColumn("month_key", month))
    rows = batch.drop(lg.WAITS)
    upsert_partitions(store, name, rows, [load.key], "month_key", keys_may_move, staged=True, **load.rules())
    opened = lg.entries(batch, load.key, load.date_column, "month_key", as_of)
    store.overwrite(ledger_table(name), lg.settle(book, batch, opened, load.key, as_of, forget_after_days))
    return rows


def _arrived(
    name: str, load: FactLoad, book: DataFrame, silver: Mapping[str, DataFrame], dims: Mapping[str, DataFrame]
) -> lg.Again | None:
    """Rows of the ledger that wait for a member created, or a claim decided, since it was checked."""
    since = lg.checked_since(book)
    if since is None:
        return None
    # A key column is called after its dimension.
    found = {key: lg.new_members(dims[key.removesuffix("_key")], natural, since) for key, natural in load.members.items()}
    if name == "fact_claims" and (days := lg.span(book, f.DECISION)):
        found[f.DECISION] = f.decided_claims(silver, days)
    return lg.arrived(book, found)


def load_facts(
    store: TableStore, as_of: Clock, mode: str = "current", lookback_days: int = 0, forget_after_days: int | None = None
) -> DataFrame:
    """Merge new rows into the three facts and advance their watermarks.

    Facts are partitioned by ``month_key``, so a load rewrites the months it touches. A
    row whose dimension member has not arrived is loaded with the member -1, and once
    more when the member is there.
    """
    if not store.exists(CONTROL):
        store.overwrite(CONTROL, store.spark.createDataFrame([], wm.SCHEMA))
    control = store.overwrite(CONTROL, wm.wm_init(store.table(CONTROL), wm.seed_rows(store.spark)))
    silver, dims = silver_tables(store), dimension_tables(store)
    for name, load in FACTS.items():
        since = wm.wm_read(control, name)
        batch = load_fact(store, name, silver, dims, since, as_of, mode, lookback_days, forget_after_days)
        newest = wm.load_summary(batch, name, load.date_column)
        control = store.overwrite(CONTROL, wm.wm_advance(store.table(CONTROL), newest))
    return control


def build_rollups(store: TableStore, as_of: Clock) -> DataFrame:
    """Bring the kept-up summaries up to date with the facts' changed months."""
    return run_steps(store, {name: lambda r=rollup: refresh(store, r) for name, rollup in ROLLUPS.items()}, as_of)


def build_marts(store: TableStore, as_of: Clock) -> DataFrame:
    silver = silver_tables(store)

    def step(name: str) -> Callable[[], object]:
        extra = {"as_of": as_of} if name == "drug_utilization" else {}
        return lambda: store.overwrite(name, MARTS[name](silver, created_at=as_of, **extra))

    return run_steps(store, {name: step(name) for name in MARTS}, as_of)
