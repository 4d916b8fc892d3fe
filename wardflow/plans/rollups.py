"""Summaries that are kept up as facts grow, from partial states of each month.

For each group and month a state holds what can be added up later: counts, sums as
decimals, and for distinct counts a bitmap of the surrogate keys seen, cut into words of
64 keys: a group of few keys holds few words, and one of many keys a bit for each. When months of a fact change, only their states are computed again, from
those months alone; the summary is merged from the states and equals one computed from
the whole fact, distinct counts included.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.operators.cleaning import quoted
from wardflow.operators.ordering import stage
from wardflow.sinks.store import TableStore, partition_of

#: Sums are added as decimals, so that neither the order nor the cut into months matters.
EXACT = "decimal(38,8)"
#: Keys that one word of a bitmap, a long, stands for.
WORD = 64


@dataclass(frozen=True)
class Rollup:
    """A summary of one fact: groups, row count, sums and distinct counts of surrogate keys."""

    name: str
    fact: str
    keys: tuple[str, ...]
    sums: Mapping[str, Column | str]
    distinct: Mapping[str, str] = field(default_factory=dict)
    count: str = "row_count"
    partition: str = "month_key"

    @property
    def states(self) -> str:
        return f"{self.name}_states"

    @property
    def bitmaps(self) -> str:
        return f"{self.name}_key_words"

    @property
    def sources(self) -> str:
        return f"{self.name}_sources"


def add_states(rows: DataFrame, rollup: Rollup) -> DataFrame:
    """What adds up, for each group and partition."""
    sums = [F.sum((F.col(c) if isinstance(c, str) else c).cast(EXACT)).alias(name) for name, c in rollup.sums.items()]
    return rows.groupBy(*rollup.keys, rollup.partition).agg(F.count(F.lit(1)).alias(rollup.count), *sums)


def key_bitmaps(rows: DataFrame, rollup: Rollup) -> DataFrame:
    """The keys seen in each group and partition: one word of bits for each bucket of keys, of all distinct measures.

    A word is no larger than one key, so groups of few keys cost no more than their keys
    would; as a plain long it is combined in hash tables, before the shuffle and after.
    """
    seen = F.array(
        *[F.struct(F.lit(name).alias("measure"), F.col(c).cast("long").alias("id")) for name, c in rollup.distinct.items()]
    )
    long = rows.select(*rollup.keys, rollup.partition, F.inline(seen)).filter("id IS NOT NULL")
    bucket = F.shiftright("id", WORD.bit_length() - 1)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("id", F.lit(WORD)).cast("int"))
    return long.groupBy(*rollup.keys, rollup.partition, "measure", bucket.alias("bucket")).agg(F.bit_or(bit).alias("bits"))


def merged(states: DataFrame, bitmaps: DataFrame, rollup: Rollup) -> DataFrame:
    """The summary: sums of sums, and the keys of all partitions together, each counted once."""
    added = [F.sum(c).alias(c) for c in (rollup.count, *rollup.sums)]
    total = states.groupBy(*rollup.keys).agg(*added)
    whole = bitmaps.groupBy(*rollup.keys, "measure", "bucket").agg(F.bit_count(F.bit_or("bits")).alias("n"))
    counts = whole.groupBy(*rollup.keys).agg(
        *[F.sum(F.when(F.col("measure") == name, F.col("n")).otherwise(0)).alias(name) for name in rollup.distinct]
    )
    counts = counts.select(*[quoted(k).alias(f"_{k}") for k in rollup.keys], *rollup.distinct)
    same = [total[k].eqNullSafe(F.col(f"_{k}")) for k in rollup.keys]
    joined = total.join(counts, same, "left")
    shown = [F.coalesce(c, F.lit(0)).alias(c) for c in rollup.distinct]
    return joined.select(*rollup.keys, rollup.count, *[F.col(c).cast("double").alias(c) for c in rollup.sums], *shown)


def _partition_files(store: TableStore, rollup: Rollup) -> dict[str | None, str]:
    """A digest of each partition's list of files; it changes whenever the partition does."""
    found: dict[str | None, list[str]] = {}
    for file in store.table(rollup.fact).inputFiles():
        value = partition_of(file.rpartition("/")[0], 1)[rollup.partition]
        found.setdefault(value, []).append(file)
    return {value: hashlib.sha256("\n".join(sorted(files)).encode()).hexdigest() for value, files in found.items()}


def refresh(store: TableStore, rollup: Rollup) -> DataFrame:
    """Bring a summary up to date with its fact, and publish it.

    Which partitions changed is told by their files, so it does not matter who changed
    them, and a refresh that stopped half-way is simply done again.
    """
    now = _partition_files(store, rollup)
    # A summary of which a part is missing is computed from all partitions.
    kept = all(store.exists(name) for name in (rollup.sources, rollup.states, rollup.bitmaps))
    known = {r["value"]: r["files"] for r in store.table(rollup.sources).collect()} if kept else {}
    changed = [value for value, files in now.items() if known.get(value) != files]
    gone = [value for value in known if value not in now]
    fact, place = store.table(rollup.fact), F.col(rollup.partition).cast("string")
    named = [v for v in changed if v is not None]
    wanted = place.isin(*named) if named else F.lit(False)
    rows = fact.filter(wanted | place.isNull() if None in changed else wanted)
    for name, built in ((rollup.states, add_states(rows, rollup)), (rollup.bitmaps, key_bitmaps(rows, rollup))):
        if changed or gone or not store.exists(name):
            fresh = stage(built)
            left = {r[0] for r in fresh.select(place).distinct().collect()}
            emptied = [{rollup.partition: value} for value in (*changed, *gone) if value not in left]
            store.replace_partitions(name, fresh, [rollup.partition], emptied=emptied, rebalance=True)
    listed = store.spark.createDataFrame(list(now.items()), "value string, files string")
    store.overwrite(rollup.sources, listed)
    return store.overwrite(rollup.name, merged(store.table(rollup.states), store.table(rollup.bitmaps), rollup))


#: What each hospital did: visits, their cost and waiting, and how many patients and doctors took part.
HOSPITAL_ACTIVITY = Rollup(
    "hospital_activity",
    "fact_visits",
    ("hospital_key",),
    {"total_cost": "total_cost", "waiting_time": "waiting_time", "procedures": "procedure_count"},
    {"patients": "patient_key", "doctors": "doctor_key"},
    "visits",
)
#: What was moved of each drug, by kind of movement, and through how many hospitals.
DRUG_MOVEMENTS = Rollup(
    "drug_movements",
    "fact_pharmacy",
    ("drug_key", "transaction_type"),
    {"quantity": "quantity", "total_value": "total_value"},
    {"hospitals": "hospital_key"},
    "movements",
)
ROLLUPS = {r.name: r for r in (HOSPITAL_ACTIVITY, DRUG_MOVEMENTS)}
