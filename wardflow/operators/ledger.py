"""Rows that were loaded while something they refer to was missing.

The ledger is a small table with one row for each missing thing of a loaded row: the
row's id, date and partition, and what it waits for. A load compares it with what has
arrived since the last one, and touches again only the rows that it names. It never
searches the loaded table, or its history, for such rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.expressions import Clock, as_date, as_timestamp

SCHEMA = "row_id string, row_date date, part string, wanted string, wanted_id string, checked_at timestamp"

#: The column of a batch that lists what each row waits for.
WAITS = "waits_for"


def waiting(wanted: Mapping[str, tuple[Column, Column]]) -> Column:
    """What a row waits for, from name -> (is it missing, its id). A NULL id never arrives and is not listed."""
    listed = [
        F.when(missing & known.isNotNull(), F.struct(F.lit(name).alias("wanted"), known.cast("string").alias("wanted_id")))
        for name, (missing, known) in wanted.items()
    ]
    return F.array_compact(F.array(*listed)).alias(WAITS)


def entries(batch: DataFrame, key: str, date_column: str, part: str, as_of: Clock) -> DataFrame:
    """Ledger rows of a batch that carries ``WAITS``."""
    return batch.select(
        F.col(key).cast("string").alias("row_id"),
        F.col(date_column).alias("row_date"),
        F.col(part).cast("string").alias("part"),
        F.inline(WAITS),
    ).withColumn("checked_at", as_timestamp(as_of))


def new_members(dimension: DataFrame, key: str, since: dt.datetime | None) -> DataFrame:
    """Ids of the members that were created since a moment; the predicate reaches the scan."""
    if since is not None and "dwh_created_at" in dimension.columns:
        dimension = dimension.filter(F.col("dwh_created_at") >= F.lit(since))
    return dimension.select(F.col(key).cast("string").alias("wanted_id")).distinct()


@dataclass(frozen=True)
class Again:
    """Rows to load once more: their ids, and the range of their dates, which prunes the source."""

    rows: DataFrame
    first: dt.date
    last: dt.date

    def of(self, source: DataFrame, key: str, date_column: str) -> DataFrame:
        day = F.col(date_column)
        near = source.filter((day >= F.lit(self.first)) & (day <= F.lit(self.last)))
        return near.join(self.rows.select(F.col("row_id").alias("_again")).distinct(), F.col(key).cast("string") == F.col("_again"), "left_semi")


def checked_since(ledger: DataFrame) -> dt.datetime | None:
    return ledger.agg(F.min("checked_at")).first()[0]


def span(ledger: DataFrame, wanted: str) -> tuple[dt.date, dt.date] | None:
    """Dates of the rows that wait for one kind of thing."""
    first, last = ledger.filter(F.col("wanted") == wanted).agg(F.min("row_date"), F.max("row_date")).first()
    return None if first is None else (first, last)


def arrived(ledger: DataFrame, found: Mapping[str, DataFrame]) -> Again | None:
    """Rows of which something has arrived; ``found`` maps what is wanted to ``wanted_id`` rows. None without any."""
    parts = [
        ledger.filter(F.col("wanted") == name).join(ids.select("wanted_id"), "wanted_id", "left_semi").select("row_id", "row_date")
        for name, ids in found.items()
    ]
    rows = reduce(DataFrame.unionByName, parts).distinct()
    first, last = rows.agg(F.min("row_date"), F.max("row_date")).first()
    return None if first is None else Again(rows, first, last)


def settle(ledger: DataFrame, batch: DataFrame, opened: DataFrame, key: str, as_of: Clock, forget_after_days: int | None = None) -> DataFrame:
    """The ledger after a load: rows of the batch by what they still wait for, the others as checked now.

    Rows that are older than ``forget_after_days`` are given up.
    """
    loaded = batch.select(F.col(key).cast("string").alias("row_id"))
    rest = ledger.join(loaded, "row_id", "left_anti").withColumn("checked_at", as_timestamp(as_of))
    after = rest.unionByName(opened).select(*[part.split()[0] for part in SCHEMA.split(", ")])
    if forget_after_days is not None:
        after = after.filter(F.col("row_date") >= F.date_sub(as_date(as_of), forget_after_days))
    return after
