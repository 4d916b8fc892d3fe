"""Type-2 dimensions as tables whose history is only added to.

Current versions lie in one partition, versions that a load closed in another one for
each end date. A load reads and rewrites current versions alone; what it closes goes to
a partition of its own, and older ones are neither read nor written again.

Two facts make the current versions enough: every key has one, and it has the key's
highest version number; and a closed version was followed by one with a higher
surrogate key, so the highest of all is current.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.functions.expressions import Clock, as_date
from wardflow.operators import scd
from wardflow.operators.ordering import stage
from wardflow.sinks.store import TableStore

PARTITIONS = ("scd_is_current", "scd_end_date")


def load_history(
    store: TableStore,
    name: str,
    source: DataFrame,
    schema: T.StructType,
    surrogate: str,
    key: str,
    tracked: Sequence[str],
    as_of: Clock,
    same_day: str = "replace",
) -> DataFrame:
    """Publish the next state of a type-2 dimension; ``source`` holds today's business columns.

    Closed versions are published before the current ones that follow them. A load that
    stops between the two leaves versions that are closed and current; the next load,
    of whatever day, finds them in the newest closed partition and takes them out first.
    A table that is not partitioned this way yet is rewritten once.
    """
    if not store.exists(name):
        return store.overwrite(name, scd.scd2_first_load(source, schema, surrogate, key, as_of), PARTITIONS)
    if store.partition_columns(name) != list(PARTITIONS):
        store.overwrite(name, store.table(name), PARTITIONS)
    current = scd.current_rows(store.table(name))
    _take_back(store, name, current, surrogate)
    changes = scd.scd2_changes(current, source, surrogate, key, tracked, as_of, same_day)
    if changes.isEmpty():
        return store.table(name)
    after = scd.scd2_expire(current, changes, key, as_of)
    closed = after.filter("scd_is_current = 0")
    # An earlier load of the same day may have closed versions too.
    day = F.date_sub(as_date(as_of), 1)
    earlier = _closed_on(store, name, day).join(closed.select(surrogate), surrogate, "left_anti")
    store.replace_partitions(name, stage(closed.unionByName(earlier)), PARTITIONS)
    follows = after.filter("scd_is_current = 1").unionByName(scd.scd2_insert(current, changes))
    return store.replace_partitions(name, follows, PARTITIONS)


def _closed_on(store: TableStore, name: str, day) -> DataFrame:
    return store.table(name).filter((F.col("scd_is_current") == 0) & (F.col("scd_end_date") == day))


def _take_back(store: TableStore, name: str, current: DataFrame, surrogate: str) -> None:
    """Undo a load that published what it closed and then stopped: only the newest partition can hold such rows."""
    days = [p["scd_end_date"] for p in store.partitions(name) if p["scd_is_current"] == "0" and p["scd_end_date"]]
    if not days:
        return
    newest = _closed_on(store, name, F.lit(max(days)).cast("date"))
    ids = current.select(surrogate)
    if newest.join(ids, surrogate, "left_semi").isEmpty():
        return
    kept = stage(newest.join(ids, surrogate, "left_anti"))
    emptied = [{"scd_is_current": 0, "scd_end_date": max(days)}] if kept.isEmpty() else []
    store.replace_partitions(name, kept, PARTITIONS, emptied=emptied)
