"""Merging a batch into a table, and comparing two states of a table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.operators.cleaning import quoted
from wardflow.operators.ordering import stage
from wardflow.sinks.store import TableStore, by_lower_name, conform


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail if two rows share a key: a merge would have to pick one of them."""
    repeated = df.groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"duplicate key in merge source: {repeated[0].asDict()}")
    return df


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str] | None = None,
    update_when: Column | None = None,
) -> DataFrame:
    """Insert unseen keys and update known ones.

    ``update_when`` may use ``tgt.<column>`` and ``src.<column>``; without it every
    known key is updated. ``update_columns`` limits what an update changes. Columns are
    matched without regard to case and keep the target's spelling. Keys must be unique on both sides, which also keeps the full join free of hot keys.
    Columns that only the source has are added, NULL on rows it does not touch.
    """
    known = by_lower_name(target.columns)
    more = {f.name: F.lit(None).cast(f.dataType) for f in source.schema.fields if f.name.lower() not in known}
    target = target.withColumns(more) if more else target
    new = conform(source, target.schema)
    keys = [known[k.lower()] for k in keys]
    left = target.withColumn("_known", F.lit(True)).alias("tgt")
    right = new.withColumn("_arrived", F.lit(True)).alias("src")
    on = reduce(and_, [F.col(f"tgt.{k}").eqNullSafe(F.col(f"src.{k}")) for k in keys])
    both = F.col("tgt._known").isNotNull() & F.col("src._arrived").isNotNull()
    update = both & F.coalesce(update_when, F.lit(False)) if update_when is not None else both
    changing = {c.lower() for c in (update_columns if update_columns is not None else target.columns)}
    changing -= {k.lower() for k in keys} if update_columns is None else set()
    merged = left.join(right, on, "full_outer")
    unseen = F.col("tgt._known").isNull()

    def value(name: str) -> Column:
        from_source = unseen | update if name.lower() in changing else unseen
        return F.when(from_source, F.col(f"src.`{name}`")).otherwise(F.col(f"tgt.`{name}`")).alias(name)

    return merged.select(*[value(c) for c in target.columns])


def upsert_partitions(
    store: TableStore,
    name: str,
    source: DataFrame,
    keys: Sequence[str],
    partition: str,
    keys_may_move: bool = True,
    staged: bool = False,
    **rules,
) -> DataFrame:
    """Upsert that rewrites only the partitions the batch touches.

    These are the partitions of the batch and those that already hold one of its
    keys, found by reading the key and partition columns alone. Where a key can
    never change its partition, ``keys_may_move=False`` saves that scan. However many
    partitions there are, their list stays a table and prunes the target by a semi join.
    A new column of the batch is added to the table. Batch (unless it is ``staged``
    already) and merged rows are staged in the shared checkpoint folder before files are
    replaced, so a task that is run again never reads half-replaced data.
    """
    batch = source if staged else stage(source)
    assert_unique(batch, keys)
    if not store.exists(name):
        return store.overwrite(name, batch, [partition], rebalance=True)
    store.add_columns(name, batch)
    target = store.table(name)
    places = batch.select(F.col(partition).alias("_touched"))
    if keys_may_move:
        holding = target.select(*keys, partition).join(batch.select(*keys), list(keys), "left_semi")
        places = places.unionByName(holding.select(F.col(partition).alias("_touched")))
    touched = stage(places.distinct())
    if touched.isEmpty():
        return target
    same = F.col(partition).eqNullSafe(F.col("_touched"))
    merged = stage(upsert(target.join(touched, same, "left_semi"), batch, keys, **rules))
    # Partitions that lost their last row to another one leave the catalog: one row each.
    lost = touched.join(merged.select(partition).distinct(), same, "left_anti").select(F.col("_touched").cast("string"))
    emptied = [{partition: row[0]} for row in lost.collect()]
    return store.replace_partitions(name, merged, [partition], emptied=emptied, rebalance=True)


#: Buckets of keys that two states are compared by; as many digests are compared and broadcast.
BUCKETS = 1 << 16


def _aligned(before: DataFrame, after: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both states with the columns of either, spelled and typed as in the newer one; missing ones are NULL."""
    old, new = by_lower_name(before.columns), by_lower_name(after.columns)
    gone = [before.schema[name] for lower, name in old.items() if lower not in new]
    schema = T.StructType([*after.schema.fields, *gone])
    return conform(before, schema), conform(after, schema)


def column_changes(before: DataFrame, after: DataFrame) -> list[tuple[str, str, str | None, str | None]]:
    """What became of the columns: name, ``added``, ``removed`` or ``retyped``, and the types before and after."""
    old = {f.name.lower(): f for f in before.schema.fields}
    new = {f.name.lower(): f for f in after.schema.fields}
    changes = []
    for lower in [*old, *[c for c in new if c not in old]]:
        kinds = [None if side is None else side.dataType.simpleString() for side in (old.get(lower), new.get(lower))]
        if kinds[0] != kinds[1]:
            what = "added" if kinds[0] is None else "removed" if kinds[1] is None else "retyped"
            changes.append(((new.get(lower) or old[lower]).name, what, *kinds))
    return changes


def bucket_digests(df: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """One row for each bucket of keys: its rows, and two sums over them that their order does not change.

    The two 64-bit hashes of a row take its NULLs into account, which a plain hash skips.
    """
    nulls = F.concat(*[F.when(quoted(c).isNull(), "1").otherwise("0") for c in df.columns])
    values = [quoted(c) for c in df.columns]
    first, second = F.xxhash64(F.lit(1), nulls, *values), F.xxhash64(F.lit(2), nulls, *values)
    return df.groupBy(_bucket(keys, buckets).alias("_bucket")).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum(first.cast("decimal(20,0)")).alias("_sum"),
        F.bit_xor(second).alias("_xor"),
    )


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    nulls = F.concat(*[F.when(quoted(k).isNull(), "1").otherwise("0") for k in keys])
    return F.pmod(F.xxhash64(nulls, *[quoted(k) for k in keys]), F.lit(buckets)).cast("int")


def unequal_buckets(before: DataFrame, after: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Numbers of the buckets whose rows are not the same on both sides."""
    sides = [bucket_digests(df, keys, buckets) for df in (before, after)]
    # The same digest twice cancels out: what is left is on one side only, or differs.
    counted = sides[0].unionByName(sides[1]).groupBy("_bucket", "_rows", "_sum", "_xor").agg(F.count(F.lit(1)).alias("_sides"))
    return counted.filter("_sides = 1").select("_bucket").distinct()


def snapshot_diff(before: DataFrame, after: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Rows inserted, deleted or updated between two states, with ``change_type``.

    Deleted rows carry their last values, the others their new ones. Columns are
    matched without regard to case; one that only one state has is NULL in the other, so
    a value in it is a change (``column_changes`` tells which columns came or went).

    Each side is first reduced to a digest for each bucket of keys. Only rows of buckets
    whose digests differ are shuffled and compared: the list of these buckets, at most
    ``buckets`` numbers, is broadcast. Two different buckets pass for equal with a chance of 2^-128.
    """
    before, after = _aligned(before, after)
    columns = after.columns
    spelling = by_lower_name(columns)
    keys = [spelling[k.lower()] for k in keys]
    rest = [c for c in columns if c not in keys]
    changing = stage(unequal_buckets(before, after, keys, buckets))

    def touched(df: DataFrame) -> DataFrame:
        return df.withColumn("_bucket", _bucket(keys, buckets)).join(F.broadcast(changing), "_bucket", "left_semi").drop("_bucket")

    old = touched(before).withColumn("_was", F.lit(True)).alias("old")
    new = touched(after).withColumn("_is", F.lit(True)).alias("new")
    on = reduce(and_, [F.col(f"old.`{k}`").eqNullSafe(F.col(f"new.`{k}`")) for k in keys])
    changed = ~F.struct(*[F.col(f"old.`{c}`") for c in rest]).eqNullSafe(F.struct(*[F.col(f"new.`{c}`") for c in rest]))
    kind = (
        F.when(F.col("old._was").isNull(), "insert")
        .when(F.col("new._is").isNull(), "delete")
        .when(changed, "update")
    )
    gone = F.col("new._is").isNull()
    values = [F.when(gone, F.col(f"old.`{c}`")).otherwise(F.col(f"new.`{c}`")).alias(c) for c in columns]
    return old.join(new, on, "full_outer").select(*values, kind.alias("change_type")).filter("change_type IS NOT NULL")
