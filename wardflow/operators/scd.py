"""Slowly changing dimensions.

Housekeeping columns of a type-2 dimension: ``scd_start_date, scd_end_date,
scd_is_current, scd_version, dwh_created_at, dwh_updated_at``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.functions.expressions import Clock, as_date, as_timestamp
from wardflow.operators.cleaning import quoted
from wardflow.operators.ordering import with_position

HOUSEKEEPING = (
    "scd_start_date date, scd_end_date date, scd_is_current int, scd_version int, "
    "dwh_created_at timestamp, dwh_updated_at timestamp"
)


def dimension_schema(surrogate: str, columns: str) -> T.StructType:
    """Surrogate key, business columns, housekeeping columns."""
    return T.StructType.fromDDL(f"{surrogate} bigint, {columns}, {HOUSEKEEPING}")


def current_rows(dimension: DataFrame) -> DataFrame:
    return dimension.filter("scd_is_current = 1")


def max_key(dimension: DataFrame, surrogate: str) -> int:
    """Highest key in use; one number, answered from Parquet statistics and partial maxima."""
    return dimension.agg(F.coalesce(F.max(surrogate), F.lit(0))).first()[0]


def scd1(source: DataFrame, surrogate: str, key_order: Sequence[str], columns: Sequence[str], as_of: Clock) -> DataFrame:
    """Full reload: a dense key in natural-key order plus audit columns."""
    rows = with_position(source.select(*columns), key_order, surrogate)
    moment = as_timestamp(as_of)
    return rows.select(
        F.col(surrogate).cast("long").alias(surrogate),
        *[quoted(c) for c in columns],
        moment.alias("dwh_created_at"),
        moment.alias("dwh_updated_at"),
    )


def _differs(tracked: Sequence[str], left: str, right: str) -> Column:
    """True where a tracked column changed, to or from NULL included."""
    return reduce(or_, [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in tracked])


def _conformed(target: DataFrame, source: DataFrame) -> DataFrame:
    """Source business columns in the target's types: compared as they will be stored."""
    kinds = {f.name: f.dataType for f in target.schema.fields}
    return source.select(*[quoted(c).cast(kinds[c]).alias(c) for c in source.columns])


def scd2_changes(
    target: DataFrame,
    source: DataFrame,
    surrogate: str,
    key: str,
    tracked: Sequence[str],
    as_of: Clock,
    same_day: str = "replace",
) -> DataFrame:
    """New versions to insert: unseen keys and keys whose tracked columns changed.

    The new rows are staged, so that expiring and inserting see the same set.
    ``same_day="replace"`` corrects a version that started on ``as_of`` in place
    (its key, start and version number are kept); ``"version"`` always adds one.
    """
    run_date, moment = as_date(as_of), as_timestamp(as_of)
    names = [c for c in source.columns if c != key]
    history = target.groupBy(key).agg(
        F.max("scd_version").alias("top_version"),
        F.max(
            F.when(
                F.col("scd_is_current") == 1,
                F.struct("scd_version", surrogate, "scd_start_date", "dwh_created_at", *tracked),
            )
        ).alias("cur"),
    )
    new = _conformed(target, source)
    paired = new.alias("src").join(
        history.withColumnRenamed(key, "known_key"), F.col(f"src.{key}").eqNullSafe(F.col("known_key")), "left"
    )
    fresh = F.col("cur").isNull()
    corrected = (
        F.coalesce(F.col("cur.scd_start_date") >= run_date, F.lit(False)) if same_day == "replace" else F.lit(False)
    )
    delta = paired.filter(fresh | _differs(tracked, "cur", "src")).select(
        F.col(f"src.{key}").alias(key),
        *[F.col(f"src.{c}").alias(c) for c in names],
        F.when(corrected, F.col(f"cur.{surrogate}")).alias("kept_key"),
        F.when(corrected, F.col("cur.scd_start_date")).otherwise(run_date).alias("scd_start_date"),
        F.lit(None).cast("date").alias("scd_end_date"),
        F.lit(1).alias("scd_is_current"),
        F.when(corrected, F.col("cur.scd_version"))
        .otherwise(F.coalesce(F.col("top_version"), F.lit(0)) + 1)
        .cast("int")
        .alias("scd_version"),
        F.when(corrected, F.col("cur.dwh_created_at")).otherwise(moment).alias("dwh_created_at"),
        moment.alias("dwh_updated_at"),
    )
    # Corrected rows sort last, so the new keys stay dense.
    ordered = delta.withColumn("_keeps", F.col("kept_key").isNotNull())
    placed = with_position(ordered, ["_keeps", key], "_new_key", first=1 + max_key(target, surrogate))
    return placed.withColumn(surrogate, F.coalesce("kept_key", "_new_key").cast("long")).drop("_keeps", "_new_key")


def scd2_expire(target: DataFrame, changes: DataFrame, key: str, as_of: Clock) -> DataFrame:
    """Close the current version of every changed key; a corrected version is taken out.

    Closed rows end the day before ``as_of``.
    """
    changed = changes.select(
        F.col(key).alias("changed_key"), F.lit(1).alias("hit"), F.col("kept_key").isNotNull().alias("corrected")
    )
    joined = target.join(
        changed, target[key].eqNullSafe(F.col("changed_key")) & (target["scd_is_current"] == 1), "left"
    )
    closing = F.col("hit").isNotNull()
    rewritten = {
        "scd_end_date": F.when(closing, F.date_sub(as_date(as_of), 1)).otherwise(F.col("scd_end_date")),
        "scd_is_current": F.when(closing, 0).otherwise(F.col("scd_is_current")),
        "dwh_updated_at": F.when(closing, as_timestamp(as_of)).otherwise(F.col("dwh_updated_at")),
    }
    kept = joined.filter(~F.coalesce(F.col("corrected"), F.lit(False)))
    return kept.withColumns(rewritten).select(*target.columns)


def scd2_insert(target: DataFrame, changes: DataFrame) -> DataFrame:
    """The staged new versions in the target's column order."""
    return changes.select(*[quoted(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields])


def scd2_apply(
    target: DataFrame,
    source: DataFrame,
    surrogate: str,
    key: str,
    tracked: Sequence[str],
    as_of: Clock,
    same_day: str = "replace",
) -> DataFrame:
    """The next state of a type-2 dimension.

    Keys missing from the source stay current, and untracked columns keep the
    values of the version they were loaded with.
    """
    changes = scd2_changes(target, source, surrogate, key, tracked, as_of, same_day)
    return scd2_expire(target, changes, key, as_of).unionByName(scd2_insert(target, changes))


def scd2_first_load(source: DataFrame, schema: T.StructType, surrogate: str, key: str, as_of: Clock) -> DataFrame:
    """Version 1 of every key: what ``scd2_apply`` gives for an empty target."""
    run_date, moment = as_date(as_of), as_timestamp(as_of)
    rows = with_position(source, [key], surrogate).withColumns(
        {
            "scd_start_date": run_date,
            "scd_end_date": F.lit(None),
            "scd_is_current": F.lit(1),
            "scd_version": F.lit(1),
            "dwh_created_at": moment,
            "dwh_updated_at": moment,
        }
    )
    return rows.select(*[quoted(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
