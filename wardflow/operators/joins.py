"""Join shapes the warehouse and the marts use.

No table is forced to broadcast: Spark compares measured sizes with
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles. Adaptive execution
splits a hot key of a shuffled join only where both sides are plain shuffles; a side
that was aggregated by the join key is not, so ``join_feeder`` writes it first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardflow.operators.cleaning import quoted, remove_duplicates
from wardflow.operators.ordering import stage
from wardflow.operators.scd import current_rows


def current_members(dimension: DataFrame, key: str, *columns: str) -> DataFrame:
    """Current versions, with only the wanted columns."""
    return current_rows(dimension).select(key, *columns)


def members_as_of(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    date_column: str,
    columns: Sequence[str],
    how: str = "inner",
    period: str = "year",
) -> DataFrame:
    """Join each fact row to the dimension version that was valid on its date.

    The days on which a key has facts, however many facts there are, and the key's
    versions are merged in the order of time, and the last version is carried forward:
    no fact is compared with a version that is not its own. So that a key with very many
    versions is no single task, time is cut into periods (a unit of ``date_trunc``), and
    the version that is open at a period's start is copied into it. Facts then find
    their day's version in a table with one row per key and day. Where versions overlap,
    the one that starts last counts. A NULL key or date has no version.
    """
    day = F.col(date_column)
    asked = facts.filter(F.col(key).isNotNull() & day.isNotNull()).select(
        F.col(key).alias("_key"), day.alias("_at"), F.date_trunc(period, day).alias("_period")
    )
    asked = asked.distinct()
    found = versions_on(asked, _versions(dimension, key, columns, period)).select("_key", "_at", "_version")
    feeder = found.select(F.col("_key").alias(key), F.col("_at").alias(date_column), "_version")
    joined = join_feeder(facts, feeder, [key, date_column], how)
    kept = [F.col(c) for c in facts.columns if c not in columns]
    return joined.select(*kept, *[F.col("_version").getField(c).alias(c) for c in columns])


def _versions(dimension: DataFrame, key: str, columns: Sequence[str], period: str) -> DataFrame:
    """Versions that were valid for a day at least, with the period they start in."""
    start, end = F.col("scd_start_date"), F.col("scd_end_date")
    lasting = dimension.filter(F.col(key).isNotNull() & (end.isNull() | (end >= start)))
    version = F.struct(start.alias("_start"), end.isNull().alias("_open"), end.alias("_end"), *columns)
    return lasting.select(F.col(key).alias("_key"), F.date_trunc(period, start).alias("_period"), version.alias("_version"))


def versions_on(asked: DataFrame, versions: DataFrame) -> DataFrame:
    """``_version`` for each distinct ``(_key, _period, _at)``, where one is valid then."""
    # The last version of each period a key has, carried to the next periods it is asked for:
    # at most a row or two for each key and period.
    last = versions.groupBy("_key", "_period").agg(F.max(F.struct("_version._start", "_version._open", "_version._end", "_version")).alias("_top"))
    ends = last.select("_key", "_period", F.col("_top._version").alias("_version"))
    wanted = asked.select("_key", "_period").distinct()
    steps = ends.unionByName(wanted, allowMissingColumns=True).groupBy("_key", "_period").agg(
        F.first("_version", ignorenulls=True).alias("_version")
    )
    earlier = Window.partitionBy("_key").orderBy("_period").rowsBetween(Window.unboundedPreceding, -1)
    opening = steps.withColumn("_version", F.last("_version", ignorenulls=True).over(earlier))
    opening = opening.filter("_version IS NOT NULL").join(wanted, ["_key", "_period"], "left_semi")

    # One stream of a key and period: the version it opens with, versions that start, days that ask.
    starts = [df.withColumn("_at", F.col("_version._start")) for df in (opening, versions)]
    stream = reduce(DataFrame.unionByName, starts).withColumn("_asks", F.lit(0))
    stream = stream.unionByName(asked.withColumn("_asks", F.lit(1)), allowMissingColumns=True)
    order = ["_at", "_asks", "_version._open", "_version._end"]
    upto = Window.partitionBy("_key", "_period").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    carried = stream.withColumn("_version", F.last("_version", ignorenulls=True).over(upto)).filter("_asks = 1")
    return carried.filter("_version IS NOT NULL AND (_version._end IS NULL OR _at <= _version._end)").drop("_asks")


def join_feeder(df: DataFrame, feeder: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join rows to a feeder that was aggregated to one row per key.

    The feeder is written first, whatever its size: read back it is a plain scan, so
    both sides of the join are plain shuffles and adaptive execution splits the rows of
    any hot key, NULL included, by the partition sizes it measures.
    """
    return df.join(stage(feeder), list(keys), how)


def flag_existing(
    df: DataFrame,
    other: DataFrame,
    columns: Mapping[str, str],
    target: str,
) -> DataFrame:
    """1 where a row with the same key values exists in ``other``, else 0.

    The other side is reduced to distinct keys first, so rows never multiply.
    """
    keys = other.select(*[F.col(b).alias(a) for a, b in columns.items()]).distinct().withColumn("_hit", F.lit(1))
    joined = join_feeder(df, keys, list(columns))
    flagged = joined.withColumn(target, F.when(F.col("_hit").isNotNull(), 1).otherwise(0))
    return flagged.select(*df.columns, target)


#: Repeated keys that are broadcast by ``remove_few_duplicates``; with more, all rows are compared by a shuffle.
MAX_REPEATED = 200_000


def remove_few_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``remove_duplicates``, for tables in which few keys repeat.

    Hashes of the keys alone are shuffled and counted first. Rows whose hash occurs once
    stay where they are, so columns that nobody asks for are never read; only the
    others, which a hash that two keys share adds to without harm, are grouped and
    compared. ``df`` is read more than once and must give the same rows each time.
    """
    mark = F.xxhash64(*[quoted(k) for k in keys])
    counts = df.groupBy(mark.alias("_mark")).agg(F.count(F.lit(1)).alias("_n"))
    repeated = stage(counts.filter("_n > 1").select("_mark"))
    found = repeated.count()
    if not found:
        return df
    if found > MAX_REPEATED:
        return remove_duplicates(df, keys)
    marked, repeated = df.withColumn("_mark", mark), F.broadcast(repeated)
    alone = marked.join(repeated, "_mark", "left_anti").drop("_mark")
    several = marked.join(repeated, "_mark", "left_semi").drop("_mark")
    return alone.unionByName(remove_duplicates(several, keys))


def rows_with_shared_value(df: DataFrame, column: str) -> DataFrame:
    """Rows whose value occurs on more than one row (NULLs excluded)."""
    shared = df.groupBy(column).agg(F.count(F.lit(1)).alias("shared_by")).filter(
        (F.col("shared_by") > 1) & F.col(column).isNotNull()
    )
    return join_feeder(df, shared, [column], "inner").select(*df.columns, "shared_by")


def feed(base: DataFrame, feeders: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Left-join aggregated feeders, each with one row per key, to a base table."""
    return reduce(lambda df, feeder: df.join(feeder[0], list(feeder[1]), "left"), feeders, base)
