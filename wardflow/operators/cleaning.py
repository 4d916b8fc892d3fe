"""Cleaning transforms, each ``DataFrame -> DataFrame`` in one projection."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.functions.expressions import (
    Clock,
    as_timestamp,
    egypt_phone,
    with_leading_zero,
    years_between,
)

UNKNOWN = "Unknown"

# Type names that the numeric fill covers; byte and short are left alone.
FILLED_NUMERIC = (T.IntegerType, T.LongType, T.DoubleType, T.FloatType, T.DecimalType)


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def map_columns(df: DataFrame, wanted: Callable[[T.StructField], bool], change: Callable[[Column], Column]) -> DataFrame:
    """Apply one expression to every column the test picks, in a single select."""
    return df.select(
        *[
            change(quoted(f.name)).alias(f.name) if wanted(f) else quoted(f.name)
            for f in df.schema.fields
        ]
    )


def _is_string(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.StringType)


def remove_duplicates(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """One row per key; rows with a NULL key form one group.

    The survivor is the first row by ``order_by`` and then by every other column,
    so that a rerun keeps the same row. ``row_number() = 1`` lets Spark keep only
    one candidate per key and task before the shuffle, so a key that holds a large
    part of the table is never gathered in one task.
    """
    chosen = [F.col(c) if isinstance(c, str) else c for c in order_by or ()]
    ties = [quoted(c) for c in df.columns if c not in keys]
    if not chosen and not ties:
        return df.dropDuplicates(list(keys))
    window = Window.partitionBy(*[quoted(k) for k in keys]).orderBy(*chosen, *ties)
    return df.withColumn("_row", F.row_number().over(window)).filter("_row = 1").drop("_row")


def trim_strings(df: DataFrame) -> DataFrame:
    """Strip spaces (not tabs) around every string."""
    return map_columns(df, _is_string, F.trim)


def initcap_strings(df: DataFrame) -> DataFrame:
    return map_columns(df, _is_string, F.initcap)


def lowercase_strings(df: DataFrame) -> DataFrame:
    return map_columns(df, _is_string, F.lower)


def tidy(
    df: DataFrame,
    trim: bool = False,
    text: str | None = None,
    number: float | None = None,
    exclude: Iterable[str] = (),
) -> DataFrame:
    """Trim strings, replace NULL strings and replace NULL numbers in one projection.

    Columns in ``exclude`` are trimmed but keep their NULLs. Numbers are chosen by
    type: tinyint and smallint are not touched, and NaN counts as missing.
    """
    skip = set(exclude)

    def change(field: T.StructField) -> Column:
        column = quoted(field.name)
        if _is_string(field):
            column = F.trim(column) if trim else column
            fill = text
        elif isinstance(field.dataType, FILLED_NUMERIC):
            if isinstance(field.dataType, (T.DoubleType, T.FloatType)) and number is not None:
                column = F.nanvl(column, F.lit(None))
            fill = number
        else:
            fill = None
        if fill is not None and field.name not in skip:
            column = F.coalesce(column, F.lit(fill).cast(field.dataType))
        elif not (trim and _is_string(field)):
            return quoted(field.name)
        return column.alias(field.name)

    return df.select(*[change(f) for f in df.schema.fields])


def fill_strings(df: DataFrame, replacement: str = UNKNOWN, exclude: Iterable[str] = ()) -> DataFrame:
    """Replace NULL strings; columns in ``exclude`` (foreign keys) keep their NULLs."""
    return tidy(df, text=replacement, exclude=exclude)


def fill_numbers(df: DataFrame, replacement: float = 0, exclude: Iterable[str] = ()) -> DataFrame:
    """Replace NULL numbers by type; tinyint and smallint are not touched."""
    return tidy(df, number=replacement, exclude=exclude)


def to_dates(df: DataFrame, columns: Sequence[str], pattern: str = "yyyy-MM-dd") -> DataFrame:
    """Parse string columns; text that is no date becomes NULL instead of failing."""
    return df.withColumns({c: F.try_to_date(quoted(c), pattern) for c in columns})


def blank_dates_to_null(df: DataFrame, columns: Sequence[str] = (), pattern: str = "yyyy-MM-dd") -> DataFrame:
    """Blank date *strings* become NULL dates; columns that are dates already stay as they are."""
    kinds = dict(df.dtypes)
    parsed = {
        c: F.try_to_date(F.nullif(F.trim(quoted(c)), F.lit("")), pattern) for c in columns if kinds[c] == "string"
    }
    return df.withColumns(parsed) if parsed else df


def add_created_at(df: DataFrame, as_of: Clock) -> DataFrame:
    return df.withColumn("_created_at", as_timestamp(as_of))


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def cast(df: DataFrame, types: Mapping[str, str], strict: bool = True) -> DataFrame:
    """Cast columns; ``strict=False`` turns text that does not fit into NULL."""
    return df.withColumns({c: quoted(c).cast(t) if strict else quoted(c).try_cast(t) for c, t in types.items()})


def format_phones(df: DataFrame, columns: Sequence[str], strict: bool = False) -> DataFrame:
    return df.withColumns({c: egypt_phone(quoted(c), strict) for c in columns})


def restore_leading_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Give back the zero that a phone lost when it was read as a number."""
    return df.withColumns({c: with_leading_zero(quoted(c)) for c in columns})


def apply_overrides(df: DataFrame, overrides: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Replace columns by the values of a correction table where it has one.

    ``overrides`` holds one row per key. Spark broadcasts it when its measured
    size allows and joins by shuffle beyond that.
    """
    fixes = overrides.select(
        quoted(key).alias("_override_key"), *[quoted(c).alias(f"_override_{c}") for c in columns]
    )
    joined = df.join(fixes, quoted(key) == F.col("_override_key"), "left")
    return joined.withColumns({c: F.coalesce(F.col(f"_override_{c}"), quoted(c)) for c in columns}).drop(
        *fixes.columns
    )


def concat_columns(df: DataFrame, names: Mapping[str, Sequence[str]], separator: str = "-") -> DataFrame:
    """Join columns into new ones, leaving out NULL parts."""
    return df.withColumns({new: F.concat_ws(separator, *[quoted(p) for p in parts]) for new, parts in names.items()})


def full_name(df: DataFrame, target: str, parts: Sequence[str], separator: str = " ") -> DataFrame:
    return concat_columns(df, {target: parts}, separator).drop(*parts)


def add_age(df: DataFrame, as_of: Clock, birth_date: str = "birth_date", target: str = "patient_age") -> DataFrame:
    return df.withColumn(target, years_between(as_of, quoted(birth_date)))
