"""Column expressions shared by the cleaning, warehouse and mart plans."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Clock = dt.date | dt.datetime | str


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def as_date(value: Clock | Column) -> Column:
    """The run date as a literal, so that a rerun gives the same rows."""
    return value if isinstance(value, Column) else F.lit(str(value)[:10]).cast("date")


def as_timestamp(value: Clock | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp")


# Arithmetic ------------------------------------------------------------------


def round2(value: str | Column) -> Column:
    """Round half up to two places, independent of the order a sum was added in.

    A double sum carries noise in its last digits that depends on partitioning;
    going through eight decimals first removes it before the rounding decision.
    """
    return F.round(as_column(value).cast("decimal(30,8)"), 2).cast("double")


def zero_if_null(value: str | Column) -> Column:
    return F.coalesce(as_column(value), F.lit(0))


def rounded_or_zero(value: str | Column) -> Column:
    return round2(F.coalesce(as_column(value).cast("double"), F.lit(0.0)))


def safe_divide(numerator: str | Column, denominator: str | Column) -> Column:
    """Quotient as double; NULL for a zero or missing denominator."""
    return F.try_divide(as_column(numerator).cast("double"), as_column(denominator).cast("double"))


def ratio_when_positive(numerator: str | Column, denominator: str | Column, scale: float = 1.0) -> Column:
    """``scale * n / d`` rounded where d > 0 (NULL if n is), and 0 elsewhere."""
    d = as_column(denominator)
    quotient = F.try_divide(as_column(numerator).cast("double") * scale, d.cast("double"))
    return F.when(d > 0, round2(quotient)).otherwise(F.lit(0.0))


def percent_when_positive(numerator: str | Column, denominator: str | Column) -> Column:
    return ratio_when_positive(numerator, denominator, 100.0)


# Labels ----------------------------------------------------------------------

_COMPARE = {
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    "=": lambda c, v: c == v,
}


def band(value: str | Column, steps: Sequence[tuple[str, float, str]], default: str | None = None) -> Column:
    """First label whose comparison holds; NULL values and gaps get the default."""
    column = as_column(value)
    labelled = None
    for operator, edge, label in steps:
        test = _COMPARE[operator](column, F.lit(edge))
        labelled = F.when(test, label) if labelled is None else labelled.when(test, label)
    return labelled.otherwise(F.lit(default))


def high_medium_low(value: str | Column, high: float, low: float, labels: Sequence[str], default: str) -> Column:
    """Above ``high``, from ``low`` to ``high`` inclusive, below ``low``; NULL → default."""
    top, middle, bottom = labels
    return band(value, [(">", high, top), (">=", low, middle), ("<", low, bottom)], default)


def flag(condition: Column) -> Column:
    """Stored 0/1 flag; an unknown condition is 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


# Dates -----------------------------------------------------------------------


def date_key(value: str | Column) -> Column:
    d = as_column(value)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def years_between(as_of: Clock | Column, birth_date: str | Column) -> Column:
    """Difference of the calendar years, not birthday-aware."""
    return F.year(as_date(as_of)) - F.year(as_column(birth_date))


# Text ------------------------------------------------------------------------


def phone_text(value: str | Column) -> Column:
    """Digits of a phone as text; a double is widened so it never prints as 1.0E9."""
    column = as_column(value)
    return column.cast("decimal(20,0)").cast("string")


def with_leading_zero(value: str | Column) -> Column:
    return F.concat(F.lit("0"), phone_text(value))


def egypt_phone(value: str | Column, strict: bool = False) -> Column:
    """``+20-AAA-BBB-CCCC`` from any spelling of the number.

    One leading zero and then the country code are dropped. ``strict`` gives NULL
    unless ten digits remain; otherwise short input yields a short pattern.
    """
    digits = F.regexp_replace(as_column(value), "[^0-9]", "")
    local = F.regexp_replace(digits, "^0?(20)?", "")
    text = F.concat(
        F.lit("+20-"), local.substr(1, 3), F.lit("-"), local.substr(4, 3), F.lit("-"), local.substr(7, 4)
    )
    return F.when(F.length(local) == 10, text) if strict else text


# Choosing one row of a group without ordering the whole group ------------------


def latest(value: Column | str, *order: str | Column) -> Column:
    """Aggregate: the value on the row that is last in ``order`` (a map-side max)."""
    return F.max_by(as_column(value), F.struct(*[as_column(o) for o in order]))


def earliest(value: Column | str, *order: str | Column) -> Column:
    return F.min_by(as_column(value), F.struct(*[as_column(o) for o in order]))
