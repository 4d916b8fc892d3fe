"""Set-based data quality checks.

Row rules of a table run in one pass: each is a counted condition of the same
aggregate. Rules about groups (keys, references, quartiles) are separate plans.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.expressions import Clock, as_date
from wardflow.operators.cleaning import quoted
from wardflow.operators.joins import join_feeder
from wardflow.operators.ordering import exact_quantiles, number_series

# Shapes of a valid e-mail and phone.
EMAIL_SHAPE = "%_@%.%"
PHONE_SHAPE = "+__-___-___-____"


@dataclass(frozen=True)
class Rule:
    """``failed`` is true on a bad row; an unknown result counts as good."""

    check: str
    column: str
    failed: Column


def untrimmed(column: str) -> Rule:
    return Rule("untrimmed", column, quoted(column) != F.trim(quoted(column)))


def email_shape(column: str) -> Rule:
    return Rule("email_shape", column, quoted(column).isNull() | ~quoted(column).like(EMAIL_SHAPE))


def phone_shape(column: str) -> Rule:
    return Rule("phone_shape", column, quoted(column).isNull() | ~quoted(column).like(PHONE_SHAPE))


def is_missing(column: str, check: str = "missing") -> Rule:
    return Rule(check, column, quoted(column).isNull())


def in_domain(column: str, allowed: Sequence[str]) -> Rule:
    return Rule("domain", column, ~quoted(column).isin(*allowed))


def ordered(first: str, second: str) -> Rule:
    """``first`` must not be greater than ``second`` (dates or amounts)."""
    return Rule("order", f"{first},{second}", quoted(first) > quoted(second))


def _holds(rule: Rule) -> Column:
    return F.coalesce(rule.failed, F.lit(False))


def failing_rows(df: DataFrame, rule: Rule) -> DataFrame:
    return df.filter(_holds(rule))


def run_checks(df: DataFrame, table: str, rules: Sequence[Rule], key: str) -> DataFrame:
    """``(check, table_name, column_name, failed_rows, sample_key)``, one row per rule, one scan."""
    measures = []
    for i, rule in enumerate(rules):
        measures.append(F.count_if(_holds(rule)).alias(f"n_{i}"))
        measures.append(F.min(F.when(_holds(rule), quoted(key).cast("string"))).alias(f"k_{i}"))
    findings = F.array(
        *[
            F.struct(
                F.lit(r.check).alias("check"),
                F.lit(table).alias("table_name"),
                F.lit(r.column).alias("column_name"),
                F.col(f"n_{i}").alias("failed_rows"),
                F.col(f"k_{i}").alias("sample_key"),
            )
            for i, r in enumerate(rules)
        ]
    )
    return df.agg(*measures).select(F.inline(findings))


def primary_key_violations(df: DataFrame, key: str) -> DataFrame:
    """Key values that are NULL or occur more than once, with their row count."""
    counted = df.groupBy(quoted(key).alias("key_value")).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.filter((F.col("row_count") > 1) | F.col("key_value").isNull())


def domain_listing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of each column with their counts."""
    long = df.select(*[quoted(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "value"
    )
    return long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("row_count"))


def orphan_keys(df: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose reference points to no parent row."""
    parents = parent.select(quoted(parent_key).alias("_parent")).distinct()
    return df.filter(quoted(column).isNotNull()).join(parents, quoted(column) == F.col("_parent"), "left_anti")


def iqr_fences(watched: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> dict[tuple[str, str], tuple[float, float]]:
    """First and third quartile of each (table, column): two numbers per column.

    All columns of all tables are ranked in the same pass.
    """
    parts = [number_series(df, columns, f"{table}.") for table, (df, columns) in watched.items()]
    found = exact_quantiles(reduce(DataFrame.unionByName, parts), [0.25, 0.75]).collect()
    value = {(r["series"], r["probability"]): r["value"] for r in found}
    names = [(t, c) for t, (_, columns) in watched.items() for c in columns]
    return {n: (value[".".join(n), 0.25], value[".".join(n), 0.75]) for n in names if (".".join(n), 0.25) in value}


def outlier_values(df: DataFrame, key: str, quartiles: Mapping[str, tuple[float, float]], factor: float = 1.5) -> DataFrame:
    """``(row_id, column_name, value, q1, q3)`` beyond ``factor`` interquartile ranges, all columns in one pass."""
    none = df.select(F.col(key).alias("row_id")).limit(0)
    schema = "array<struct<column_name:string,value:double,q1:double,q3:double>>"
    tests, fences = [], []
    for column, (q1, q3) in quartiles.items():
        value, reach = quoted(column).cast("double"), factor * (q3 - q1)
        fences.append((quoted(column) < F.lit(q1 - reach)) | (quoted(column) > F.lit(q3 + reach)))
        told = [F.lit(column).alias("column_name"), value.alias("value"), F.lit(q1).alias("q1"), F.lit(q3).alias("q3")]
        tests.append(F.when(fences[-1], F.struct(*told)))
    if not tests:
        return none.select("row_id", F.inline(F.array().cast(schema)))
    found = F.array_compact(F.array(*tests).cast(schema))
    # The fences are literals, so the comparison is pushed to the scan.
    far = df.filter(reduce(or_, fences))
    return far.select(F.col(key).alias("row_id"), F.inline(found))


def reference_findings(
    df: DataFrame, table: str, references: Mapping[str, tuple[DataFrame, str]]
) -> DataFrame:
    """``(table_name, column_name, finding, row_count)``: NULL and dangling references, one aggregate for all columns."""
    child = df.select(*[quoted(c).alias(c) for c in references])
    for i, (column, (parent, parent_key)) in enumerate(references.items()):
        known = parent.select(quoted(parent_key).alias(column)).distinct().withColumn(f"_known_{i}", F.lit(True))
        child = join_feeder(child, known, [column])
    measures = []
    for i, column in enumerate(references):
        missing = quoted(column).isNull()
        measures.append(F.count_if(missing).alias(f"null_{i}"))
        measures.append(F.count_if(~missing & F.col(f"_known_{i}").isNull()).alias(f"orphan_{i}"))
    told = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.lit(kind).alias("finding"),
            F.col(f"{kind}_{i}").alias("row_count"),
        )
        for i, column in enumerate(references)
        for kind in ("null", "orphan")
    ]
    return child.agg(*measures).select(F.inline(F.array(*told)))


def invalid_rows(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows failing any rule, with the names of the rules they fail."""
    failed = {name: F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}
    reasons = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in failed.items()]))
    return df.filter(reduce(or_, failed.values())).withColumn("failed_rules", F.array_join(reasons, ","))


# Domains of a valid patient.
GENDERS = ("Male", "Female")
BLOOD_TYPES = ("A+", "A-", "B+", "B-", "AB+", "AB-", "O+", "O-")


def patient_rules(as_of: Clock) -> dict[str, Column]:
    today = as_date(as_of)
    phone = F.col("phone").cast("string")
    return {
        "patient_id_missing": F.col("patient_id").isNull(),
        "national_id_missing": F.col("national_id").isNull(),
        "birth_date_in_future": F.col("birth_date") > today,
        "negative_age": F.year(today) - F.year("birth_date") < 0,
        "gender_unknown": ~F.col("gender").isin(*GENDERS),
        "blood_type_unknown": ~F.col("blood_type").isin(*BLOOD_TYPES),
        "phone_is_emergency_contact": F.col("phone") == F.col("emergency_contact"),
        "phone_length": F.length(phone) != 10,
        "national_id_not_numeric": ~F.col("national_id").rlike("^[0-9]+$"),
    }
