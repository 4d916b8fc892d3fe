"""JDBC table scan, split over executors when the table has a numeric key."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Split:
    """Read in ``partitions`` ranges of a numeric or date column."""

    column: str
    lower: str | int
    upper: str | int
    partitions: int


def jdbc_options(
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    split: Split | None = None,
    fetch_size: int = 10_000,
    user_env: str = "JDBC_USER",
    password_env: str = "JDBC_PASSWORD",
) -> dict[str, str]:
    """Reader options; credentials come from the environment, never from code."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    for option, variable in (("user", user_env), ("password", password_env)):
        if variable in os.environ:
            options[option] = os.environ[variable]
    options.update(properties or {})
    if split is not None:
        options.update(
            partitionColumn=split.column,
            lowerBound=str(split.lower),
            upperBound=str(split.upper),
            numPartitions=str(split.partitions),
        )
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **settings) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **settings)).load()
