"""The same batch merge, driven by newly arrived files.

A stream reads the files that were added to a folder since the last run, merges
them into a table and stops. The merge is idempotent, so a batch that is delivered
again after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from wardflow.operators.cleaning import remove_duplicates
from wardflow.operators.upsert import upsert_partitions
from wardflow.sinks.store import TableStore


def arriving_csv(spark: SparkSession, folder: str, schema: str, max_files: int = 1000) -> DataFrame:
    """New CSV files of a folder, a bounded number per batch."""
    reader = spark.readStream.schema(schema).option("header", True).option("maxFilesPerTrigger", max_files)
    return reader.csv(folder)


def merge_available(
    stream: DataFrame,
    store: TableStore,
    name: str,
    keys: Sequence[str],
    partition: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
    **rules,
) -> StreamingQuery:
    """Merge everything that has arrived so far and stop."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        upsert_partitions(store, name, remove_duplicates(prepare(batch), keys), keys, partition, **rules)

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
