"""CSV folder → audited, day-partitioned raw tables with load metrics."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from wardflow.functions.expressions import Clock, as_date, as_timestamp, round2
from wardflow.operators.cleaning import quoted
from wardflow.sinks.store import TableStore, counted, validate_load
from wardflow.sources.files import REJECTED, discover_csv, read_csv_by_name, union_by_name, with_ingestion_audit

METRICS_TABLE = "data_quality_metrics"
METRICS_SCHEMA = (
    "pipeline_run_id string, table_name string, load_timestamp string, row_count bigint, column_count int, "
    "total_null_values bigint, null_percentage double, file_size_bytes bigint, "
    "processing_duration_sec double, status string, error_message string, rejected_rows bigint"
)


def null_percentage(nulls: int, rows: int, columns: int) -> float:
    return round(nulls / (rows * columns) * 100, 2) if rows and columns else 0.0


def rejects_table(name: str) -> str:
    return f"{name}_rejects"


def load_table(
    store: TableStore, name: str, paths: Sequence[str], run_id: str, loaded_at: Clock, schema: str | None = None
) -> dict:
    """Load the CSV files of one table and measure the load while it is written.

    Files are read by their own headers. A column that the table does not have yet is
    added to it. Rows that do not fit go, as raw lines with their file, to the table's
    rejects, in place of those of an earlier load of the day. Row and NULL counts come
    from the write, of the rows as they are stored, so a load is one write plus the read-back count;
    only where it met rejected rows are the files read again, for these.
    """
    started = time.monotonic()
    audited = union_by_name([with_ingestion_audit(part, run_id, loaded_at) for part in read_csv_by_name(store.spark, paths, schema)])
    watch_all = Observation()
    watched = audited.observe(watch_all, F.count_if(quoted(REJECTED).isNotNull()).alias("rejected"))
    fitted = store.fitted(name, watched.filter(quoted(REJECTED).isNull()).drop(REJECTED), evolve=True)
    given = audited.columns[: audited.columns.index("source_file")]
    columns = [c for c in given if c != REJECTED]
    good, watch = counted(fitted, columns)
    about = ["pipeline_run_id", "source_file", "source_file_path", "ingestion_timestamp", "ingestion_date"]
    # Spark reads raw lines only beside another column: how many values of a row could be read.
    parsed = F.array_size(F.array_compact(F.array(*[F.when(quoted(c).isNotNull(), 1) for c in columns]))).alias("parsed_values")
    rejects = audited.filter(quoted(REJECTED).isNotNull()).select(quoted(REJECTED).alias("raw_row"), parsed, *about)
    table = store.replace_partitions(name, good, ["ingestion_date"])
    seen, rejected = watch.get, watch_all.get["rejected"]
    rows = seen["rows"]
    day = {"ingestion_date": str(loaded_at)[:10]}
    if not rows:
        table = store.drop_partitions(name, [day])
    if rejected:
        store.replace_partitions(rejects_table(name), rejects, ["ingestion_date"])
    elif store.exists(rejects_table(name)):
        store.drop_partitions(rejects_table(name), [day])
    nulls = sum(seen[f"nulls_{i}"] for i in range(len(columns)))
    written = table.filter(F.col("ingestion_date") == as_date(loaded_at))
    return {
        "row_count": rows,
        "column_count": len(columns),
        "total_null_values": nulls,
        "null_percentage": null_percentage(nulls, rows, len(columns)),
        "status": validate_load(rows, written),
        "processing_duration_sec": round(time.monotonic() - started, 2),
        "error_message": None,
        "rejected_rows": rejected,
    }


def ingest_folder(
    store: TableStore,
    folder: str,
    run_id: str,
    loaded_at: Clock,
    schemas: Mapping[str, str] | None = None,
    parallel: int = 4,
) -> DataFrame:
    """Load every CSV source of a folder; returns this run's metrics and appends them to the history.

    Tables are independent, so a few load side by side; sources whose names differ only
    in case or folder are one table and load together, by column name. Whatever makes a table fail is
    recorded with zeros and its error, and the others still load.
    """
    sources = (
        discover_csv(store.spark, folder)
        .groupBy("table_name")
        .agg(F.sum("file_size_bytes").alias("size"), F.array_sort(F.collect_set("file_path")).alias("paths"))
        .orderBy("table_name")
        .collect()
    )

    def load(source) -> dict:
        name = source["table_name"]
        base = {"pipeline_run_id": run_id, "table_name": store.full_name(name), "load_timestamp": str(loaded_at)}
        try:
            measured = load_table(store, name, source["paths"], run_id, loaded_at, (schemas or {}).get(name))
            return {**base, **measured, "file_size_bytes": source["size"]}
        except Exception as error:  # noqa: BLE001
            return {
                **base,
                "row_count": 0,
                "column_count": 0,
                "total_null_values": 0,
                "null_percentage": 0.0,
                "file_size_bytes": 0,
                "processing_duration_sec": 0.0,
                "status": "FAILED",
                "error_message": str(error),
                "rejected_rows": 0,
            }

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        results = list(pool.map(load, sources))
    order = [part.split()[0] for part in METRICS_SCHEMA.split(", ")]
    metrics = store.spark.createDataFrame([tuple(r[c] for c in order) for r in results], METRICS_SCHEMA)
    metrics = metrics.withColumn("load_timestamp", F.col("load_timestamp").cast("timestamp"))
    store.append_evolving(METRICS_TABLE, metrics)
    return metrics


def metrics_history(metrics: DataFrame) -> DataFrame:
    """Past loads, newest first, with sizes in megabytes."""
    return metrics.select(
        "pipeline_run_id",
        "table_name",
        "load_timestamp",
        "row_count",
        "column_count",
        "total_null_values",
        "null_percentage",
        round2(F.col("file_size_bytes") / 1024 / 1024).alias("file_size_mb"),
        "processing_duration_sec",
        "status",
        "rejected_rows",
    ).orderBy(F.desc("load_timestamp"), "table_name")
