"""CSV sources: folder discovery, scans by column name and file lineage."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.functions.expressions import Clock, as_timestamp


#: The column that holds the raw line of a row that could not be read.
REJECTED = "_rejected_row"
#: Files whose headers are read at the same time.
HEADER_THREADS = 32


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV files that all have the same header row. Without a schema Spark infers one in an extra pass."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_header(spark: SparkSession, path: str) -> tuple[str, ...] | None:
    """Column names of one file, from its first line that is not blank; None for an empty file.

    The file is opened by the cluster's own file system, wherever it is, and only its
    beginning is read. Names that are left empty are numbered.
    """
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    opened = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(opened, "UTF-8"))
    try:
        line = reader.readLine()
        while line is not None and not line.strip():
            line = reader.readLine()
    finally:
        reader.close()
    if line is None:
        return None
    names = next(csv.reader([line.lstrip("\ufeff")], skipinitialspace=True, strict=True))
    return tuple(name.strip() or f"_c{i}" for i, name in enumerate(names))


def group_by_header(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """The files of each header; what comes to the driver is one line of each file."""
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        headers = list(pool.map(lambda path: read_header(spark, path), paths))
    groups: dict[tuple[str, ...], list[str]] = {}
    for header, path in sorted(zip(headers, paths), key=lambda found: found[1]):
        if header is not None:
            groups.setdefault(header, []).append(path)
    return groups


def _common_type(kinds: Sequence[T.DataType]) -> T.DataType:
    """One type for all files: the same, the widest number, or text."""
    widening = [T.IntegerType(), T.LongType(), T.DoubleType()]
    if all(kind == kinds[0] for kind in kinds):
        return kinds[0]
    return max(kinds, key=widening.index) if all(kind in widening for kind in kinds) else T.StringType()


def _inferred(spark: SparkSession, groups: dict[tuple[str, ...], list[str]]) -> dict[str, T.DataType]:
    """Types by lower-case name, from one extra pass over each group; columns without values decide nothing."""
    found: dict[str, list[T.DataType]] = {}
    for header, paths in groups.items():
        read = spark.read.option("header", True).option("inferSchema", True).option("preferDate", True).csv(paths)
        for name, field in zip(header, read.schema.fields):
            found.setdefault(name.lower(), []).append(field.dataType)
    return {name: _common_type(kinds) for name, kinds in found.items()}


def read_csv_by_name(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType | str | None = None
) -> list[DataFrame]:
    """Files of one table, each by its own header: one DataFrame for each header, all with the same columns.

    Columns are matched by name, without regard to case or order, and spelled as in
    ``schema``, or as in the first file that has them. A column that a file lacks is NULL;
    one that the schema lacks is read as text. A row that does not fit, by its number of
    values or by their types, has its raw line in ``REJECTED``. Names that a header holds
    twice are an error.
    """
    groups = group_by_header(spark, paths)
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    for names, place in [(header, files[0]) for header, files in groups.items()] + [(declared.names if declared else (), "the schema")]:
        if len({name.lower() for name in names}) < len(names):
            raise ValueError(f"{place} names a column twice: {', '.join(names)}")
    kinds = _inferred(spark, groups) if declared is None else {f.name.lower(): f.dataType for f in declared.fields}
    spelling = {f.name.lower(): f.name for f in declared.fields} if declared is not None else {}
    for header in groups:
        for name in header:
            spelling.setdefault(name.lower(), name)

    def kind_of(name: str) -> T.DataType:
        return kinds.get(name.lower(), T.StringType())

    def read(header: tuple[str, ...], files: list[str]) -> DataFrame:
        own = [T.StructField(spelling[name.lower()], kind_of(name)) for name in header]
        reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", REJECTED)
        rows = reader.schema(T.StructType([*own, T.StructField(REJECTED, T.StringType())])).csv(files)
        held = {f.name for f in own}
        missing = {c: F.lit(None).cast(kind_of(c)) for c in spelling.values() if c not in held}
        return rows.withColumns(missing)

    if not groups:
        fields = [] if declared is None else declared.fields
        empty = T.StructType([*fields, T.StructField(REJECTED, T.StringType())])
        return [spark.read.schema(empty).csv(list(paths))] if paths else []
    return [read(header, files) for header, files in groups.items()]


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda left, right: left.unionByName(right), frames)


def discover_csv(spark: SparkSession, path: str) -> DataFrame:
    """One row per CSV file under a folder, with the table it belongs to.

    The table is the lower-cased stem of the first ``*.csv`` name in the path, so
    ``claim.csv`` may be a file or a folder of part files. Only the listing is
    read: the file contents are pruned from the scan.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length", "modificationTime")
    )

    def plain(pattern: str) -> Column:
        # A plus sign stands for itself in a path.
        return F.url_decode(F.replace(F.regexp_extract("path", pattern, 1), F.lit("+"), F.lit("%2B")))

    source = plain(r"/([^/]+)\.csv(/|$)")
    return listing.select(
        F.lower(source).alias("table_name"),
        F.concat(source, F.lit(".csv")).alias("source_name"),
        plain(r"^(.*?/[^/]+\.csv)(/|$)").alias("source_path"),
        plain("^(.*)$").alias("file_path"),
        F.col("length").alias("file_size_bytes"),
        F.col("modificationTime").alias("file_modified_time"),
    )


def with_source_metadata(df: DataFrame) -> DataFrame:
    """Lineage of each row's file, taken from the scan itself."""
    return df.withColumns(
        {
            "source_file": F.col("_metadata.file_name"),
            "source_file_path": F.col("_metadata.file_path"),
            "source_file_modified_time": F.col("_metadata.file_modification_time"),
            "source_file_size": F.col("_metadata.file_size"),
        }
    )


def with_ingestion_audit(df: DataFrame, run_id: str, loaded_at: Clock) -> DataFrame:
    """Audit columns of a raw load; ``ingestion_date`` is the partition column."""
    moment = as_timestamp(loaded_at)
    return (
        with_source_metadata(df)
        .drop("source_file_size")
        .withColumns(
            {
                "ingestion_timestamp": moment,
                "ingestion_date": moment.cast("date"),
                "pipeline_run_id": F.lit(run_id),
            }
        )
    )
