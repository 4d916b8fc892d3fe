"""Parquet tables in the session catalog: snapshots, appends, partition replacement.

Rows are always written to a new folder, and catalog entries, of a table or of single
partitions, are then moved there. So a table can be rewritten from itself, a failed
write leaves the old rows, and readers never meet a half-written partition. A writer
never drops a column it was given: it adds it to the table, or refuses the rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.operators.cleaning import quoted
from wardflow.session import remove_children

#: Fixed value: how a folder is named whose partition value is NULL.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
#: Catalog entries that are moved at the same time, and that one statement adds or drops.
CATALOG_THREADS = 8
CATALOG_BATCH = 500


def by_lower_name(names: Iterable[str]) -> dict[str, str]:
    """Each name under its lower-case form; two that differ only in case are refused."""
    found: dict[str, str] = {}
    for name in names:
        if name.lower() in found:
            raise ValueError(f"columns {found[name.lower()]!r} and {name!r} differ only in case")
        found[name.lower()] = name
    return found


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast, order and NULL-fill a DataFrame to a declared schema; other columns are left out.

    Columns are matched without regard to case and take the declared spelling.
    """
    present = by_lower_name(df.columns)
    return df.select(
        *[
            (quoted(present[f.name.lower()]) if f.name.lower() in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def quoted_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


@dataclass
class TableStore:
    spark: SparkSession
    root: str
    database: str = "lake"

    def __post_init__(self) -> None:
        place = f"{self.root.rstrip('/')}/{self.database}.db"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{place}'")

    def full_name(self, name: str) -> str:
        return f"{self.database}.{name}"

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.full_name(name))

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self.full_name(name))

    def table_or_empty(self, name: str, schema: T.StructType) -> DataFrame:
        """The table, or no rows of its declared schema before the first load."""
        return self.table(name) if self.exists(name) else self.spark.createDataFrame([], schema)

    def _new_folder(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}/snapshot-{uuid.uuid4().hex}"

    def overwrite(
        self, name: str, df: DataFrame, partition_by: Sequence[str] = (), rebalance: bool = False
    ) -> DataFrame:
        """Replace rows and schema. ``rebalance`` evens out file sizes first, within partitions."""
        folder = self._new_folder(name)
        writer = (df.hint("rebalance", *partition_by) if rebalance else df).write.mode("errorifexists")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder)
        return self._point_at(name, folder, partition_by, df.schema)

    def _point_at(self, name: str, folder: str, partition_by: Sequence[str], schema: T.StructType) -> DataFrame:
        """Publish a snapshot. Readers find the table at any moment.

        Its entry, and those of its partitions, are moved to the new folder, after new
        columns were added; partitions that the snapshot lacks go last. Only a table whose
        columns changed type or went away, or that is partitioned otherwise, gets a new entry.
        """
        full = self.full_name(name)
        if self.exists(name) and self.partition_columns(name) == list(partition_by):
            kinds = {f.name: f.dataType for f in self.table(name).schema.fields}
            fresh = {f.name: f.dataType for f in schema.fields}
            if all(fresh.get(c) == kind for c, kind in kinds.items()):
                self.add_columns(name, schema)
                before = self.partitions(name) if partition_by else []
                self._set_location(full, folder)
                if partition_by:
                    now = self._publish(name, folder, partition_by, schema)
                    self._drop_partitions(name, [spec for spec in before if spec not in now])
                self.spark.catalog.refreshTable(full)
                return self.table(name)
        # An external table: dropping the entry leaves the older snapshot's files.
        self.spark.sql(f"DROP TABLE IF EXISTS {full}")
        columns = ", ".join(f"{quoted_name(f.name)} {f.dataType.simpleString()}" for f in _partitions_last(schema, partition_by))
        by = f" PARTITIONED BY ({', '.join(map(quoted_name, partition_by))})" if partition_by else ""
        self.spark.sql(f"CREATE TABLE {full} ({columns}) USING parquet{by} LOCATION {literal(folder)}")
        if partition_by:
            self.spark.catalog.recoverPartitions(full)
        return self.table(name)

    def _set_location(self, full: str, folder: str, spec: Mapping[str, str | None] | None = None) -> None:
        self.spark.sql(f"ALTER TABLE {full}{spelled(spec) if spec else ''} SET LOCATION {literal(folder)}")

    def _publish(
        self, name: str, folder: str, partition_by: Sequence[str], schema: T.StructType
    ) -> list[dict[str, str | None]]:
        """Move the catalog entry of each partition in a folder there, one by one; the others stay.

        A reader sees each partition as it was before or as it is now. Each entry is one
        call of the catalog; nothing is read but the list of files.
        """
        full = self.full_name(name)
        files = self.spark.read.schema(schema).parquet(folder).inputFiles()
        folders = {file.rpartition("/")[0] for file in files}
        found = {place: partition_of(place, len(partition_by)) for place in sorted(folders)}
        known = self.partitions(name)
        new = {place: spec for place, spec in found.items() if spec not in known}
        moved = {place: spec for place, spec in found.items() if spec in known}
        added = [f"{spelled(spec)} LOCATION {literal(plain_path(place))}" for place, spec in new.items()]
        for k in range(0, len(added), CATALOG_BATCH):
            self.spark.sql(f"ALTER TABLE {full} ADD IF NOT EXISTS {' '.join(added[k : k + CATALOG_BATCH])}")
        with ThreadPoolExecutor(CATALOG_THREADS) as pool:
            list(pool.map(lambda at: self._set_location(full, plain_path(at[0]), at[1]), moved.items()))
        return list(found.values())

    def partitions(self, name: str) -> list[dict[str, str | None]]:
        """Values of all partitions, from the catalog alone."""
        rows = self.spark.sql(f"SHOW PARTITIONS {self.full_name(name)}").collect()
        return [partition_of(r["partition"], r["partition"].count("/") + 1) for r in rows]

    def _drop_partitions(self, name: str, specs: Sequence[Mapping[str, str | None]]) -> None:
        """Take partitions out of the catalog; their files stay until old snapshots are dropped."""
        for k in range(0, len(specs), CATALOG_BATCH):
            listed = ", ".join(map(spelled, specs[k : k + CATALOG_BATCH]))
            self.spark.sql(f"ALTER TABLE {self.full_name(name)} DROP IF EXISTS {listed}")

    def partition_columns(self, name: str) -> list[str]:
        """Columns a table is partitioned by."""
        return [c.name for c in self.spark.catalog.listColumns(self.full_name(name)) if c.isPartition]

    def location(self, name: str) -> str:
        found = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.full_name(name)}")
        return found.filter("col_name = 'Location'").first()["data_type"]

    def add_columns(self, name: str, given: DataFrame | T.StructType) -> None:
        """Declare the columns that the table lacks; they are NULL in its older rows."""
        schema = given.schema if isinstance(given, DataFrame) else given
        known = by_lower_name(self.table(name).columns)
        new = [schema[c] for lower, c in by_lower_name(schema.fieldNames()).items() if lower not in known]
        if new:
            declared = ", ".join(f"{quoted_name(f.name)} {f.dataType.simpleString()}" for f in new)
            self.spark.sql(f"ALTER TABLE {self.full_name(name)} ADD COLUMNS ({declared})")

    def fitted(self, name: str, df: DataFrame, evolve: bool = False) -> DataFrame:
        """``df`` in the table's columns, spelling and types, as its writers store it.

        Unknown columns are added to the table, or refused. Before the first load of a
        table ``df`` is as it will be.
        """
        given = by_lower_name(df.columns)
        if not self.exists(name):
            return df
        unknown = sorted(given.keys() - by_lower_name(self.table(name).columns).keys())
        if unknown and not evolve:
            raise ValueError(f"{self.full_name(name)} has no columns {unknown}")
        if unknown:
            self.add_columns(name, df)
        return conform(df, self.table(name).schema)

    def append(self, name: str, df: DataFrame, evolve: bool = False) -> DataFrame:
        """Add rows; the table keeps its column order and types.

        A column that the table lacks is an error, or is added with ``evolve``.
        """
        if not self.exists(name):
            return self.overwrite(name, df)
        self.fitted(name, df, evolve).write.mode("append").insertInto(self.full_name(name))
        return self.table(name)

    def append_evolving(self, name: str, df: DataFrame) -> DataFrame:
        """Add rows that may bring new columns; missing values are NULL on both sides."""
        return self.append(name, df, evolve=True)

    def replace_partitions(
        self,
        name: str,
        df: DataFrame,
        partition_by: Sequence[str],
        evolve: bool = False,
        emptied: Sequence[Mapping[str, object]] = (),
        rebalance: bool = False,
    ) -> DataFrame:
        """Replace only the partitions that the rows fall in, and take out the ``emptied`` ones.

        All others stay. New rows go to a fresh folder and the catalog entries of their
        partitions are moved there, so a reader finds each partition whole, old or new, and a
        load that dies leaves the table as it was. ``emptied`` gives partition columns and values.
        With ``rebalance`` the rows of a partition are brought together first, in files of
        the advised size, instead of a small file from every task.
        """
        if not self.exists(name):
            return self.overwrite(name, df, partition_by, rebalance)
        if self.partition_columns(name) != list(partition_by):
            raise ValueError(f"{self.full_name(name)} is not partitioned by {list(partition_by)}")
        fitting = self.fitted(name, df, evolve)
        folder = self._new_folder(name)
        writer = (fitting.hint("rebalance", *partition_by) if rebalance else fitting).write.mode("errorifexists")
        writer.partitionBy(*partition_by).parquet(folder)
        # New partitions of a later append go below the table's own folder: it must not
        # hold files of partitions that were replaced or taken out.
        self._set_location(self.full_name(name), folder)
        self._publish(name, folder, partition_by, fitting.schema)
        self._drop_partitions(name, [_as_spec(spec) for spec in emptied])
        self.spark.catalog.refreshTable(self.full_name(name))
        return self.table(name)

    def drop_partitions(self, name: str, emptied: Sequence[Mapping[str, object]]) -> DataFrame:
        """Take partitions out of the table, given by partition columns and values; no file is rewritten."""
        self._set_location(self.full_name(name), self._new_folder(name))
        self._drop_partitions(name, [_as_spec(spec) for spec in emptied])
        self.spark.catalog.refreshTable(self.full_name(name))
        return self.table(name)

    def drop_old_snapshots(self, name: str) -> int:
        """Remove the folders, of snapshots and of single partitions, that the table no longer refers to.

        Returns their number. Call it when no reader uses an older state any more.
        """
        root, below = f"{self.root.rstrip('/')}/{name}", f"/{name}/"
        used = [unquote(place).rpartition(below)[2].split("/") for place in (self.location(name), *self.table(name).inputFiles())]
        kept = {path[0] for path in used}
        removed = remove_children(self.spark, root, "snapshot-", lambda child, _: child not in kept)
        if self.partition_columns(name):
            for snapshot in kept:
                inside = {path[1] for path in used if path[0] == snapshot and len(path) > 1}
                removed += remove_children(self.spark, f"{root}/{snapshot}", "", lambda child, _: "=" in child and child not in inside)
        return removed


def _partitions_last(schema: T.StructType, partition_by: Sequence[str]) -> list[T.StructField]:
    """Fields in the order of a partitioned table."""
    own = [f for f in schema.fields if f.name not in partition_by]
    return [*own, *[schema[c] for c in partition_by]]


def _as_spec(values: Mapping[str, object]) -> dict[str, str | None]:
    return {column: None if value is None else str(value) for column, value in values.items()}


def partition_of(place: str, depth: int) -> dict[str, str | None]:
    """Partition columns and values of a folder; its last ``depth`` names are ``column=value``."""
    named = [unquote(part).partition("=") for part in unquote(place).rstrip("/").split("/")[-depth:]]
    return {column: None if value == NULL_PARTITION else value for column, _, value in named}


def plain_path(place: str) -> str:
    """A file's address as a path: without the escapes of addresses."""
    parts = urlsplit(place)
    return f"{parts.scheme}://{parts.netloc}{unquote(parts.path)}" if parts.netloc else unquote(place)


def literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def spelled(spec: Mapping[str, str | None]) -> str:
    values = ", ".join(f"{quoted_name(c)} = {'NULL' if v is None else literal(v)}" for c, v in spec.items())
    return f" PARTITION ({values})"


def counted(df: DataFrame, columns: Sequence[str] | None = None) -> tuple[DataFrame, Observation]:
    """Attach row and NULL counts that Spark collects while the rows are written."""
    watch = Observation()
    names = list(columns if columns is not None else df.columns)
    nulls = [F.count_if(quoted(c).isNull()).alias(f"nulls_{i}") for i, c in enumerate(names)]
    return df.observe(watch, F.count(F.lit(1)).alias("rows"), *nulls), watch


def validate_load(written_rows: int, table: DataFrame) -> str:
    """SUCCESS when the table holds as many rows as were written."""
    return "SUCCESS" if table.count() == written_rows else "MISMATCH"
