"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

# SQL settings that may be changed on a running session.
SQL_SETTINGS = {
    # Oracle parity and repeatable dates.
    "spark.sql.session.timeZone": "UTC",
    # Partition counts and join sides are decided from measured sizes, and a hot
    # join key is split even when that costs one more shuffle downstream.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A daily load replaces only the days it carries.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to a session that already exists."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app_name: str = "wardflow",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SQL_SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for staged data: the one the cluster names, never a local one.

    Only a ``local[*]`` session without ``spark.checkpoint.dir`` uses a folder under its
    warehouse.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if named is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
        context.setCheckpointDir(named)
    return named or context.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared scratch folder; nothing is created or removed."""
    return f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def remove_children(spark: SparkSession, folder: str, prefix: str, unwanted: Callable[[str, float], bool]) -> int:
    """Remove subfolders by name and age in seconds, on whatever file system holds the folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    removed = 0
    for child in system.listStatus(path) if system.exists(path) else ():
        name, age = child.getPath().getName(), time.time() - child.getModificationTime() / 1000
        if name.startswith(prefix) and unwanted(name, age):
            removed += int(system.delete(child.getPath(), True))
    return removed


def drop_old_stages(spark: SparkSession, older_than_s: float) -> int:
    """Remove staged rows of runs that ended; nothing younger than the given age is touched."""
    return remove_children(spark, scratch_root(spark), "stage-", lambda _, age: age > older_than_s)
