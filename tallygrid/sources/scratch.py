"""Folders for intermediate tables and stream checkpoints."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_made: dict[str, SparkSession] = {}


def shared_base(spark: SparkSession) -> str:
    """The shared folder that the cluster names, else one beside the session's tables.

    On a cluster a folder on a local disk is another one for each executor, so without a
    named folder the tables must not be there."""
    base = spark.conf.get(SETTING, None)
    if base:
        return base.rstrip("/")
    tables = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not on_one_machine(spark.conf.get("spark.master", "")) and (tables.startswith("file:") or "://" not in tables):
        raise RuntimeError(f"set {SETTING} to a folder that all executors share: {tables} is local to each machine")
    return f"{tables}/scratch"


def on_one_machine(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A folder of its own, removed when the program ends with its session running."""
    folder = f"{shared_base(spark)}/{label}-{uuid.uuid4().hex}"
    if not _made:
        atexit.register(remove_folders)
    _made[folder] = spark
    return folder


def remove_folders() -> None:
    while _made:
        folder, spark = _made.popitem()
        if spark.sparkContext._jsc is not None and not spark.sparkContext._jsc.sc().isStopped():
            remove(spark, folder)


def remove(spark: SparkSession, folder: str) -> None:
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def tidy_session(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark`` at this moment that removes the shuffle files of
    a write when it ends; elsewhere they stay until the driver collects its garbage."""
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if name.startswith("spark.sql.") and spark.conf.isModifiable(name):
            own.conf.set(name, value)
    own.conf.set(CLEANUP, "true")
    return own
