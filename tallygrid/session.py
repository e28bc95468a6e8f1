"""A session with the settings the operators count on."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

# Most are Spark's defaults, named here because the operators depend on them.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Join by hashing instead of sorting where every shuffled partition of one
    # side turned out to be smaller than this.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}


MB = 1 << 20


def sized_for(data_bytes: int) -> dict[str, str]:
    """Settings for an input of that many bytes: shuffles start with partitions of about
    512 MB of input, which adaptive execution joins up where less arrives."""
    return {
        "spark.sql.shuffle.partitions": str(max(-(-data_bytes // (512 * MB)), 200)),
        "spark.sql.files.maxPartitionBytes": str(128 * MB),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * MB),
    }


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Size of files and folders, from the file system's own listing."""
    context = spark.sparkContext
    found = (context._jvm.org.apache.hadoop.fs.Path(p) for p in paths)
    conf = context._jsc.hadoopConfiguration()
    return sum(p.getFileSystem(conf).getContentSummary(p).getLength() for p in found)


def session(app: str = "tallygrid", master: str | None = None,
            settings: Mapping[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
