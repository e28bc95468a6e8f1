"""Running a stream over what its source holds now, into a written table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallygrid.sources.scratch import fresh_folder

#: Merge sessions before the shuffle, so that one busy user is reduced early.
EARLY_MERGE = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
PARTITIONS = "spark.sql.shuffle.partitions"
END_OF_TIME = dt.datetime(9000, 1, 1)
POLL = 1  # seconds between looks at a running stream


class LateRows(RuntimeError):
    """Rows came after the watermark had passed them and are in no result."""


def stream_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session for one stream, with the settings of ``spark`` at this moment and those that
    a stream needs; ``spark`` itself and queries beside the stream see no change.

    State is kept in ``partitions`` parts, one per core of the cluster by default; the first
    run fixes their number for its checkpoint.
    """
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if name.startswith("spark.sql.") and spark.conf.isModifiable(name):
            own.conf.set(name, value)
    own.conf.set(EARLY_MERGE, "true")
    own.conf.set(PARTITIONS, str(partitions or spark.sparkContext.defaultParallelism))
    return own


def drain(stream: DataFrame, out: str, checkpoint: str, timeout: int | None = None,
          late: str = "count") -> int:
    """Process everything the source holds now, append it to ``out`` and stop; the number of
    late rows.

    The tasks write the parquet files, each row exactly once even if executors are lost. A
    later call with the same checkpoint goes on where this one ended. ``stream`` should come
    from a ``stream_session``.

    Late is what stateful operators dropped because the watermark had passed it: rows, or
    in windows sums of rows of one batch, window and group. With ``late="fail"`` any such
    row is an error, raised when the stream has ended.
    """
    if late not in ("count", "fail"):
        raise ValueError(f"{late} is neither count nor fail")
    query = (
        stream.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .format("parquet")
        .start(out)
    )
    dropped: dict[int, int] = {}

    def look() -> None:
        """Spark keeps the reports of the last batches only."""
        for progress in query.recentProgress:
            dropped[progress.batchId] = sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)

    waited = 0
    while not query.awaitTermination(POLL):
        look()
        waited += POLL
        if timeout is not None and waited >= timeout:
            query.stop()
            raise TimeoutError(f"stream not drained within {timeout} s")
    look()
    total = sum(dropped.values())
    if total and late == "fail":
        raise LateRows(f"{total} rows came too late")
    return total


def drained(spark: SparkSession, stream: DataFrame, label: str, late: str = "count") -> DataFrame:
    """Drain into fresh folders and return the written table."""
    out = fresh_folder(spark, label)
    drain(stream, out, fresh_folder(spark, f"{label}-state"), late=late)
    return spark.read.parquet(out)


def drained_to_the_end(spark: SparkSession, events: DataFrame, label: str,
                       report: Callable[[DataFrame], DataFrame], time: str = "ts",
                       late: str = "count") -> DataFrame:
    """Drain a windowed report of a stream that has ended, open windows included.

    Append mode holds a window back until the watermark has passed it, so the
    last ones would never come out. A second, empty source is read beside the
    events. Once the events are used up, one row from the end of time is put
    there; it moves the watermark past every real window. It never appears in
    the result, because its own window stays open.
    """
    folder = fresh_folder(spark, f"{label}-closing")
    closing = spark.createDataFrame([], events.schema)
    closing.write.parquet(folder)
    both = events.unionByName(events.sparkSession.readStream.schema(events.schema).parquet(folder))
    out, checkpoint = fresh_folder(spark, label), fresh_folder(spark, f"{label}-state")
    drain(report(both), out, checkpoint, late=late)

    last = tuple(END_OF_TIME if f.name == time else None for f in events.schema)
    spark.createDataFrame([last], events.schema).write.mode("append").parquet(folder)
    drain(report(both), out, checkpoint, late=late)
    return spark.read.parquet(out)
