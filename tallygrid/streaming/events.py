"""Event stream operators. They work on streaming and on batch DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrid.functions.dates import utc_instant, utc_reading
from tallygrid.functions.money import exact_sum, rows
from tallygrid.sources import schemas


def event_stream(spark: SparkSession, folder: str, file_glob: str = "*.parquet",
                 max_files_per_trigger: int | None = None,
                 max_bytes_per_trigger: str | None = None,
                 positions: str | None = None) -> DataFrame:
    """Parquet event files as a stream. The two limits bound one micro-batch.
    ``positions`` names a column for each row's place in its file."""
    reader = spark.readStream.schema(schemas.EVENTS).option("pathGlobFilter", file_glob)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    events = reader.parquet(folder)
    if positions is not None:
        events = events.withColumn(positions, F.col("_metadata.row_index"))
    return with_event_time(events)


def with_event_time(events: DataFrame) -> DataFrame:
    """Watermarks need an instant, not a zone-less timestamp."""
    return events.withColumn("ts", utc_instant("ts"))


def stream_daily(events: DataFrame, late: str = "1 day", width: str = "1 day") -> DataFrame:
    """Count and total per day and event type."""
    daily = (
        events.withWatermark("ts", late)
        .groupBy(F.window("ts", width).alias("span"), "event_type")
        .agg(rows().alias("n"), exact_sum("value").alias("total"))
    )
    return daily.select(
        utc_reading("span.start").alias("window_start"), "event_type", "n", "total"
    )


def stream_session(events: DataFrame, gap: str = "30 minutes", late: str = "1 day") -> DataFrame:
    """Sessions of a user: events no further apart than the gap."""
    sessions = (
        events.withWatermark("ts", late)
        .groupBy(F.session_window("ts", gap).alias("span"), "user_id")
        .agg(rows().alias("n"))
    )
    return sessions.select(
        "user_id",
        utc_reading("span.start").alias("start"),
        utc_reading("span.end").alias("end"),
        "n",
    )


def stream_dedup(events: DataFrame, late: str = "1 day", key: str = "event_id",
                 positions: str | None = None, lanes: int = 64) -> DataFrame:
    """One event per key among those that arrive within the allowed lateness.

    With ``positions`` (a column that differs between copies and stays the same
    when a task is repeated) copies are first reduced in separate lanes, so a key
    with very many copies does not pass through one task.
    """
    events = events.withWatermark("ts", late)
    if positions is None:
        return events.dropDuplicatesWithinWatermark([key])
    laned = events.withColumn("__lane", F.pmod(F.col(positions), F.lit(lanes))).drop(positions)
    fewer = laned.dropDuplicatesWithinWatermark([key, "__lane"]).drop("__lane")
    return fewer.dropDuplicatesWithinWatermark([key])


def stream_anomalies(events: DataFrame, max_value: float, tag: str = "HIGH_VALUE") -> DataFrame:
    return events.where(F.col("value") > max_value).withColumn("anomaly_type", F.lit(tag))


def stream_matched(causes: DataFrame, effects: DataFrame, within: int, late: str = "1 day",
                   key: str = "user_id") -> DataFrame:
    """Every cause with every effect of the same ``key`` from its moment to ``within`` seconds
    after it: the key and both event ids.

    Both streams have a watermark, so state older than a match can be is dropped. Time is cut
    into buckets of ``within``; a cause is kept in its own and in the next, in one of which
    each of its effects is. So a busy user's events are spread over tasks.
    """
    bucket = F.floor(F.unix_micros("ts") / (within * 1_000_000))
    first = causes.withWatermark("ts", late).select(
        F.col(key).alias("__key"), F.col("event_id").alias("cause_id"), F.col("ts").alias("cause_ts"),
        F.explode(F.array(bucket, bucket + 1)).alias("__cause_bucket"))
    second = effects.withWatermark("ts", late).select(
        key, F.col("event_id").alias("effect_id"), F.col("ts").alias("effect_ts"), bucket.alias("__bucket"))
    match = (
        (F.col("__key") == F.col(key)) & (F.col("__cause_bucket") == F.col("__bucket"))
        & (F.col("effect_ts") >= F.col("cause_ts"))
        & (F.col("effect_ts") <= F.col("cause_ts") + F.make_dt_interval(secs=F.lit(within)))
    )
    return first.join(second, match).select(key, "cause_id", "effect_id")
