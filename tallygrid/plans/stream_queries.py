"""Streaming queries: the events table read as a stream, drained into a table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallygrid.functions.dates import utc_reading
from tallygrid.plans.catalog import query
from tallygrid.plans.oracle import total
from tallygrid.streaming import events as ev
from tallygrid.streaming.run import drained, drained_to_the_end, stream_session


def stream(star, positions=None, session=None):
    return ev.event_stream(session or stream_session(star.spark), star.folder, "events.parquet", positions=positions)


def zoneless(df):
    return df.withColumn("ts", utc_reading("ts"))


@query("stream_daily", f"""
SELECT date_trunc('day', ts)::timestamp AS window_start, event_type, count(*) AS n,
       {total('value')} AS total
FROM events GROUP BY 1, 2""")
def _(star):
    return drained_to_the_end(star.spark, stream(star), "daily", ev.stream_daily)


@query("stream_session", """
WITH marked AS (
SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts)
       < INTERVAL 3 HOUR THEN 0 ELSE 1 END AS opens FROM events), numbered AS (
SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM marked)
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 3 HOUR AS end, count(*) AS n
FROM numbered GROUP BY user_id, session""")
def _(star):
    return drained_to_the_end(star.spark, stream(star), "session",
                              lambda e: ev.stream_session(e, gap="3 hours"))


@query("stream_dedup", "SELECT DISTINCT ON (event_id) * FROM events")
def _(star):
    """Each event twice, the copies at places one apart, so that they take two lanes."""
    own = stream_session(star.spark)
    copies = stream(star, "place", own).withColumn("place", F.col("place") + 1)
    twice = stream(star, "place", own).unionByName(copies)
    once = ev.stream_dedup(twice, late="40 days", positions="place")
    return zoneless(drained(star.spark, once, "dedup"))


@query("stream_matched", """
SELECT a.user_id, a.event_id AS cause_id, b.event_id AS effect_id
FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type = 'view' AND b.event_type = 'purchase'
  AND b.ts BETWEEN a.ts AND a.ts + INTERVAL 36 HOUR""")
def _(star):
    """Views and the purchases of the same user in the next 36 hours."""
    own = stream_session(star.spark)
    kinds = [stream(star, session=own).where(F.col("event_type") == kind) for kind in ("view", "purchase")]
    return drained(star.spark, ev.stream_matched(*kinds, within=36 * 3600), "matched", late="fail")


@query("stream_anomalies", """
SELECT *, 'HIGH_VALUE' AS anomaly_type FROM events WHERE value > 200""")
def _(star):
    return zoneless(drained(star.spark, ev.stream_anomalies(stream(star), 200), "anomalies"))
