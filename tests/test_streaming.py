import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallygrid.sources import schemas
from tallygrid.sources.scratch import fresh_folder
from tallygrid.streaming import events as ev
from tallygrid.streaming.run import LateRows, drain, drained, drained_to_the_end, stream_session

START = dt.datetime(2024, 1, 1)


def rows(*specs):
    """(event id, minutes after the start, user, type, value)"""
    return [(i, START + dt.timedelta(minutes=m), u, t, v, None) for i, m, u, t, v in specs]


def put(spark, folder, data):
    spark.createDataFrame(data, schemas.EVENTS).coalesce(1).write.mode("append").parquet(folder)


@pytest.fixture
def folder(spark):
    return fresh_folder(spark, "events")


def test_daily_over_several_batches_equals_batch(spark, folder, rows_of):
    for day in range(4):
        put(spark, folder, rows(*[(day * 10 + i, day * 1440 + i * 200, i % 3, "ab"[i % 2], 1.1 * i)
                                  for i in range(7)]))
    stream = ev.event_stream(spark, folder, max_files_per_trigger=1)
    got = drained_to_the_end(spark, stream, "daily", ev.stream_daily)
    batch = ev.stream_daily(ev.with_event_time(spark.read.parquet(folder)))
    assert rows_of(got) == rows_of(batch)
    assert got.count() == 8


def test_sessions_split_at_the_gap(spark, folder, rows_of):
    put(spark, folder, rows((1, 0, 7, "a", 1.0), (2, 10, 7, "a", 1.0), (3, 39, 7, "a", 1.0),
                            (4, 70, 7, "a", 1.0), (5, 5, 8, "a", 1.0)))
    stream = ev.event_stream(spark, folder)
    got = drained_to_the_end(spark, stream, "session",
                             lambda e: ev.stream_session(e, gap="30 minutes"))

    def at(minutes):
        return START + dt.timedelta(minutes=minutes)

    assert rows_of(got) == sorted([(7, at(0), at(69), 3), (7, at(70), at(100), 1),
                                   (8, at(5), at(35), 1)], key=repr)


@pytest.mark.parametrize("positions", [None, "place"])
def test_copies_are_dropped_across_files_and_batches(spark, folder, positions):
    """A third of all events are copies of one."""
    for _ in range(3):
        put(spark, folder, rows(*[(1, 0, 1, "a", 1.0)] * 60, *[(i, 1, 1, "a", 1.0) for i in range(2, 42)]))
    stream = ev.event_stream(spark, folder, max_files_per_trigger=1, positions=positions)
    got = drained(spark, ev.stream_dedup(stream, positions=positions), "dedup")
    assert got.count() == 41 and got.select("event_id").distinct().count() == 41
    assert got.columns == [f.name for f in schemas.EVENTS]


def test_anomalies_go_on_from_their_checkpoint(spark, folder):
    out, state = fresh_folder(spark, "out"), fresh_folder(spark, "state")
    for batch in range(2):
        put(spark, folder, rows((batch, batch, 1, "a", 500.0), (batch + 10, batch, 1, "a", 5.0)))
        drain(ev.stream_anomalies(ev.event_stream(spark, folder), 200), out, state)
        got = spark.read.parquet(out)
        assert got.count() == batch + 1
    assert got.select("anomaly_type").distinct().first()[0] == "HIGH_VALUE"


def test_late_rows_are_left_out(spark, folder, rows_of):
    put(spark, folder, rows((1, 0, 1, "a", 1.0), (2, 6000, 1, "a", 1.0)))
    stream = ev.event_stream(spark, folder)
    out, state = fresh_folder(spark, "out"), fresh_folder(spark, "state")
    drain(ev.stream_daily(stream, late="1 hour"), out, state)
    put(spark, folder, rows((3, 10, 1, "a", 1.0)))
    drain(ev.stream_daily(stream, late="1 hour"), out, state)
    assert rows_of(spark.read.parquet(out).select("window_start", "n")) == [(START, 1)]


def test_anomaly_filter_works_in_batch_too(spark, folder):
    put(spark, folder, rows((1, 0, 1, "a", 200.0), (2, 0, 1, "a", 200.01)))
    df = ev.stream_anomalies(spark.read.parquet(folder), 200)
    assert [r["event_id"] for r in df.select(F.col("event_id")).collect()] == [2]


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_days_do_not_depend_on_the_session_zone(spark, settings, folder, rows_of, zone):
    put(spark, folder, rows((1, 0, 1, "a", 1.0), (2, 1439, 1, "a", 1.0), (3, 1440, 1, "a", 1.0)))
    settings(spark__sql__session__timeZone=zone)
    got = drained_to_the_end(spark, ev.event_stream(spark, folder), "daily", ev.stream_daily)
    assert rows_of(got, "window_start", "n") == [
        (START, 2), (START + dt.timedelta(days=1), 1)]


def test_late_rows_are_counted_or_fail(spark, folder):
    """Files out of order: what the watermark has passed is told."""
    out, state = fresh_folder(spark, "out"), fresh_folder(spark, "state")

    def run(late):
        events = ev.event_stream(stream_session(spark, 2), folder)
        return drain(ev.stream_daily(events, late="1 hour"), out, state, late=late)

    put(spark, folder, rows((1, 0, 1, "a", 1.0), (2, 6000, 1, "a", 1.0)))
    assert run("fail") == 0
    put(spark, folder, rows((3, 10, 1, "a", 1.0), (4, 5999, 1, "a", 1.0)))
    assert run("count") == 1
    put(spark, folder, rows((5, 20, 1, "b", 1.0)))
    with pytest.raises(LateRows, match="1 rows"):
        run("fail")
    with pytest.raises(ValueError):
        run("ignore")


def test_a_stream_changes_no_setting_of_others(spark, folder, settings):
    settings(spark__sql__session__timeZone="Asia/Kolkata")
    before = dict(spark.conf.getAll)
    own = stream_session(spark, 3)
    assert own.conf.get("spark.sql.shuffle.partitions") == "3"
    assert own.conf.get("spark.sql.session.timeZone") == "Asia/Kolkata"
    put(spark, folder, rows((1, 0, 1, "a", 1.0)))
    drained_to_the_end(spark, ev.event_stream(own, folder), "daily", ev.stream_daily)
    assert dict(spark.conf.getAll) == before


def matches(spark, folder, rows_of, files, within=600):
    """Batch by batch, and the same join of all rows at once, by brute force."""
    everything = [r for file in files for r in file]
    for file in files:
        put(spark, folder, file)
    events = ev.event_stream(stream_session(spark, 3), folder, max_files_per_trigger=1)
    kinds = [events.where(F.col("event_type") == k) for k in ("a", "b")]
    got = rows_of(drained(spark, ev.stream_matched(*kinds, within=within, late="30 days"), "matched"))
    batch = ev.with_event_time(spark.createDataFrame(everything, schemas.EVENTS))
    at_once = ev.stream_matched(batch.where("event_type = 'a'"), batch.where("event_type = 'b'"), within)
    brute = sorted(((x[2], x[0], y[0]) for x in everything for y in everything
                    if (x[3], y[3]) == ("a", "b") and x[2] == y[2] is not None
                    and 0 <= (y[1] - x[1]).total_seconds() <= within), key=repr)
    assert got == rows_of(at_once) == brute
    return got


def test_causes_and_effects_meet_across_batches(spark, folder, rows_of):
    files = [rows((1, 0, 7, "a", 1.0), (2, 9, 7, "b", 1.0), (3, 10, 8, "b", 1.0)),
             rows((4, 10, 7, "b", 1.0), (5, 11, 7, "b", 1.0), (6, 0, 7, "b", 1.0), (7, 5, None, "a", 1.0)),
             rows((8, -3, 7, "a", 1.0), (9, 6, None, "b", 1.0), (10, 6, 7, "c", 1.0))]
    got = matches(spark, folder, rows_of, files)
    assert (7, 1, 4) in got and (7, 1, 5) not in got and (7, 8, 6) in got


def test_one_busy_user(spark, folder, rows_of):
    files = [rows(*[(i * 2 + k, (i * 37 + k * 5) % 900, 1 if i % 3 else i, "ab"[(i + k) % 2], 1.0) for i in range(60)])
             for k in range(2)]
    assert len(matches(spark, folder, rows_of, files, within=900)) > 30
