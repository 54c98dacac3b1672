"""Streams: append, closed windows, late data, restarts, fan-out, failures."""

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from sensorfold.operators import agg_rows, extract_readings, raw_rows, windowed_stats
from sensorfold.plans import run_batch
from sensorfold.schemas import AGG_SCHEMA, RAW_SCHEMA
from sensorfold.sources import (
    ensure_table,
    event_messages,
    read_messages,
    readings_from_raw,
    stored_rows,
)
from sensorfold.streaming import start_aggregate, start_pipeline, start_raw, wait_all

SF = "/root/testdata/sf0.001"
NOW = {"availableNow": True}
ONE_FILE = {"maxFilesPerTrigger": "1"}


def fresh():
    return f"s_{uuid.uuid4().hex}"


class Topic:
    """A folder of message files, each newer than the one before."""

    def __init__(self, spark, path):
        self.spark, self.path, self.clock = spark, path, 1_700_000_000
        os.makedirs(path)

    def publish(self, messages):
        part = f"{self.path}-part{self.clock}"
        messages.select("payload", "publish_ts").coalesce(1).write.parquet(part)
        (name,) = [f for f in os.listdir(part) if f.endswith(".parquet")]
        target = f"{self.path}/{self.clock}.parquet"
        os.link(f"{part}/{name}", target)
        self.clock += 100
        os.utime(target, (self.clock, self.clock))

    def read(self, streaming=True, **options):
        return read_messages(self.spark, self.path, streaming, options=options)


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, f"{tmp_path}/topic")


def quarter(spark, i):
    """Events of one quarter of the month, in time order over the quarters."""
    start = dt.datetime(2024, 1, 1) + dt.timedelta(days=7.5 * i)
    end = start + dt.timedelta(days=7.5)
    events = spark.read.parquet(f"{SF}/events.parquet")
    return event_messages(events.where((F.col("ts") >= F.lit(start)) & (F.col("ts") < F.lit(end))))


def wire(spark, *rows):
    """Messages from (measure, value, 'HH:MM:SS') on one day."""
    return spark.createDataFrame(rows, "m string, v int, t string").select(
        F.format_string("'[{\"meaning\":\"%s\",\"value\":%d,\"received\":1}]'", "m", "v").alias("payload"),
        F.to_timestamp(F.concat(F.lit("2024-01-01 "), "t")).alias("publish_ts"),
    )


def same(left, right):
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def run_raw(spark, messages, table, checkpoint):
    ensure_table(spark, table, RAW_SCHEMA)
    wait_all([start_raw(messages, table, checkpoint, NOW)])
    return stored_rows(spark, table)


def run_agg(spark, messages, table, checkpoint, duration="1 minute", lateness="0 seconds"):
    ensure_table(spark, table, AGG_SCHEMA)
    query = start_aggregate(
        extract_readings(messages), table, checkpoint, duration, lateness, NOW
    )
    wait_all([query])
    return stored_rows(spark, table)


def test_batch_and_stream_agree_on_closed_windows(spark, topic, tmp_path):
    for i in range(4):
        topic.publish(quarter(spark, i))
    streamed = run_agg(spark, topic.read(**ONE_FILE), fresh(), f"{tmp_path}/c", "1 hour")
    readings = extract_readings(topic.read(streaming=False))
    newest = readings.agg(F.max("publish_ts")).first()[0]
    stats = windowed_stats(readings, "1 hour")
    same(streamed, agg_rows(stats.where(F.col("window.end") <= F.lit(newest))))
    assert stats.count() - streamed.count() == 1  # the last window is still open


def test_late_rows_leave_the_aggregate_and_stay_in_the_raw_table(spark, topic, tmp_path):
    topic.publish(wire(spark, ("a", 1, "10:00:10"), ("a", 3, "10:00:50")))
    topic.publish(wire(spark, ("a", 5, "10:02:00")))
    topic.publish(wire(spark, ("a", 7, "10:04:00")))
    topic.publish(wire(spark, ("a", 100, "10:00:30"), ("a", 9, "10:06:00")))
    agg = run_agg(spark, topic.read(**ONE_FILE), fresh(), f"{tmp_path}/agg")
    assert sorted((r["ts"][11:19], r["max"], r["cnt"]) for r in agg.collect()) == [
        ("10:00:59", 3, 2), ("10:02:59", 5, 1), ("10:04:59", 7, 1),
    ]
    raw = run_raw(spark, topic.read(**ONE_FILE), fresh(), f"{tmp_path}/raw")
    assert raw.count() == 6
    assert raw.where("value = 100").count() == 1


def test_lateness_keeps_windows_open_longer(spark, topic, tmp_path):
    topic.publish(wire(spark, ("a", 1, "10:00:10")))
    topic.publish(wire(spark, ("a", 5, "10:02:00")))
    topic.publish(wire(spark, ("a", 100, "10:00:30")))
    topic.publish(wire(spark, ("a", 9, "10:20:00")))
    agg = run_agg(spark, topic.read(**ONE_FILE), fresh(), f"{tmp_path}/c", lateness="5 minutes")
    assert sorted((r["ts"][11:19], r["max"], r["cnt"]) for r in agg.collect()) == [
        ("10:00:59", 100, 2), ("10:02:59", 5, 1),
    ]


def test_restart_resumes_without_repeating(spark, topic, tmp_path):
    raw, agg = fresh(), fresh()
    for i in range(2):
        topic.publish(quarter(spark, i))

    def run():
        run_raw(spark, topic.read(), raw, f"{tmp_path}/raw")
        run_agg(spark, topic.read(**ONE_FILE), agg, f"{tmp_path}/agg", "1 hour")
        return spark.table(raw).count(), spark.table(agg).count()

    first = run()
    assert run() == first
    for i in (2, 3):
        topic.publish(quarter(spark, i))
    run()
    readings = extract_readings(topic.read(streaming=False))
    same(stored_rows(spark, raw), raw_rows(readings))
    newest = readings.agg(F.max("publish_ts")).first()[0]
    stats = windowed_stats(readings, "1 hour").where(F.col("window.end") <= F.lit(newest))
    same(stored_rows(spark, agg), agg_rows(stats))


def test_progress_reports_bad_records(spark, topic, tmp_path):
    topic.publish(quarter(spark, 0))
    total = topic.read(streaming=False).count()
    table = fresh()
    ensure_table(spark, table, RAW_SCHEMA)
    query = start_raw(topic.read(), table, f"{tmp_path}/c", NOW)
    wait_all([query])
    seen = [p.observedMetrics["extract"] for p in query.recentProgress if p.observedMetrics]
    assert sum(r.total for r in seen) == total
    assert sum(r.bad for r in seen) == total // 2


def test_pipeline_fans_out_to_both_tables(spark, topic, tmp_path):
    for i in range(2):
        topic.publish(quarter(spark, i))
    raw, agg = f"telemetry_stream.{fresh()}", f"telemetry_stream.{fresh()}"
    queries = start_pipeline(
        spark, topic.path, f"{tmp_path}/c", raw, agg, "1 hour", trigger=NOW
    )
    assert len(queries) == 2
    wait_all(queries)
    readings = extract_readings(topic.read(streaming=False))
    same(stored_rows(spark, raw), raw_rows(readings))
    newest = readings.agg(F.max("publish_ts")).first()[0]
    stats = windowed_stats(readings, "1 hour").where(F.col("window.end") <= F.lit(newest))
    same(stored_rows(spark, agg), agg_rows(stats))


def test_pipeline_leaves_out_unset_tables(spark, topic, tmp_path):
    topic.publish(quarter(spark, 0))
    raw = fresh()
    queries = start_pipeline(spark, topic.path, f"{tmp_path}/c", raw, None, trigger=NOW)
    assert len(queries) == 1
    wait_all(queries)
    assert spark.table(raw).count() > 0
    with pytest.raises(ValueError):
        start_pipeline(spark, topic.path, f"{tmp_path}/d", None, fresh(), aggregate_raw_table=True)


def test_pipeline_refuses_a_changed_table(spark, topic, tmp_path):
    topic.publish(quarter(spark, 0))
    raw = fresh()
    ensure_table(spark, raw, AGG_SCHEMA)
    with pytest.raises(RuntimeError, match="cannot append to"):
        start_pipeline(spark, topic.path, f"{tmp_path}/c", raw, None, trigger=NOW)


def test_aggregate_can_follow_the_raw_table(spark, topic, tmp_path):
    for i in range(2):
        topic.publish(quarter(spark, i))
    raw, direct, chained = fresh(), fresh(), fresh()
    run_raw(spark, topic.read(), raw, f"{tmp_path}/raw")
    run_agg(spark, topic.read(), direct, f"{tmp_path}/direct", "1 hour")
    ensure_table(spark, chained, AGG_SCHEMA)
    readings = readings_from_raw(spark, raw, streaming=True)
    wait_all([start_aggregate(readings, chained, f"{tmp_path}/chained", "1 hour", trigger=NOW)])
    same(stored_rows(spark, chained), stored_rows(spark, direct))


def test_state_width_is_the_sessions(spark, topic, tmp_path):
    topic.publish(quarter(spark, 0))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    run_agg(spark, topic.read(), fresh(), f"{tmp_path}/c", "1 hour")
    parts = [d for d in os.listdir(f"{tmp_path}/c/state/0") if d.isdigit()]
    assert len(parts) == width


def test_pipeline_needs_a_configured_session(spark, topic, tmp_path):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.unset(key)
    try:
        with pytest.raises(ValueError, match="configure_session"):
            start_pipeline(spark, topic.path, f"{tmp_path}/c", fresh(), fresh(), trigger=NOW)
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("order", ["batch first", "stream first", "two streams"])
def test_writers_share_a_table(spark, topic, tmp_path, order):
    for i in range(2):
        topic.publish(quarter(spark, i))
    n = extract_readings(topic.read(streaming=False)).count()
    raw = fresh()
    stream = lambda c: run_raw(spark, topic.read(), raw, f"{tmp_path}/{c}")
    batch = lambda: run_batch(topic.read(streaming=False), raw, None, writer="backfill")
    ensure_table(spark, raw, RAW_SCHEMA)
    first, second = {
        "batch first": (batch, lambda: stream("a")),
        "stream first": (lambda: stream("a"), batch),
        "two streams": (lambda: stream("a"), lambda: stream("b")),
    }[order]
    first()
    second()
    assert stored_rows(spark, raw).count() == 2 * n
    first()  # again: a restart and a repeated batch add nothing
    second()
    assert stored_rows(spark, raw).count() == 2 * n


def test_writers_share_an_aggregate_table(spark, topic, tmp_path):
    for i in range(2):
        topic.publish(quarter(spark, i))
    agg = fresh()
    one = run_agg(spark, topic.read(), agg, f"{tmp_path}/a", "1 hour").count()
    run_batch(topic.read(streaming=False), None, agg, "1 hour")
    run_agg(spark, topic.read(), agg, f"{tmp_path}/b", "1 hour")
    whole = windowed_stats(extract_readings(topic.read(streaming=False)), "1 hour").count()
    assert stored_rows(spark, agg).count() == 2 * one + whole


def test_wait_all_stops_the_others_and_raises(spark, topic, tmp_path):
    topic.publish(quarter(spark, 0))
    endless, broken = fresh(), fresh()
    ensure_table(spark, endless, RAW_SCHEMA)
    ensure_table(spark, broken, RAW_SCHEMA)
    runs_on = start_raw(topic.read(), endless, f"{tmp_path}/a", {"processingTime": "1 second"})
    fails = topic.read().withColumn("payload", F.raise_error(F.lit("broken source")))
    stops = start_raw(fails, broken, f"{tmp_path}/b", NOW)
    with pytest.raises(Exception, match="broken source"):
        wait_all([runs_on, stops])
    assert not runs_on.isActive


def test_stream_keeps_state_in_rocksdb(spark):
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
