"""Compaction beside writers, repeated batches, broken runs, and messages that come twice."""

import os

import pytest
from pyspark.sql import functions as F

from sensorfold.operators import extract_readings, raw_rows
from sensorfold.plans import ledger, told_readings
from sensorfold.schemas import RAW_SCHEMA
from sensorfold.sources import append_rows, commit_rows, compact, ensure_table, once_only, stored_rows
from sensorfold.sources.compaction import _put, covers, read_manifest, table_files
from sensorfold.streaming import start_pair, start_raw, wait_all
from test_streaming import NOW, Topic, fresh, same, wire
from test_streams_together import tables


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, f"{tmp_path}/topic")


@pytest.fixture
def raw(spark):
    name = fresh()
    ensure_table(spark, name, RAW_SCHEMA)
    return name


def batch(spark, n, start=0):
    return spark.range(start, start + n).select(
        F.lit("a").alias("measure"), F.col("id").alias("value"), F.col("id").alias("received"), F.timestamp_seconds("id").alias("window_timestamp")
    )


def values(spark, table, **options):
    return sorted(r["value"] for r in stored_rows(spark, table, **options).collect())


def n_partitions(spark, table):
    return spark.sql(f"SHOW PARTITIONS {table}").count()


def test_many_appends_become_few(spark, raw):
    for k in range(6):
        commit_rows(batch(spark, 3, 10 * k), raw, "w", k)
    append_rows(batch(spark, 2, 100), raw, "job", 0)
    want = values(spark, raw)
    assert compact(spark, raw, {"w": 4}) == 1
    assert values(spark, raw) == want and n_partitions(spark, raw) == 3
    assert values(spark, raw, writer="job") == [100, 101]
    assert len(values(spark, raw, writer="w")) == 18
    assert compact(spark, raw, {"w": 5, "job": 0}) == 2
    assert values(spark, raw) == want and n_partitions(spark, raw) == 3


def test_a_repeated_batch_adds_nothing(spark, raw):
    commit_rows(batch(spark, 3), raw, "w", 0)
    append_rows(batch(spark, 2, 100), raw, "job", 7)
    compact(spark, raw, {"w": 0, "job": 7})
    assert commit_rows(batch(spark, 3), raw, "w", 0) is False
    assert append_rows(batch(spark, 2, 100), raw, "job", 7) == "job"
    assert values(spark, raw) == [0, 1, 2, 100, 101]
    assert commit_rows(batch(spark, 1, 50), raw, "w", 1) is True
    assert values(spark, raw) == [0, 1, 2, 50, 100, 101]


def test_compacting_nothing_and_again(spark, raw):
    assert compact(spark, raw, {"w": 5}) == 1
    assert values(spark, raw) == []
    commit_rows(batch(spark, 2), raw, "v", 0)
    assert compact(spark, raw, {}) == 2 and compact(spark, raw, {"v": 0}) == 3 and compact(spark, raw, {"v": 0}) == 4
    assert values(spark, raw) == [0, 1]


def test_a_broken_compaction_is_not_seen_and_cleared(spark, raw, monkeypatch):
    from sensorfold.sources import compaction

    for k in range(3):
        commit_rows(batch(spark, 2, 10 * k), raw, "w", k)
    want = values(spark, raw)

    def lost(*_):
        raise OSError("driver lost")

    with monkeypatch.context() as broken:  # rows are in place, the manifest is not
        broken.setattr(compaction, "_put", lost)
        with pytest.raises(OSError):
            compact(spark, raw, {"w": 2})
    assert values(spark, raw) == want
    drop = compaction._drop
    calls = []
    with monkeypatch.context() as broken:  # the manifest is in place, the old appends still there
        broken.setattr(compaction, "_drop", lambda *a: calls.append(1) or (drop(*a) if len(calls) == 1 else lost()))
        with pytest.raises(OSError):
            compact(spark, raw, {"w": 2})
    assert values(spark, raw) == want
    assert commit_rows(batch(spark, 2), raw, "w", 0) is False
    compact(spark, raw, {"w": 2})
    assert values(spark, raw) == want and n_partitions(spark, raw) == 1


def test_two_compactions_at_once(spark, raw):
    commit_rows(batch(spark, 2), raw, "w", 0)
    location, _ = table_files(spark, raw)
    _put(spark, location, {"generation": 1, "generations": [], "through": {}})
    with pytest.raises(RuntimeError, match="another compaction"):
        _put(spark, location, {"generation": 1, "generations": [1], "through": {"w": 0}})
    assert values(spark, raw) == [0, 1] and not covers(read_manifest(spark, location), "w", 0)


def test_ledger_and_follower_after_compaction(spark, topic, tmp_path):
    raw, agg = tables(spark)
    run = lambda: wait_all(start_pair(topic.read(), raw, agg, f"{tmp_path}/c", trigger=NOW))
    topic.publish(wire(spark, ("a", 1, "10:00:10"), ("a", 2, "10:02:10")))
    run()
    topic.publish(wire(spark, ("a", 3, "10:00:20"), ("a", 5, "10:04:00")))
    run()
    before = {r["value"]: r["state"] for r in told_readings(spark, raw, f"{tmp_path}/c").collect()}
    writer = spark.table(raw).first()["_writer"]
    compact(spark, raw, {writer: 1}, "window_timestamp", "1 minute")
    assert {r["value"]: r["state"] for r in told_readings(spark, raw, f"{tmp_path}/c").collect()} == before
    assert before == {1: "counted", 2: "counted", 3: "late", 5: "open"}
    topic.publish(wire(spark, ("a", 6, "10:04:30"), ("a", 7, "10:09:00")))
    run()  # the follower goes on and reads no rewritten row
    rows = ledger(spark, raw, agg, f"{tmp_path}/c").collect()
    assert all(r["balanced"] for r in rows) and sum(r["stored"] for r in rows) == 4
    same(stored_rows(spark, raw), raw_rows(extract_readings(topic.read(streaming=False))))


def test_a_hot_writer_is_cut_into_files(spark, raw):
    commit_rows(batch(spark, 200_000), raw, "w", 0)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "100k")
    try:
        compact(spark, raw, {"w": 0})
    finally:
        spark.conf.set(key, before)
    location, _ = table_files(spark, raw)
    files = [f for d, _, names in os.walk(location.removeprefix("file:")) for f in names if f.startswith("part-") and "_batch=-1" in d]
    assert len(files) > 1 and stored_rows(spark, raw).count() == 200_000


# --- redelivery -----------------------------------------------------------------------


def named(spark, *rows):
    body = F.format_string("'[{\"meaning\":\"%s\",\"value\":%d,\"received\":1}]'", "m", "v").alias("payload")
    return spark.createDataFrame(rows, "id int, m string, v int, t string").select(
        "id", body, F.to_timestamp(F.concat(F.lit("2024-01-01 "), "t")).alias("publish_ts")
    )


def test_messages_delivered_again(spark, raw, tmp_path):
    def run(*rows):
        named(spark, *rows).coalesce(1).write.mode("append").parquet(f"{tmp_path}/t")
        read = spark.readStream.schema("id int, payload string, publish_ts timestamp").parquet(f"{tmp_path}/t")
        wait_all([start_raw(read, raw, f"{tmp_path}/c", NOW, once=["id"])])
        return sorted(r["value"] for r in stored_rows(spark, raw).collect())

    assert run((1, "a", 1, "10:00:00"), (1, "a", 1, "10:00:00"), (2, "a", 2, "23:00:00")) == [1, 2]
    # delivered again, equal but of another id, and published long before all that came
    assert run((2, "a", 2, "23:00:00"), (3, "a", 2, "23:00:00"), (4, "a", 4, "01:00:00")) == [1, 2, 2, 4]
    assert run((4, "a", 4, "01:00:00")) == [1, 2, 2, 4]
    with pytest.raises(ValueError, match="once"):
        start_raw(once_only(spark.readStream.format("rate").load(), ["value"]), raw, f"{tmp_path}/d", NOW, quarantine_table=raw, once=["value"])
