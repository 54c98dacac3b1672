"""The two streaming queries: readings to the raw table, window summaries to the other.

Each query has its own checkpoint and can be stopped, restarted and scaled alone. The
checkpoint folder is required: it is what makes a restart exact. Each micro-batch goes to a
partition of its own in the table, in one step and once, so batch jobs and other streams may
append to it too and a stream may follow it.
"""

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorfold.operators.cogroup import co_group_columns, co_group_only
from sensorfold.operators.extract import extract_readings, observed, parse_messages
from sensorfold.operators.rows import agg_rows, raw_rows
from sensorfold.operators.windows import windowed_stats
from sensorfold.schemas import (
    AGG_SCHEMA,
    DEFAULT_AGG_TABLE,
    DEFAULT_LATENESS,
    DEFAULT_RAW_TABLE,
    DEFAULT_WINDOW,
    QUARANTINE_SCHEMA,
    RAW_SCHEMA,
)
from sensorfold.session import hadoop_path, require_stream_session
from sensorfold.sources.messages import once_only, read_messages
from sensorfold.sources.tables import commit_rows, ensure_table, readings_from_raw

RAW_METRICS = "extract"
AGG_METRICS = "extract_agg"


# --- checkpoints ------------------------------------------------------------------


def writer_id(spark: SparkSession, checkpoint: str) -> str:
    """The id under which a query appends, kept in its checkpoint.

    A restart goes on under the same id, so a batch it repeats is told. A new checkpoint
    has a new id, so what it appends stands beside all that is there.
    """
    where, files = hadoop_path(spark, f"{checkpoint}/writer")
    if not files.exists(where):
        out = files.create(where, False)
        out.writeUTF(uuid.uuid4().hex)
        out.close()
    source = files.open(where)
    try:
        return source.readUTF()
    finally:
        source.close()


def batch_watermark(spark: SparkSession, checkpoint: str, batch: int) -> int:
    """The time in epoch milliseconds up to which a micro-batch holds windows to be closed.

    Spark notes it with the batch before the batch runs, so a repeated batch finds the same.
    """
    where, files = hadoop_path(spark, f"{checkpoint}/offsets/{batch}")
    source = files.open(where)
    try:
        text = bytes(source.readAllBytes()).decode("utf-8")
    finally:
        source.close()
    return int(json.loads(text.splitlines()[1])["batchWatermarkMs"])


def closed_until(spark: SparkSession, checkpoint: str) -> int:
    """The same of the last micro-batch that a query has committed; 0 before its first."""
    where, files = hadoop_path(spark, f"{checkpoint}/commits")
    if not files.exists(where):
        return 0
    names = [f.getPath().getName() for f in files.listStatus(where)]
    done = [int(name) for name in names if name.isdigit()]
    return batch_watermark(spark, checkpoint, max(done)) if done else 0


# --- time -------------------------------------------------------------------------


def with_heartbeats(readings: DataFrame, heartbeats: DataFrame, behind: str = "0 seconds") -> DataFrame:
    """Readings and, beside them, rows that only tell the time (``publish_ts``) of a second stream.

    A source that falls silent leaves its last windows open for ever, since time passes only as
    readings come. The newest of either moves the watermark, as it is set above the union;
    a heartbeat counts ``behind`` its time, to leave readings on their way time to arrive. The
    aggregation takes the heartbeats out again (``closed_windows``).
    """
    beats = heartbeats.select((F.col("publish_ts").cast("timestamp") - F.expr(f"INTERVAL {behind}")).alias("publish_ts"))
    return readings.withColumn("heartbeat", F.lit(False)).unionByName(
        beats.withColumn("heartbeat", F.lit(True)), allowMissingColumns=True
    )


def clock_heartbeats(spark: SparkSession, per_second: int = 1) -> DataFrame:
    """Heartbeats of the cluster's clock, for sources whose publish times follow the wall clock."""
    beats = spark.readStream.format("rate").option("rowsPerSecond", per_second).load()
    return beats.select(F.col("timestamp").alias("publish_ts"))


def watched(readings: DataFrame, lateness: str = DEFAULT_LATENESS) -> DataFrame:
    """Readings under a watermark, without the heartbeats that moved it.

    The condition names the event time on purpose: a filter that does not is pushed below the
    watermark, which would then see no heartbeat.
    """
    timed = readings.withWatermark("publish_ts", lateness)
    if "heartbeat" not in readings.columns:
        return timed
    return timed.where(F.when(F.col("publish_ts").isNotNull(), ~F.col("heartbeat")).otherwise(False)).drop("heartbeat")


def in_time(readings: DataFrame, duration: str = DEFAULT_WINDOW) -> DataFrame:
    """Readings of ``readings_from_raw(watermark=True)`` whose window was open when they came."""
    end = F.window("publish_ts", duration)["end"]
    return readings.select("*", end.alias("_end")).where(F.col("_end") > F.col("watermark")).drop("_end", "watermark")


# --- queries ----------------------------------------------------------------------


def start_rows(
    rows: DataFrame,
    table: str,
    checkpoint: str,
    trigger: dict[str, Any] | None,
    others: Callable[[DataFrame], Mapping[str, DataFrame]] | None = None,
    marked: bool = True,
) -> StreamingQuery:
    """Append each micro-batch to ``table``; ``others`` makes rows for further tables of it.

    ``marked`` notes the batch's watermark with its rows.
    """
    spark = rows.sparkSession
    writer = writer_id(spark, checkpoint)

    def append(batch: DataFrame, number: int) -> None:
        watermark = batch_watermark(batch.sparkSession, checkpoint, number) if marked else 0
        if others is None:
            commit_rows(batch, table, writer, number, watermark)
            return
        kept = batch.persist()
        try:
            for name, part in others(kept).items():
                commit_rows(part, name, writer, number, watermark)
        finally:
            kept.unpersist()

    stream = (
        rows.writeStream.outputMode("append")
        .foreachBatch(append)
        .queryName(f"append {table}")
        .option("checkpointLocation", checkpoint)
    )
    if trigger:
        stream = stream.trigger(**trigger)
    return stream.start()


def start_raw(
    messages: DataFrame,
    table: str,
    checkpoint: str,
    trigger: dict[str, Any] | None = None,
    lateness: str = DEFAULT_LATENESS,
    quarantine_table: str | None = None,
    lenient: bool = False,
    once: Sequence[str] = (),
    horizon: str = "1 hour",
) -> StreamingQuery:
    """Append every well-formed reading. No state, and late rows are kept.

    The watermark drops nothing here. It is noted with each batch, so that whoever follows the
    table knows which of its readings came after their window had closed. With a
    ``quarantine_table`` each message that is no reading is appended there with its reason, from
    the same parse: a batch is kept while both tables take their part of it.

    ``once`` names the columns that tell a message, where a broker may deliver it again within
    ``horizon``. That takes the query's only watermark, so its batches tell nothing of lateness.
    """
    if once:
        if quarantine_table is not None:
            raise ValueError("once and quarantine_table do not go together")
        readings = extract_readings(once_only(messages, once, horizon), RAW_METRICS, lenient)
        return start_rows(raw_rows(readings), table, checkpoint, trigger, marked=False)
    if quarantine_table is None:
        readings = extract_readings(messages, RAW_METRICS, lenient).withWatermark("publish_ts", lateness)
        return start_rows(raw_rows(readings), table, checkpoint, trigger)
    parsed = observed(parse_messages(messages, lenient, reasons=True), RAW_METRICS)
    # only readings make time pass
    timed = parsed.withColumn("_read", F.when(F.col("valid"), F.col("publish_ts"))).withWatermark("_read", lateness)

    def parts(batch: DataFrame) -> dict[str, DataFrame]:
        return {table: raw_rows(batch.where("valid")), quarantine_table: batch.where("NOT valid")}

    return start_rows(timed, table, checkpoint, trigger, parts)


def closed_windows(
    readings: DataFrame, duration: str = DEFAULT_WINDOW, lateness: str = DEFAULT_LATENESS
) -> DataFrame:
    """Aggregate rows of a stream; in append mode each window comes once, when it closes."""
    return agg_rows(windowed_stats(watched(readings, lateness), duration))


def start_aggregate(
    readings: DataFrame,
    table: str,
    checkpoint: str,
    duration: str = DEFAULT_WINDOW,
    lateness: str = DEFAULT_LATENESS,
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """Append one row per measure and closed window; readings later than that are dropped.

    The number of state partitions is the session's ``spark.sql.shuffle.partitions`` when the
    query first starts; its checkpoint keeps it for good, so set it for the load to come.
    """
    return start_rows(closed_windows(readings, duration, lateness), table, checkpoint, trigger)


def closed_co_group(
    inputs: Mapping[str, DataFrame], duration: str = DEFAULT_WINDOW, value: str = "value"
) -> DataFrame:
    """Streams of window aggregates co-grouped by window and measure, each window when it closes.

    ``inputs`` come from aggregations of ``duration`` over streams under watermarks; the
    co-group is a second stateful step of the same query, which takes the slowest input's
    watermark. Its state is a count and one value per tag of the windows still open. A window
    in which some input has no value, or several, is an error, as in ``co_group_only``.
    """
    again = {
        tag: df.select(F.window("window", duration).alias("window"), "measure", value) for tag, df in inputs.items()
    }
    return co_group_only(again, ["window", "measure"], value)


def closed_co_group_columns(aggregates: DataFrame, tags: Sequence[str], duration: str = DEFAULT_WINDOW) -> DataFrame:
    """``closed_co_group`` of several aggregates of one stream, which are the columns ``tags``.

    The stream is read, parsed and aggregated once: of each input a query reads by itself, it
    would do so again.
    """
    again = aggregates.select(F.window("window", duration).alias("window"), "measure", *tags)
    return co_group_columns(again, ["window", "measure"], tags)


def start_pair(
    messages: DataFrame,
    raw_table: str,
    agg_table: str,
    checkpoint: str,
    duration: str = DEFAULT_WINDOW,
    lateness: str = DEFAULT_LATENESS,
    trigger: dict[str, Any] | None = None,
    quarantine_table: str | None = None,
    lenient: bool = False,
) -> list[StreamingQuery]:
    """Both queries with one parse: the second follows what the first appends to the raw table.

    Whether a reading is late is settled by the batch it came in, so the summaries do not depend
    on how far the second query lags, and the raw table tells which readings they hold. With a
    trigger that ends (``availableNow``) the first query ends before the second starts.
    """
    spark = messages.sparkSession
    raw = start_raw(messages, raw_table, f"{checkpoint}/raw", trigger, lateness, quarantine_table, lenient)
    if trigger and (trigger.get("availableNow") or trigger.get("once")):
        raw.awaitTermination()
    writer = writer_id(spark, f"{checkpoint}/raw")
    readings = readings_from_raw(spark, raw_table, streaming=True, writer=writer, watermark=True)
    followed = in_time(readings, duration)
    return [raw, start_aggregate(followed, agg_table, f"{checkpoint}/agg", duration, lateness, trigger)]


def start_pipeline(
    spark: SparkSession,
    source: str,
    checkpoint: str,
    raw_table: str | None = DEFAULT_RAW_TABLE,
    agg_table: str | None = DEFAULT_AGG_TABLE,
    duration: str = DEFAULT_WINDOW,
    lateness: str = DEFAULT_LATENESS,
    format: str = "parquet",
    options: dict[str, str] | None = None,
    trigger: dict[str, Any] | None = None,
    aggregate_raw_table: bool | None = None,
    heartbeats: DataFrame | None = None,
    behind: str = "0 seconds",
    quarantine_table: str | None = None,
    lenient: bool = False,
) -> list[StreamingQuery]:
    """Provision both tables and start both queries on the same source.

    A table given as None is left out. With both, the second query follows the raw table
    (``start_pair``), so each payload is read and parsed once; ``aggregate_raw_table=False``
    makes the two independent. ``heartbeats`` close the windows of a silent source; they move
    the aggregate's time alone, so that query then reads the source itself. The raw query fills
    the ``quarantine_table``; ``lenient`` takes single quotes, bare words and the like.
    """
    follow = aggregate_raw_table
    if follow is None:
        follow = raw_table is not None and agg_table is not None and heartbeats is None
    if follow and raw_table is None:
        raise ValueError("aggregate_raw_table needs a raw_table")
    if follow and heartbeats is not None:
        raise ValueError("heartbeats need aggregate_raw_table=False")
    if quarantine_table is not None and raw_table is None:
        raise ValueError("quarantine_table needs a raw_table")
    require_stream_session(spark)
    ensure_table(spark, raw_table, RAW_SCHEMA)
    ensure_table(spark, agg_table, AGG_SCHEMA)
    ensure_table(spark, quarantine_table, QUARANTINE_SCHEMA)
    messages = read_messages(spark, source, True, format, options)
    if follow and agg_table is not None:
        return start_pair(messages, raw_table, agg_table, checkpoint, duration, lateness, trigger, quarantine_table, lenient)
    queries = []
    if raw_table is not None:
        queries.append(start_raw(messages, raw_table, f"{checkpoint}/raw", trigger, lateness, quarantine_table, lenient))
    if agg_table is not None:
        readings = extract_readings(messages, AGG_METRICS, lenient)
        if heartbeats is not None:
            readings = with_heartbeats(readings, heartbeats, behind)
        queries.append(start_aggregate(readings, agg_table, f"{checkpoint}/agg", duration, lateness, trigger))
    return queries


def wait_all(queries: Sequence[StreamingQuery]) -> None:
    """Block until every query has ended; if one fails, stop the others and raise."""
    running = list(queries)
    try:
        while running:
            # Looks at each in turn, so that no query's failure waits for another's end.
            running = [query for query in running if not query.awaitTermination(1)]
    finally:
        for query in running:
            query.stop()
