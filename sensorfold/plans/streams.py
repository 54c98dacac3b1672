"""What a pair of streams has counted so far, what is still open, and what came too late."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorfold.functions.time import iso_millis, last_milli
from sensorfold.operators.rows import agg_rows
from sensorfold.schemas import DEFAULT_WINDOW
from sensorfold.sources.tables import readings_from_raw, stored_rows
from sensorfold.streaming.jobs import closed_until, writer_id

# The fields of a window's state, in the order of the aggregates of ``windowed_stats``. A mean
# is kept as a sum and a count; names in the state repeat, so they are given by place.
_STATE = "struct<max:int,min:int,sum:double,n:bigint,cnt:bigint>"

STATES = ("counted", "open", "late", "untimed")


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Windows that a query of ``start_aggregate`` still holds, as they are: aggregate rows.

    Read from the state that the query's last committed micro-batch left in its checkpoint; the
    query may be running or stopped. Nothing is aggregated again.
    """
    state = spark.read.format("statestore").load(checkpoint)
    return agg_rows(
        state.select("key.window", "key.measure", F.col("value").cast(_STATE).alias("_v")).select(
            "window", "measure", "_v.max", "_v.min", F.try_divide("_v.sum", F.col("_v.n")).cast("float").alias("avg"), "_v.cnt"
        )
    )


def _state(window: Column, watermark: Column, closed: Column) -> Column:
    return (
        F.when(window.isNull(), "untimed").when(window["end"] <= watermark, "late").when(window["end"] <= closed, "counted")
        .otherwise("open")
    )


def told_readings(
    spark: SparkSession, raw_table: str, checkpoint: str, duration: str = DEFAULT_WINDOW
) -> DataFrame:
    """Every reading that the pair at ``checkpoint`` has stored, with its ``window`` and ``state``.

    ``late``: its window had been closed when its batch came, so no summary has it. ``counted``:
    its window has been written since. ``open``: it waits in the state. ``untimed``: it has no
    publish time, and so no window. Batches carry what is needed; no join is made.
    """
    writer = writer_id(spark, f"{checkpoint}/raw")
    closed = F.timestamp_millis(F.lit(closed_until(spark, f"{checkpoint}/agg")))
    readings = readings_from_raw(spark, raw_table, writer=writer, watermark=True)
    # a window of a null time would drop the row
    held = F.window(F.coalesce("publish_ts", F.timestamp_seconds(F.lit(0))), duration)
    timed = readings.select("*", held.alias("_w")).withColumn("window", F.when(F.col("publish_ts").isNotNull(), F.col("_w")))
    return timed.withColumn("state", _state(F.col("window"), F.col("watermark"), closed)).drop("_w", "watermark")


def ledger(
    spark: SparkSession,
    raw_table: str,
    agg_table: str,
    checkpoint: str,
    duration: str = DEFAULT_WINDOW,
) -> DataFrame:
    """Per measure and window end (``ts``; null for readings without a time): the readings of each
    state, ``stored`` (what the aggregate table says it holds) and ``balanced``.

    Readings are counted before they meet the table's rows, so a hot measure is a row per
    window. ``balanced`` is false where the table differs from the counted readings.
    """
    told = told_readings(spark, raw_table, checkpoint, duration)
    ts = iso_millis(last_milli(F.col("window")))
    counts = told.groupBy("measure", ts.alias("ts")).agg(*[F.count_if(F.col("state") == s).alias(s) for s in STATES])
    writer = writer_id(spark, f"{checkpoint}/agg")
    stored = stored_rows(spark, agg_table, writer=writer).select("measure", "ts", F.col("cnt").alias("stored"))
    both = counts.join(stored, ["measure", "ts"], "full").na.fill(0, [*STATES, "stored"])
    return both.withColumn("balanced", F.col("stored") == F.col("counted"))
