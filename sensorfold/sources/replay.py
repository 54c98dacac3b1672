"""Replaying stored tables as broker messages.

Telemetry events become device messages on the wire; texts become the junk that
shares the topic. Works on static and streaming input, and touches every row.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorfold.functions.payload import wire_quote

TEXT_START = 1_704_067_200  # 2024-01-01T00:00:00Z


def event_messages(events: DataFrame) -> DataFrame:
    """Two messages per event: its reading, and its properties as a status object.

    The reading is well formed. The status object is valid JSON but not an array, so the
    parser has to turn it down. Columns: ``origin, message_id, payload, publish_ts``.
    """
    ts = F.col("ts").cast("timestamp")
    reading = F.to_json(
        F.array(
            F.struct(
                F.col("event_type").alias("meaning"),
                F.col("value"),
                F.unix_millis(ts).alias("received"),
            )
        )
    )
    sent = F.array(
        F.struct(F.lit("reading").alias("origin"), wire_quote(reading).alias("payload")),
        F.struct(F.lit("status").alias("origin"), wire_quote(F.col("props")).alias("payload")),
    )
    return events.select(
        F.col("event_id").alias("message_id"), ts.alias("publish_ts"), F.explode(sent).alias("m")
    ).select("m.origin", "message_id", "m.payload", "publish_ts")


def text_messages(documents: DataFrame) -> DataFrame:
    """Whole texts sent as they are, one second apart, in the order of their ids."""
    return documents.select(
        F.lit("document").alias("origin"),
        F.col("doc_id").alias("message_id"),
        F.col("text").alias("payload"),
        F.timestamp_seconds(F.lit(TEXT_START) + F.col("doc_id")).alias("publish_ts"),
    )
