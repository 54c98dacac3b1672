"""Table contracts. Names, types and column order are the interface."""

from pyspark.sql import types as T

MESSAGE_SCHEMA = T.StructType([
    T.StructField("payload", T.StringType()),
    T.StructField("publish_ts", T.TimestampType()),
])

RAW_SCHEMA = T.StructType([
    T.StructField("measure", T.StringType()),
    T.StructField("value", T.LongType()),
    T.StructField("received", T.LongType()),
    T.StructField("window_timestamp", T.TimestampType()),
])

AGG_SCHEMA = T.StructType([
    T.StructField("measure", T.StringType()),
    T.StructField("max", T.LongType()),
    T.StructField("min", T.LongType()),
    T.StructField("avg", T.DoubleType()),
    T.StructField("cnt", T.LongType()),
    T.StructField("ts", T.StringType()),
])

QUARANTINE_SCHEMA = T.StructType([
    T.StructField("payload", T.StringType()),
    T.StructField("publish_ts", T.TimestampType()),
    T.StructField("reason", T.StringType()),
])

# Which append a stored row came from, and up to when (epoch milliseconds) its stream's windows
# had been closed by then; tables are partitioned by them.
WRITER_COLUMNS = T.StructType([
    T.StructField("_watermark", T.LongType()),
    T.StructField("_writer", T.StringType()),
    T.StructField("_batch", T.LongType()),
])

# The tables' usual names.
DEFAULT_RAW_TABLE = "telemetry.sensor_data"
DEFAULT_AGG_TABLE = "telemetry.agg_sensor_data"
DEFAULT_WINDOW = "1 minute"
DEFAULT_LATENESS = "0 seconds"
