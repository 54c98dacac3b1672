"""Event-time helpers."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text format of timestamps stored as STRING (UTC session).
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def iso_millis(ts: Column) -> Column:
    """ISO-8601 text with milliseconds."""
    return F.date_format(ts, ISO_MILLIS)


def last_milli(window: Column) -> Column:
    """The last millisecond inside a half-open window; the timestamp of its summary."""
    return window["end"] - F.expr("INTERVAL '0.001' SECOND")
