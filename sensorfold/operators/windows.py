"""Tumbling event-time windows and the aggregates over them.

``readings`` has ``measure, value, publish_ts``. Windows are half-open and aligned to
the epoch. Each function is one aggregation with map-side combining, so a measure that
holds most of the rows still reaches the shuffle as one row per window and task.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorfold.schemas import DEFAULT_WINDOW


def assign_window(
    df: DataFrame, duration: str = DEFAULT_WINDOW, ts: str = "publish_ts"
) -> DataFrame:
    """Add the ``window`` struct (``start``, ``end``) that each row falls in."""
    return df.select("*", F.window(ts, duration).alias("window"))


def _per_measure(readings: DataFrame, duration: str, *aggregates: Column) -> DataFrame:
    return readings.groupBy(
        F.window("publish_ts", duration).alias("window"), "measure"
    ).agg(*aggregates)


def max_per_measure(readings: DataFrame, duration: str = DEFAULT_WINDOW) -> DataFrame:
    return _per_measure(readings, duration, F.max("value").alias("max"))


def min_per_measure(readings: DataFrame, duration: str = DEFAULT_WINDOW) -> DataFrame:
    return _per_measure(readings, duration, F.min("value").alias("min"))


def mean_per_measure(readings: DataFrame, duration: str = DEFAULT_WINDOW) -> DataFrame:
    return _per_measure(readings, duration, F.avg("value").alias("mean"))


def count_per_measure(readings: DataFrame, duration: str = DEFAULT_WINDOW) -> DataFrame:
    return _per_measure(readings, duration, F.count("value").alias("cnt"))


def windowed_stats(readings: DataFrame, duration: str = DEFAULT_WINDOW) -> DataFrame:
    """Max, min, mean and count together: one scan, one shuffle, and no join.

    The mean is narrowed to 32 bits, as the stored value is.
    """
    return _per_measure(
        readings,
        duration,
        F.max("value").alias("max"),
        F.min("value").alias("min"),
        F.avg("value").cast("float").alias("avg"),
        F.count("value").alias("cnt"),
    )
