"""Shaping rows for the two tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorfold.functions.time import iso_millis, last_milli
from sensorfold.schemas import AGG_SCHEMA, RAW_SCHEMA
from sensorfold.session import require_utc


def _as_declared(schema: T.StructType, **columns: Column) -> list[Column]:
    return [columns[f.name].cast(f.dataType).alias(f.name) for f in schema]


def key_value(readings: DataFrame) -> DataFrame:
    return readings.select("measure", "value")


def raw_rows(readings: DataFrame) -> DataFrame:
    """Rows of the raw table. ``window_timestamp`` is the publish time in milliseconds."""
    return readings.select(
        *_as_declared(
            RAW_SCHEMA,
            measure=F.col("measure"),
            value=F.col("value"),
            received=F.col("received"),
            window_timestamp=F.date_trunc("MILLISECOND", "publish_ts"),
        )
    )


def agg_rows(stats: DataFrame) -> DataFrame:
    """Rows of the aggregate table from ``windowed_stats``."""
    require_utc(stats.sparkSession)
    return stats.select(
        *_as_declared(
            AGG_SCHEMA,
            measure=F.col("measure"),
            max=F.col("max"),
            min=F.col("min"),
            avg=F.col("avg").cast("float"),
            cnt=F.col("cnt"),
            ts=iso_millis(last_milli(F.col("window"))),
        )
    )
