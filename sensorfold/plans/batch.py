"""The whole job over static input, and the reports over its tables."""

import uuid

from pyspark.sql import DataFrame, SparkSession

from sensorfold.operators.extract import extract_readings
from sensorfold.operators.rows import agg_rows, raw_rows
from sensorfold.operators.summary import reduction_report, summary_comparison
from sensorfold.operators.windows import windowed_stats
from sensorfold.schemas import AGG_SCHEMA, DEFAULT_WINDOW, RAW_SCHEMA
from sensorfold.sources.tables import (
    append_rows,
    ensure_table,
    readings_from_raw,
    stored_rows,
)


def run_batch(
    messages: DataFrame,
    raw_table: str | None,
    agg_table: str | None,
    duration: str = DEFAULT_WINDOW,
    writer: str | None = None,
    batch: int = 0,
) -> str:
    """Append readings to the raw table and window summaries to the aggregate table.

    A table given as None is left out. With both, the summaries are taken from the rows this
    run has just put into the raw table, so messages are read and parsed once. A run under
    the same ``writer`` and ``batch`` as an earlier one replaces it; without a writer it is a
    run of its own. Returns the writer.
    """
    spark = messages.sparkSession
    writer = writer or uuid.uuid4().hex
    ensure_table(spark, raw_table, RAW_SCHEMA)
    ensure_table(spark, agg_table, AGG_SCHEMA)
    readings = extract_readings(messages)
    if raw_table is not None:
        append_rows(raw_rows(readings), raw_table, writer, batch)
        readings = readings_from_raw(spark, raw_table, writer=writer, batch=batch)
    if agg_table is not None:
        append_rows(agg_rows(windowed_stats(readings, duration)), agg_table, writer, batch)
    return writer


def compare_tables(spark: SparkSession, raw_table: str, agg_table: str) -> DataFrame:
    return summary_comparison(stored_rows(spark, raw_table), stored_rows(spark, agg_table))


def reduce_tables(spark: SparkSession, raw_table: str, agg_table: str) -> DataFrame:
    return reduction_report(stored_rows(spark, raw_table), stored_rows(spark, agg_table))
