"""Provisioning and appending to the output tables."""

import uuid
from itertools import zip_longest

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorfold.schemas import WRITER_COLUMNS
from sensorfold.session import hadoop_path
from sensorfold.sources.compaction import covers, quoted, read_manifest, table_files, valid


def _shape(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema]


def ensure_table(
    spark: SparkSession,
    name: str | None,
    schema: T.StructType | None,
    location: str | None = None,
    format: str = "parquet",
) -> bool:
    """Create the table, and its schema part, if absent; else check it. True if created.

    Does nothing when name or schema is unset. The table has the declared columns and, as
    partitions, those that name the append (``WRITER_COLUMNS``). An existing table must have
    the same column names, types and order. Nullability does not count: stored columns read
    back nullable.
    """
    if name is None or schema is None:
        return False
    full = T.StructType([*schema.fields, *WRITER_COLUMNS.fields])
    if spark.catalog.tableExists(name):
        found, wanted = _shape(spark.table(name).schema), _shape(full)
        if found != wanted:
            differ = [
                f"column {i + 1} is {f}, wanted {w}"
                for i, (f, w) in enumerate(zip_longest(found, wanted))
                if f != w
            ]
            raise RuntimeError(f"cannot append to {name}: " + "; ".join(differ))
        return False
    if "." in name:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(name.rsplit('.', 1)[0])}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full)
    parts = ", ".join(f"`{f.name}`" for f in WRITER_COLUMNS)
    where = "" if location is None else " LOCATION '" + location.replace("'", "\\'") + "'"
    spark.sql(f"CREATE TABLE {quoted(name)} ({columns}) USING {format} PARTITIONED BY ({parts}){where}")
    return True


def append_rows(rows: DataFrame, table: str, writer: str | None = None, batch: int = 0) -> str:
    """Append a static DataFrame, by column name; returns the writer's id.

    Every append has a partition of its own, ``(writer, batch)``. Appending the same one again
    replaces it, so a repeated batch adds nothing, and writers never touch each other's
    rows: any number of jobs may append to a table. Without a ``writer`` the append is a
    new one. A batch that has been compacted stays as it is.
    """
    writer = writer or uuid.uuid4().hex
    spark = rows.sparkSession
    if covers(read_manifest(spark, table_files(spark, table)[0]), writer, batch):
        return writer
    declared = [c for c in spark.table(table).columns if c not in WRITER_COLUMNS.names]
    columns = ", ".join(f"`{c}`" for c in declared)
    spark.sql(
        f"INSERT OVERWRITE TABLE {quoted(table)} "
        f"PARTITION (_watermark = 0L, _writer = :writer, _batch = {int(batch)}) SELECT {columns} FROM {{rows}}",
        args={"writer": writer},
        rows=rows,
    )
    return writer


def commit_rows(rows: DataFrame, table: str, writer: str, batch: int, watermark: int = 0) -> bool:
    """Append a batch in one step, once: False if it is already there.

    The rows are written beside the table and moved into it as a whole folder, so a stream that
    follows the table sees all of a batch or nothing, and a repeated batch leaves the files alone
    that were read meanwhile. The file system has to rename a folder in one step, as HDFS and
    local disks do. The last writer's part of a batch that broke off is never read.
    """
    spark = rows.sparkSession
    location, provider = table_files(spark, table)
    if covers(read_manifest(spark, location), writer, batch):
        return False
    names = dict(zip(WRITER_COLUMNS.names, (watermark, writer, batch), strict=True))
    final, files = hadoop_path(spark, "/".join([location, *(f"{k}={v}" for k, v in names.items())]))
    declared = [c for c in spark.table(table).columns if c not in names]
    new = not files.exists(final)
    if new:
        staging, _ = hadoop_path(spark, f"{location}/_staging/{uuid.uuid4().hex}")
        rows.select(*declared).write.format(provider).save(staging.toString())
        files.mkdirs(final.getParent())
        if not files.rename(staging, final):
            raise RuntimeError(f"batch {batch} of {writer} could not be moved into {table}")
    values = f"_watermark = {int(watermark)}L, _writer = :writer, _batch = {int(batch)}L"
    spark.sql(f"ALTER TABLE {quoted(table)} ADD IF NOT EXISTS PARTITION ({values})", args={"writer": writer})
    return new


def _appended(spark: SparkSession, table: str, streaming: bool, writer: str | None, batch: int | None) -> DataFrame:
    """A stream takes appends as they come; a table counts each row once, compacted or not."""
    if streaming:
        rows = spark.readStream.table(table).where("_batch >= 0")
    else:
        rows = spark.table(table).where(valid(read_manifest(spark, table_files(spark, table)[0])))
    if writer is not None:
        rows = rows.where(F.col("_writer") == writer)
    return rows if batch is None else rows.where(F.col("_batch") == batch)


def stored_rows(
    spark: SparkSession,
    table: str,
    streaming: bool = False,
    writer: str | None = None,
    batch: int | None = None,
) -> DataFrame:
    """A table's declared columns, of all appends or those of one writer or batch."""
    return _appended(spark, table, streaming, writer, batch).drop(*WRITER_COLUMNS.names)


def readings_from_raw(
    spark: SparkSession,
    table: str,
    streaming: bool = False,
    writer: str | None = None,
    batch: int | None = None,
    watermark: bool = False,
) -> DataFrame:
    """Readings back from the raw table, so that payloads are parsed only once.

    Windows of whole milliseconds take the stored publish time as they take the original one.
    A value that another program stored and that no reading can hold becomes NULL. With
    ``watermark`` each reading has the time up to which windows were closed when it came.
    """
    return _appended(spark, table, streaming, writer, batch).select(
        "measure",
        F.col("value").try_cast("int").alias("value"),
        "received",
        F.col("window_timestamp").alias("publish_ts"),
        *([F.timestamp_millis("_watermark").alias("watermark")] if watermark else []),
    )
