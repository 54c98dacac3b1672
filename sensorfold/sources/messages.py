"""Reading messages: ``payload STRING, publish_ts TIMESTAMP`` from several formats."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorfold.schemas import MESSAGE_SCHEMA

TABULAR = ("parquet", "orc", "json")
FORMATS = (*TABULAR, "text", "kafka", "table")


def broker_records(records: DataFrame) -> DataFrame:
    """Broker records (``value BINARY, timestamp``) as messages."""
    return records.select(
        F.col("value").cast("string").alias("payload"),
        F.col("timestamp").cast("timestamp").alias("publish_ts"),
    )


def read_messages(
    spark: SparkSession,
    source: str,
    streaming: bool = False,
    format: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Messages from a path, a table or a topic, as a stream or as a table.

    ``parquet``, ``orc`` and ``json`` hold both columns; ``text`` holds one payload per line,
    published when its file was written; ``kafka`` takes the topic as ``source`` and needs
    Spark's Kafka package. Rate limits (``maxBytesPerTrigger``, ``maxOffsetsPerTrigger``)
    and other reader settings go in ``options``.
    """
    if format not in FORMATS:
        raise ValueError(f"unknown message format {format!r}; expected one of {FORMATS}")
    reader = (spark.readStream if streaming else spark.read).options(**dict(options or {}))
    if format == "kafka":
        return broker_records(reader.format("kafka").option("subscribe", source).load())
    if format == "text":
        return reader.text(source).select(
            F.col("value").alias("payload"),
            F.col("_metadata.file_modification_time").alias("publish_ts"),
        )
    if format == "table":
        rows = reader.table(source)
    else:
        rows = reader.format(format).schema(MESSAGE_SCHEMA).load(source)
    return rows.select("payload", F.col("publish_ts").cast("timestamp").alias("publish_ts"))


def deal_out(rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """Spread an input over so many partitions; None, the default, leaves it as it is.

    For inputs of a few large splits, such as files of one row group, where parsing costs more
    than a shuffle. Nothing is looked at, so the plan is the one asked for at every size.
    """
    return rows if partitions is None else rows.repartition(partitions)


def once_only(messages: DataFrame, keys: Sequence[str], horizon: str = "1 hour") -> DataFrame:
    """A stream without the messages that a broker delivers again within ``horizon``.

    ``keys`` name a message. They are kept as state for ``horizon`` after they came, by the clock
    of arrival: publish times have no part in it, so no late message is lost. A batch that is
    repeated has the same clock as the first time.
    """
    came = messages.withColumn("arrived", F.current_timestamp()).withWatermark("arrived", horizon)
    return came.dropDuplicatesWithinWatermark([*keys]).drop("arrived")
