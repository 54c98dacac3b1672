"""Session settings the library relies on, and the shared working folder."""

import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def configure_session(spark: SparkSession, rocksdb_state: bool = True) -> SparkSession:
    """Set the runtime options every job here expects; safe to call repeatedly.

    UTC is part of the output format (``ts`` is UTC text). The first shuffle
    width follows the cluster's cores, and AQE merges what turns out too small.
    State lives in RocksDB so that many open windows do not have to fit the heap. Of a key
    that a JSON object repeats the last one counts, as in the wire format.
    """
    conf = spark.conf
    conf.set("spark.sql.session.timeZone", "UTC")
    conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    conf.set("spark.sql.adaptive.enabled", "true")
    conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    width = max(
        int(conf.get("spark.sql.shuffle.partitions")),
        2 * spark.sparkContext.defaultParallelism,
    )
    conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(width))
    if rocksdb_state:
        conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
        conf.set(
            "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"
        )
    return spark


def require_utc(spark: SparkSession) -> None:
    """Timestamps are rendered as UTC text, so refuse any other session zone."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(
            f"spark.sql.session.timeZone must be UTC for the ts column, found {zone}"
        )


def require_last_key(spark: SparkSession) -> None:
    """The parser needs repeated keys allowed; else it would drop such messages unseen."""
    if spark.conf.get("spark.sql.variant.allowDuplicateKeys") != "true":
        raise ValueError(
            "spark.sql.variant.allowDuplicateKeys must be true: call configure_session first"
        )


def require_stream_session(spark: SparkSession) -> None:
    """What both streams rely on, checked before anything starts."""
    require_utc(spark)
    require_last_key(spark)
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass") != ROCKSDB_PROVIDER:
        raise ValueError("streams keep their state in RocksDB: call configure_session first")


def hadoop_path(spark: SparkSession, path: str):
    """A path and its file system, whatever store it names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def work_dir(spark: SparkSession) -> str:
    """A new folder path under the shared folder named by ``spark.checkpoint.dir``.

    Unset, it is refused: any other folder might be one machine's own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{base.rstrip('/')}/sensorfold-{uuid.uuid4().hex}"


def drop_work(spark: SparkSession, folder: str, tables: tuple[str, ...] = ()) -> None:
    """Drop tables kept under a folder of ``work_dir``, and the folder with their files."""
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    where, files = hadoop_path(spark, folder)
    files.delete(where, True)
