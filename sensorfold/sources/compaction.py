"""Many small appends of a table made few, beside running writers.

A manifest in the table's folder names, per writer, the batch up to which its appends have been
rewritten, and the generations of rewritten rows that count. Putting a new manifest in place is
one rename of a file: before it readers (``stored_rows``) see the old appends, after it the new
rows, never both. A batch that a manifest covers is never appended again.
"""

import json
import uuid
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorfold.schemas import WRITER_COLUMNS
from sensorfold.session import hadoop_path

EMPTY: dict[str, Any] = {"generation": 0, "generations": [], "through": {}}


def quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def table_files(spark: SparkSession, table: str) -> tuple[str, str]:
    """A table's folder and file format."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)}").where("col_name IN ('Location', 'Provider')").collect()
    found = {r["col_name"]: r["data_type"] for r in rows}
    return found["Location"], found["Provider"]


def read_manifest(spark: SparkSession, location: str) -> dict[str, Any]:
    """The newest manifest; without one nothing has been rewritten."""
    folder, files = hadoop_path(spark, f"{location}/_manifest")
    if not files.exists(folder):
        return EMPTY
    names = [f.getPath().getName() for f in files.listStatus(folder)]
    done = [int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit()]
    if not done:
        return EMPTY
    where, _ = hadoop_path(spark, f"{location}/_manifest/{max(done)}.json")
    source = files.open(where)
    try:
        return json.loads(bytes(source.readAllBytes()).decode("utf-8"))
    finally:
        source.close()


def covers(manifest: Mapping[str, Any], writer: str, batch: int) -> bool:
    """Whether a batch has been rewritten."""
    return 0 <= batch <= manifest["through"].get(writer, -1)


def valid(manifest: Mapping[str, Any]) -> Column:
    """The rows that count: rewritten ones of a named generation, and appends not yet rewritten."""
    batch, writer = F.col("_batch"), F.col("_writer")
    rewritten = batch.isin([-g for g in manifest["generations"]]) if manifest["generations"] else F.lit(False)
    appended = batch >= 0
    for name, through in manifest["through"].items():
        appended &= (writer != name) | (batch > through)
    return rewritten | appended


def _put(spark: SparkSession, location: str, manifest: Mapping[str, Any]) -> None:
    draft, files = hadoop_path(spark, f"{location}/_staging/{uuid.uuid4().hex}.json")
    final, _ = hadoop_path(spark, f"{location}/_manifest/{manifest['generation']}.json")
    out = files.create(draft, False)
    out.write(json.dumps(manifest).encode("utf-8"))
    out.close()
    files.mkdirs(final.getParent())
    if files.exists(final) or not files.rename(draft, final):
        raise RuntimeError(f"generation {manifest['generation']} is there already: is another compaction running?")


def _partitions(spark: SparkSession, table: str) -> DataFrame:
    """The table's partitions ``(_watermark, _writer, _batch)``, from the catalog."""
    parts = spark.sql(f"SHOW PARTITIONS {quoted(table)}")
    cut = [F.regexp_extract("partition", f"{name}=([^/]*)", 1).cast(kind).alias(name) for name, kind in
           ((f.name, f.dataType) for f in WRITER_COLUMNS)]
    return parts.select(*cut)


def _drop(spark: SparkSession, table: str, location: str, parts: DataFrame) -> None:
    for r in parts.toLocalIterator():
        spec = f"_watermark = {r['_watermark']}L, _writer = :writer, _batch = {r['_batch']}L"
        spark.sql(f"ALTER TABLE {quoted(table)} DROP IF EXISTS PARTITION ({spec})", args={"writer": r["_writer"]})
        names = "/".join(f"{name}={r[name]}" for name in WRITER_COLUMNS.names)
        folder, files = hadoop_path(spark, f"{location}/{names}")
        files.delete(folder, True)


def compact(
    spark: SparkSession,
    table: str,
    through: Mapping[str, int],
    event_time: str | None = None,
    duration: str | None = None,
) -> int:
    """Rewrite each writer's appends up to the batch ``through`` names; returns the generation.

    Name no batch that a stream following the table has yet to read: its files go. Running
    writers go on meanwhile, and a second compaction at the same time fails. What broke off is
    cleared by the next run, and no reader sees it.

    The rows of a writer become one partition. With ``event_time`` and ``duration`` they become
    two, those whose window had been closed when they came apart from the others, so that each
    still tells whether it was late. Files are cut by size, so a writer of most rows is
    rewritten by many tasks.
    """
    location, provider = table_files(spark, table)
    before = read_manifest(spark, location)
    generation = before["generation"] + 1
    spark.catalog.refreshTable(table)
    # leftovers: what the manifest has replaced, and generations that it does not name
    _drop(spark, table, location, _partitions(spark, table).where(~valid(before)))

    rows = spark.table(table).where(F.col("_batch") >= 0)
    chosen = F.lit(False)
    for writer, last in through.items():
        chosen |= (F.col("_writer") == writer) & (F.col("_batch") <= int(last))
    late = F.lit(False)
    if event_time and duration:
        end = F.window(F.coalesce(event_time, F.timestamp_seconds(F.lit(0))), duration)["end"]
        rows = rows.select("*", end.alias("_end"))
        late = F.col(event_time).isNotNull() & (F.col("_end") <= F.timestamp_millis("_watermark"))
    newest = rows.where(chosen).agg(F.max("_watermark")).first()[0]
    if newest is not None:
        marked = rows.where(chosen).withColumns(
            {"_watermark": F.when(late, F.lit(newest)).otherwise(F.lit(0)).cast("bigint"), "_batch": F.lit(-generation).cast("bigint")}
        ).select(*spark.table(table).columns)
        staging = f"{location}/_staging/{uuid.uuid4().hex}"
        marked.hint("rebalance", *[F.col(c) for c in WRITER_COLUMNS.names]).write.partitionBy(*WRITER_COLUMNS.names).format(provider).save(staging)
        _move(spark, table, location, staging)
    done = {w: max(int(n), before["through"].get(w, -1)) for w, n in through.items()}
    _put(spark, location, {
        "generation": generation,
        "generations": [*before["generations"], *([generation] if newest is not None else [])],
        "through": {**before["through"], **done},
    })
    spark.catalog.refreshTable(table)
    _drop(spark, table, location, _partitions(spark, table).where(~valid(read_manifest(spark, location))))
    spark.catalog.refreshTable(table)
    return generation


def _move(spark: SparkSession, table: str, location: str, staging: str) -> None:
    """The partitions of a finished rewrite into the table's folder: two a writer at most."""
    top, files = hadoop_path(spark, staging)

    def below(folder) -> list:
        return [f.getPath() for f in files.listStatus(folder) if f.isDirectory()]

    for watermark in below(top):
        for writer in below(watermark):
            for batch in below(writer):
                names = [p.getName() for p in (watermark, writer, batch)]
                final, _ = hadoop_path(spark, "/".join([location, *names]))
                files.mkdirs(final.getParent())
                if not files.rename(batch, final):
                    raise RuntimeError(f"{names} could not be moved into {table}")
                w, n, b = (name.split("=", 1)[1] for name in names)
                spark.sql(
                    f"ALTER TABLE {quoted(table)} ADD IF NOT EXISTS PARTITION (_watermark = {int(w)}L, _writer = :writer, _batch = {int(b)}L)",
                    args={"writer": n},
                )
