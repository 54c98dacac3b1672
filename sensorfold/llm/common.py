"""Shared helpers: the shared folder, lineage cuts and connected components."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import uuid
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Marks the characters that separate words (ASCII white space only).
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """A new folder under the cluster's ``spark.checkpoint.dir``; without that it is refused,
    since executors might write to their own disks."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package's source to the executors, once per application.

    Tasks import the package by name; nothing has to be installed where they run. Rows hold
    whole texts, so batches that go to Python get fewer rows than Spark's default.
    """
    context = spark.sparkContext
    if spark.conf.get(BATCH_ROWS) == "10000":
        spark.conf.set(BATCH_ROWS, "1000")
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(context._temp_dir) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def give_back() -> None:
    """Gives freed memory back to the machine.

    Workers are reused, and both Arrow's pool and the C library keep what was freed; beside an
    executor's heap that adds up.
    """
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries lack it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def released(task):
    """A task over batches that gives freed memory back to the machine at its end."""

    @functools.wraps(task)
    def run(batches):
        try:
            yield from task(batches)
        finally:
            give_back()

    return run


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared checkpoint folder; later reads survive lost executors."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def forget(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of steps that are settled and no longer referred to.

    Its cleaner learns that a shuffle is unreachable from the driver's garbage collection, which
    a driver with room to spare may put off for long; a job of many steps asks for it.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Bits of a bitmap of keys: 65,536 words of 64 bits, about 1 MB however many keys it takes.
BITMAP_BITS = 1 << 22


def _slot(key: Column, bits: int) -> tuple[Column, Column]:
    place = F.pmod(F.xxhash64(key, F.lit(7)), F.lit(bits))
    return F.floor(place / 64).cast("int"), F.pmod(place, F.lit(64)).cast("int")


def bitmap(keys: DataFrame, key: str, bits: int = BITMAP_BITS) -> DataFrame:
    """The keys as a bitmap of at most ``bits / 64`` rows, for :func:`marked`."""
    word, bit = _slot(F.col(key), bits)
    return settled(
        keys.select(word.alias("__word"), bit.alias("__bit"))
        .groupBy("__word")
        .agg(F.bit_or(F.expr("shiftleft(1L, __bit)")).alias("__mask"))
    )


def marked(rows: DataFrame, key: Column, keys: DataFrame, name: str, bits: int = BITMAP_BITS) -> DataFrame:
    """``rows`` with a boolean: false means that ``key`` is certainly not among the keys."""
    word, bit = _slot(key, bits)
    hit = F.coalesce(F.expr("(shiftright(__mask, __bit) & 1L) = 1L"), F.lit(False))
    return (
        rows.withColumns({"__word": word, "__bit": bit})
        .join(F.broadcast(keys), "__word", "left")
        .withColumn(name, hit)
        .drop("__word", "__bit", "__mask")
    )


def without(docs: DataFrame, dropped: DataFrame, id_col: str) -> DataFrame:
    """``docs`` less the rows whose id is in ``dropped(id)``, with all their columns.

    A bitmap of the dropped ids tells most rows apart where they are read; only the rows it
    hits are shuffled, texts and all, and joined.
    """
    dropped = settled(dropped.select(F.col(dropped.columns[0]).alias("__dropped")).distinct())
    near = marked(docs, F.col(id_col), bitmap(dropped, "__dropped"), "__may")
    hit = near.where("__may").join(dropped, F.col(id_col).eqNullSafe(F.col("__dropped")), "left_anti")
    return near.where("NOT __may").unionByName(hit).select(*docs.columns)


def unkept(found: DataFrame, id_col: str) -> DataFrame:
    """Ids of ``found(id, kept)`` of which no row is kept."""
    return found.groupBy(id_col).agg(F.max("kept").alias("kept")).where("NOT kept").select(id_col)


def forest(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Lowers ``labels`` (indices) until both ends of each edge agree."""
    while len(a):
        la, lb = labels[a], labels[b]
        differ = la != lb
        if not differ.any():
            return
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        low = np.minimum(la, lb)
        np.minimum.at(labels, la, low)
        np.minimum.at(labels, lb, low)
        while not np.array_equal(labels, labels[labels]):
            labels[:] = labels[labels]


#: Rows of a round of :func:`components` that one task takes, at most about. Rounds are many and
#: each has several shuffles, so tasks, and the files they leave, follow the edges.
ROUND_ROWS = 1 << 14


def components(nodes: DataFrame, edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest node id reachable from each node over undirected edges.

    ``nodes(node long)`` and ``edges(a long, b long)``; returns ``(node, component)``. Every
    round each node takes the least label among its neighbours' grandparents, passes it to
    its parent too, and then follows its parent once, so long chains shorten by halves.
    Nulls in edges are ignored; nodes without edges keep their own id. The loop stops when
    no label changes; running out of rounds raises, so no half-made answer is returned.
    """
    edges = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b")
    spark = edges.sparkSession
    # settled by callers, so that counting them is cheap
    tasks = max(spark.sparkContext.defaultParallelism, -(-2 * edges.count() // ROUND_ROWS))
    both = settled(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).coalesce(tasks))
    labels = settled(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("f"))
        .select("node", F.least("f", "node").alias("f")).coalesce(tasks)
    )
    # labels only ever fall, so equal sums mean that none did
    total = F.sum(F.col("f").cast("decimal(38,0)"))
    before = labels.agg(total).first()[0]
    for _ in range(max_rounds):
        parent = labels.select(F.col("node").alias("f"), F.col("f").alias("g"))
        known = settled(labels.join(parent, "f").select("node", "f", "g").coalesce(tasks))
        lows = (
            both.join(known.select(F.col("node").alias("b"), "g"), "b").select("a", "g").coalesce(tasks)
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("g").alias("low"))
        )
        least = F.least("low", "g").alias("w")
        wish = F.array(F.struct("node", least), F.struct(F.col("f").alias("node"), least))
        labels = settled(
            known.join(lows, "node").select(F.explode(wish).alias("_w")).coalesce(tasks)
            .groupBy("_w.node").agg(F.min("_w.w").alias("f")).coalesce(tasks)
        )
        after = labels.agg(total).first()[0]
        if after == before:
            break
        before = after
        del parent, known, lows
        forget(spark)
    else:
        raise RuntimeError("component labels did not settle")
    found = labels.select("node", F.col("f").alias("component"))
    return nodes.join(found, "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )
