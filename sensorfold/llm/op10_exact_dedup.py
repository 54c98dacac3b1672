"""Exact duplicate groups by progressive refinement: length, prefix hash, full hash.

Each step looks further into a text only where the step before saw its key twice. What the
steps hand on is a bitmap of fixed size, so a rare false hit costs one more hash and never a
wrong group; the last step groups by length, prefix hash and SHA-256 of the whole text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BITMAP_BITS, SPACE, bitmap, marked, settled, unkept, without

def normalised(text: Column) -> Column:
    """Runs of ASCII white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def _repeated(rows: DataFrame, key: str, bits: int) -> DataFrame:
    """Bitmap of the keys that occur at least twice."""
    return bitmap(rows.groupBy(key).count().where("count > 1"), key, bits)


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    prefix_chars: int = 256,
    bitmap_bits: int = BITMAP_BITS,
) -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical after :func:`normalised`. A null text counts as empty, so
    nulls and empty texts form one group. The smallest id of a group stays; rows that repeat
    an id each get a row, and a null id only stays in a group of nulls (``keep_id`` null).
    An empty table gives an empty result. Other columns of ``docs`` are not read.
    """
    rows = docs.select(F.col(id_col).alias("_id"), normalised(F.col(text_col)).alias("_text"))
    length = F.length("_text")
    by_length = _repeated(rows.select(length.alias("_len")), "_len", bitmap_bits)
    sized = marked(rows.withColumn("_len", length), F.col("_len"), by_length, "_same_len", bitmap_bits)

    prefix = F.xxhash64(F.substring("_text", 1, prefix_chars), "_len")
    keyed = sized.withColumn("_prefix", F.when(F.col("_same_len"), prefix))
    by_prefix = _repeated(keyed.where("_same_len").select("_prefix"), "_prefix", bitmap_bits)
    checked = marked(keyed, F.col("_prefix"), by_prefix, "_same_prefix", bitmap_bits)

    digest = F.sha2(F.encode("_text", "UTF-8"), 256).alias("_sha")
    alone = checked.where("NOT _same_prefix").select(
        F.col("_id").alias(id_col),
        F.col("_id").alias("keep_id"),
        F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"),
        digest.alias("text_sha256"),
    )
    open_rows = settled(checked.where("_same_prefix").select("_id", "_len", "_prefix", digest))
    key = ["_len", "_prefix", "_sha"]
    groups = open_rows.groupBy(*key).agg(
        F.min("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    # The larger side keeps every row of a hot group; as a plain join on the key its
    # oversized partitions are split by AQE.
    grouped = open_rows.join(groups, key).select(
        F.col("_id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )
    return alone.unionByName(grouped)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of equal texts, of the smallest id, with all columns of ``docs``.

    Of rows that share both id and text, the first by a digest of all columns stays; rows that
    share an id with different texts stay or go together: they stay if one of them does.
    """
    left = without(docs, unkept(exact_groups(docs, id_col, text_col), id_col), id_col)
    again = settled(docs.groupBy(F.col(id_col).alias("_twice")).agg(F.count(F.lit(1)).alias("_k")).where("_k > 1"))
    # only rows whose id may occur twice are looked at, and moved
    near = marked(left, F.col(id_col), bitmap(again, "_twice"), "_may")
    text = F.xxhash64(normalised(F.col(text_col))), F.sha1(F.encode(normalised(F.col(text_col)), "UTF-8"))
    whole = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in docs.columns])
    turn = F.row_number().over(Window.partitionBy(F.col(id_col), *text).orderBy(whole))
    hit = near.where("_may").withColumn("_turn", turn).where("_turn = 1")
    return near.where("NOT _may").select(*docs.columns).unionByName(hit.select(*docs.columns))


def op10_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
  FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t"""
