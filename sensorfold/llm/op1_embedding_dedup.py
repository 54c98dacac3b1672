"""Near duplicates among embeddings: int8 tile products with error bounds.

Unit vectors are rounded to int8 with a scale of their own, and the length of the rounding error
is kept. For a pair, the cosine differs from the scaled integer product by at most
``e_a + e_b * (1 + e_a)``, so most pairs are decided by the product alone; only pairs whose bound
straddles the threshold are computed in double precision. Pairs never leave a tile: it gives
one row per linked vector, with the number of its links there and the smallest id it hangs
together with there.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, forest, settled, ship

#: Vectors per block; a tile holds two blocks.
BLOCK = 8_192
#: Rows of a tile multiplied at once.
STRIP = 1_024
THRESHOLD = 0.9


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Int8 codes, scales and lengths of the rounding errors of unit rows."""
    scale = np.abs(unit).max(axis=1, keepdims=True) / 127.0
    codes = np.rint(unit / scale)
    # the error itself is rounded in double precision: round it up
    error = np.sqrt(((unit - codes * scale) ** 2).sum(axis=1)) * (1 + 1e-9) + 1e-12
    return codes.astype(np.int8), scale[:, 0], error


def _valid(batch: pd.Series) -> pd.Series:
    """Vectors as bytes of doubles; None for what links with nothing."""

    def packed(v) -> bytes | None:
        if v is None:
            return None
        a = np.asarray(v, dtype=np.float64)
        if not a.size or not np.isfinite(a).all() or not a.any():
            return None
        big = np.abs(a).max()
        with np.errstate(over="ignore"):
            norm = np.linalg.norm(a)
        if not np.isfinite(norm) or norm < 1e-150:
            a = a / big  # the direction is what counts
        return (a + 0.0).tobytes()  # no negative zeros

    return batch.map(packed)


def _tile(threshold: float, strip: int, stats: bool = False) -> Callable:
    def run(tile: pd.DataFrame) -> pd.DataFrame:
        tile = tile.sort_values("_c", ignore_index=True)  # then labels by index are labels by id
        dim = len(tile["_v"].iloc[0]) // 8
        raw = np.frombuffer(b"".join(tile["_v"]), dtype=np.float64).reshape(-1, dim)
        unit = raw / np.linalg.norm(raw, axis=1, keepdims=True)
        codes, scale, error = quantised(unit)
        # float products of integers are exact up to 2^24
        kind = np.float32 if 127 * 127 * dim < 1 << 24 else np.float64
        codes = codes.astype(kind)
        times, side = tile["_m"].to_numpy(), tile["_side"].to_numpy()
        diagonal = bool(tile["_i"].iloc[0] == tile["_j"].iloc[0])
        left = np.flatnonzero(side == 0)
        right = left if diagonal else np.flatnonzero(side == 1)
        links, labels = np.zeros(len(tile), dtype=np.int64), np.arange(len(tile))
        scale_r, error_r, codes_r = scale[right], error[right], codes[right].T
        for at in range(0, len(left), strip):
            rows = left[at : at + strip]
            first = at if diagonal else 0  # of a diagonal tile the upper half
            near = (codes[rows] @ codes_r[:, first:]) * scale_r[first:].astype(kind)
            near *= scale[rows, None].astype(kind)
            most = error_r[first:].max() if first < len(right) else 0.0
            slack = 1e-5
            i, j = np.nonzero(near >= (threshold - slack - error[rows] - most * (1 + error[rows]))[:, None].astype(kind))
            value, a, b = near[i, j].astype(np.float64), rows[i], right[first + j]
            if diagonal:
                value, a, b = value[a < b], a[a < b], b[a < b]
            bound = slack + error[a] + error[b] * (1 + error[a])
            sure = value - bound >= threshold
            open_ = np.flatnonzero(~sure & (value + bound >= threshold))
            for k in range(0, len(open_), 100_000):
                o = open_[k : k + 100_000]
                sure[o] = np.einsum("ij,ij->i", unit[a[o]], unit[b[o]]) >= threshold
            a, b = a[sure], b[sure]
            links += np.bincount(a, times[b], len(tile)).astype(np.int64)
            links += np.bincount(b, times[a], len(tile)).astype(np.int64)
            forest(labels, a, b)
        hit = np.flatnonzero(links)
        ids = tile["_c"].to_numpy()
        return pd.DataFrame({"_c": ids[hit], "links": links[hit], "root": ids[labels[hit]]})

    return run


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    threshold: float = THRESHOLD,
    block: int = BLOCK,
    strip: int = STRIP,
) -> DataFrame:
    """One row per row of ``vectors``: id, ``n_links``, ``component_id``, ``kept``.

    Two vectors link when their cosine in double precision is at least ``threshold``; vectors
    of different lengths do not. Vectors that are null, empty, zero or hold null or non-finite
    components link with nothing, and so do rows without an id (their component is null and
    they are not kept). Identical vectors are one class with a count, so copies are never
    paired; rows that repeat an id count as vectors of their own. No vectors, no rows.
    """
    ship(vectors.sparkSession)
    pack = F.pandas_udf(_valid, "binary")
    # a null among the components becomes NaN, which the check turns down
    doubles = F.transform(F.col(vec_col), lambda x: F.coalesce(x.cast("double"), F.lit(float("nan"))))
    rows = settled(
        vectors.select(F.col(id_col).alias("_id"), pack(doubles).alias("_v")).withColumn(
            "_key", F.when(F.col("_id").isNotNull(), F.sha2("_v", 256))
        )
    )
    usable = rows.where("_key IS NOT NULL")
    classes = settled(
        usable.groupBy("_key").agg(
            F.min("_id").alias("_least"), F.count(F.lit(1)).alias("_m"), F.first("_v").alias("_v")
        )
    )
    # ids may repeat over different vectors, so a class has a number of its own
    classes = settled(classes.withColumn("_c", F.monotonically_increasing_id()))
    # ids may repeat over different vectors; a class is known by its own number
    n = classes.count()
    blocks = max(1, -(-n // block))
    own = F.pmod(F.xxhash64("_key"), F.lit(blocks)).cast("int")
    spread = (
        classes.withColumn("_b", own)
        .withColumn("_dim", F.octet_length("_v"))
        .withColumn("_o", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        .select(
            "_dim", F.least("_b", "_o").alias("_i"), F.greatest("_b", "_o").alias("_j"),
            (F.col("_b") > F.col("_o")).cast("int").alias("_side"), "_c", "_m", "_v",
        )
    )
    found = settled(
        spread.groupBy("_dim", "_i", "_j").applyInPandas(
            _tile(threshold, strip), "_c bigint, links bigint, root bigint"
        )
    )
    degree = found.groupBy("_c").agg(F.sum("links").alias("_links"))
    edges = found.select(F.col("_c").alias("a"), F.col("root").alias("b"))
    of = components(classes.select(F.col("_c").alias("node")), edges)
    facts = classes.select("_key", "_c", "_m", "_least").join(degree, "_c", "left").join(
        of.withColumnRenamed("node", "_c"), "_c"
    )
    names = facts.groupBy("component").agg(F.min("_least").alias("component_id"))
    facts = facts.join(names, "component")
    links = F.coalesce("_links", F.lit(0)) + F.col("_m") - 1
    told = usable.select("_id", "_key").join(
        facts.select("_key", links.alias("n_links"), "component_id"), "_key"
    ).select("_id", "n_links", "component_id")
    rest = rows.where("_key IS NULL").select(
        "_id", F.lit(0).cast("bigint").alias("n_links"), F.col("_id").alias("component_id")
    )
    return told.unionByName(rest).select(
        F.col("_id").alias(id_col), "n_links", "component_id",
        F.coalesce(F.col("_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )


def op1_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
ok AS (
  SELECT vec_id, e, len(e) AS dim FROM v
  WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
    ON a.vec_id <> b.vec_id AND a.dim = b.dim AND list_cosine_similarity(a.e, b.e) >= 0.9),
walk(vec_id, seen) AS (
  SELECT vec_id, vec_id FROM v
  UNION SELECT w.vec_id, l.b FROM walk w JOIN links l ON w.seen = l.a),
c AS (SELECT vec_id, min(seen) AS component_id FROM walk GROUP BY vec_id)
SELECT v.vec_id, count(l.b) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN c USING (vec_id) LEFT JOIN links l ON l.a = v.vec_id GROUP BY ALL"""
