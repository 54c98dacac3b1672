"""Quality classifier: document evidence and site posteriors by hierarchical empirical Bayes.

A logistic model on the shape of the text (cases, marks, digits, repetition) gives each
document's evidence. Labels of all labelled documents are summed by path and by host; the
strength of the prior that pulls a host to the global rate, and a path to its host, comes from
the spread of the rates themselves, so sparse sites are shrunk most. A document's log odds are its
evidence, as far as its length allows, plus its path's posterior. Where a table has URLs, host
and path are taken from them (``url_col``). The given documents have none: their source stands in
for the host and their language for the path.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settled, ship, unkept, without

#: Labelled rows the document model is fitted on, the first by a seeded order: 13 doubles each.
TRAIN_ROWS = 20_000
SEED = "quality-1"
THRESHOLD = 0.5
#: Words at which a text's own evidence counts half: a text of a few words says little.
HALF_WORDS = 5
#: Weight of an unlabelled document's own probability in its site's counts.
SOFT = 0.1

_WORD = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")
NAMES = (
    "upper", "digits", "exclaim", "bars", "other_marks", "newlines", "high_bytes", "distinct_words",
    "distinct_lines", "word_bytes", "log_bytes", "sentences",
)


def features(text: str) -> list[float]:
    """Shape of a text and, last and not for the model, its words; an empty one has only zeros."""
    data = text.encode("utf-8", "replace")
    if not data.strip():
        return [0.0] * (len(NAMES) + 1)
    n = len(data)
    seen = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    letters = seen[65:91].sum() + seen[97:123].sum()
    marks = seen[33:48].sum() + seen[58:65].sum() + seen[91:97].sum() + seen[123:127].sum()
    words = data.translate(_WORD).split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    exclaim, bars, ends = seen[33], seen[124], seen[46] + seen[33] + seen[63]
    return [
        seen[65:91].sum() / max(1, letters), seen[48:58].sum() / n, exclaim / n, bars / n,
        (marks - exclaim - bars) / n, seen[10] / n, seen[128:].sum() / n,
        # long texts repeat words anyway: as a share of what a text of this length may hold
        len(set(words)) / len(words) ** 0.8, len(set(lines)) / len(lines), n / len(words) / 10,
        np.log1p(n) / 10, ends / len(words), len(words),
    ]


def _features(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: [float(x) for x in features(t or "")])


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means, spreads and weights (intercept last) of a ridge logistic regression by Newton steps."""
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.hstack([np.clip((x - mean) / spread, -8, 8), np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    keep = np.full(z.shape[1], ridge)
    keep[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(keep), z.T @ (y - p) - keep * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return mean, spread, w


def train(labelled: DataFrame, rows: int = TRAIN_ROWS, seed: str = SEED) -> tuple | None:
    """A model from at most ``rows`` of ``labelled(_id, _x, _y)``; None without both classes.

    A threshold on a digest of the id picks about as many rows as are wanted where they are, so
    what reaches the driver does not grow with the table or its partitions.
    """
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("_id").cast("string"), F.lit(""))))
    place = F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint")
    n = labelled.count()
    share = min(1.0, 1.1 * rows / n) if n else 1.0
    near = labelled.select("_x", "_y", place.alias("_o")).where(F.col("_o") <= int(share * (1 << 48)))
    sample = near.toPandas()
    # ties in a fixed order, so that reruns fit the same rows
    key = [tuple(x) for x in sample["_x"]]
    sample = sample.assign(_k=key).sort_values(["_o", "_y", "_k"], ignore_index=True).head(rows)
    if not 0 < sample["_y"].sum() < len(sample):
        return None
    return fit(np.array(sample["_x"].tolist())[:, : len(NAMES)], sample["_y"].to_numpy(dtype=float))


def evidence(x: Column, model: tuple | None) -> Column:
    """Log odds of a document by its text alone; 0 without a model."""
    if model is None:
        return F.lit(0.0)
    mean, spread, w = model
    total = F.lit(float(w[-1]))
    for k in range(len(mean)):
        z = (x[k] - F.lit(float(mean[k]))) / F.lit(float(spread[k]))
        total = total + F.lit(float(w[k])) * F.greatest(F.least(z, F.lit(8.0)), F.lit(-8.0))
    return total


def _logit(p: Column) -> Column:
    p = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    return F.ln(p / (1 - p))


def _strength(sites: DataFrame, good: str, n: str, prior: Column) -> float:
    """Prior strength from the spread of site rates beyond what chance explains (moments)."""
    rate = F.col(good) / F.col(n)
    chance = prior * (1 - prior)
    s = sites.where(F.col(n) > 0).agg(
        F.sum(F.col(n) * (rate - prior) * (rate - prior)).alias("seen"), F.sum(chance).alias("chance"),
        F.sum((F.col(n) - 1) * chance).alias("room"),
    ).first()
    if s["seen"] is None:
        return 1.0
    between = (s["seen"] - s["chance"]) / s["room"] if s["room"] and s["room"] > 0 else 0.0
    return float(min(1e6, max(1.0, 1 / between - 1))) if between > 0 else 1e6


def url_site(url: Column, depth: int = 1) -> tuple[Column, Column]:
    """Host and path level of a URL: its first ``depth`` folders, without the page's own name.

    A null or malformed URL has the empty host and path.
    """
    text = F.coalesce(url.cast("string"), F.lit(""))
    site = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^?#]*)"
    folders = F.slice(F.split(F.regexp_extract(text, site, 2), "/"), F.lit(2), F.lit(max(0, depth)))
    # what follows the last slash is the page
    deep = F.greatest(F.size(F.split(F.regexp_extract(text, site, 2), "/")) - 2, F.lit(0))
    kept = F.slice(folders, F.lit(1), F.least(deep, F.lit(max(0, depth))))
    return F.lower(F.regexp_extract(text, site, 1)), F.array_join(kept, "/")


def site_posteriors(counts: DataFrame) -> tuple[DataFrame, float]:
    """``_host, _path, _site`` (posterior rate of the path) from ``_host, _path, _good, _n``, and the global rate."""
    total = counts.agg(F.sum("_good").alias("g"), F.sum("_n").alias("n")).first()
    rate = (total["g"] + 1.0) / (total["n"] + 2.0) if total["n"] else 0.5
    hosts = counts.groupBy("_host").agg(F.sum("_good").alias("_hg"), F.sum("_n").alias("_hn"))
    prior = F.lit(float(rate))
    m_host = _strength(hosts, "_hg", "_hn", prior)
    hosts = hosts.withColumn("_hp", (F.col("_hg") + m_host * prior) / (F.col("_hn") + m_host))
    both = counts.join(hosts.withColumnRenamed("_host", "_h"), F.col("_host").eqNullSafe(F.col("_h")))
    m_path = _strength(both, "_good", "_n", F.col("_hp"))
    site = (F.col("_good") + m_path * F.col("_hp")) / (F.col("_n") + m_path)
    return both.select("_host", "_path", site.alias("_site")), rate


def _scored(docs, labels, id_col, text_col, host, path, quality_col, train_rows, soft) -> tuple:
    """Rows with evidence, the model, and what is known of each path."""
    ship(docs.sparkSession)
    extract = F.pandas_udf(_features, "array<double>")
    rows = settled(docs.select(
        F.col(id_col).alias("_id"), host.alias("_host"), path.alias("_path"), extract(F.col(text_col)).alias("_x"),
    ))
    marks = (
        labels.where(F.col(quality_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id")).agg(F.avg(F.col(quality_col).cast("double")).alias("_rate"))
        .select("_id", F.when(F.col("_rate") >= 0.5, 1.0).otherwise(0.0).alias("_y"))
    )
    known = settled(rows.join(marks, "_id", "left"))
    model = train(known.where("_y IS NOT NULL"), train_rows)
    told = known.withColumn("_e", evidence(F.col("_x"), model)).withColumn("_words", F.col("_x")[len(NAMES)]).drop("_x")
    soft_p = 1 / (1 + F.exp(-F.col("_e")))
    weight = F.when(F.col("_y").isNotNull(), F.lit(1.0)).otherwise(F.lit(float(soft if model else 0.0)))
    counts = settled(told.groupBy("_host", "_path").agg(
        F.sum(weight * F.coalesce("_y", soft_p)).alias("_good"), F.sum(weight).alias("_n")
    ))
    sites, rate = site_posteriors(counts)
    return told, model, sites, rate


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    path_col: str = "lang",
    quality_col: str = "quality",
    train_rows: int = TRAIN_ROWS,
    soft: float = SOFT,
    threshold: float = THRESHOLD,
    url_col: str | None = None,
    path_depth: int = 1,
) -> DataFrame:
    """One row per row of ``docs``: id, ``evidence``, ``site_rate``, ``p_quality``, ``kept``.

    Labels of null quality or id are ignored; several labels of a document vote, ties count as
    good. Without labels of both classes evidence is 0 and only rates speak; without any labels
    every document has probability 0.5 and is kept. Null hosts and paths are sites of their
    own. With a ``url_col`` the URL's host and first ``path_depth`` folders are host and path, and
    the columns named for them are not read.
    Empty and null texts have no evidence, so their site alone decides. Rows that repeat an id each get a row.
    """
    host, path = url_site(F.col(url_col), path_depth) if url_col else (F.col(host_col), F.col(path_col))
    told, model, sites, rate = _scored(docs, labels, id_col, text_col, host, path, quality_col, train_rows, soft)
    sites = sites.withColumnsRenamed({"_host": "_sh", "_path": "_sp"})
    at_site = F.col("_host").eqNullSafe(F.col("_sh")) & F.col("_path").eqNullSafe(F.col("_sp"))
    share = F.col("_words") / (F.col("_words") + HALF_WORDS)
    odds = _logit(F.col("_site")) + share * (F.col("_e") - _logit(F.lit(float(rate))) * float(model is not None))
    p = 1 / (1 + F.exp(-odds))
    return told.join(sites, at_site).select(
        F.col("_id").alias(id_col), F.col("_e").alias("evidence"), F.col("_site").alias("site_rate"),
        p.alias("p_quality"), (p >= threshold).alias("kept"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that :func:`classify` turns down, with all their columns.

    Rows that share an id stay or go together: they stay if one of them does.
    """
    id_col = options.get("id_col", "doc_id")
    return without(docs, unkept(classify(docs, labels, **options), id_col), id_col)


def op5_quality(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return classify(docs, labels)
