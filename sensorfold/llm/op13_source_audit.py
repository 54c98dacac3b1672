"""Source divergence audit: how far the sources of a language use its terms differently.

Terms are counted in tasks by length-bucketed packing. A term of up to 8 bytes is one big-endian
``uint64``, one of up to 16 two of them; such words are put in order by a radix sort of 16-bit
digits and counted as runs. Longer terms are sorted as bytes, a bucket per length. What a task
found is summed by Spark per language, source and term. Divergences are taken from fixed-point
shares in whole numbers, so every figure is exact and no order of additions shows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import released, settled, ship

#: Documents of the language that a kept term stands in, at least.
LEAST_DOCS = 3
#: Shares are whole numbers of this part.
SCALE = 1_000_000_000
#: Terms that a group's report lists.
TOP_TERMS = 200
#: Bytes of text packed at once, and numbers in a block of terms by sources.
PACK_BYTES = 4 << 20
BLOCK_CELLS = 1 << 20

# What a byte is in a term: itself, A-Z as a-z, and 0 for all that separates terms. Every byte of
# a character beyond ASCII is 128 or more.
_FOLD = np.zeros(256, dtype=np.uint8)
_FOLD[97:123] = _FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def radix_order(columns: list[np.ndarray]) -> np.ndarray:
    """Stable order of rows by unsigned ``columns``, the first one most significant.

    Least significant digit first, 16 bits at a time; digits that are all alike cost nothing.
    """
    order = np.arange(len(columns[0]))
    for column in reversed(columns):
        for shift in range(0, column.dtype.itemsize * 8, 16):
            digit = ((column >> column.dtype.type(shift)) & column.dtype.type(0xFFFF)).astype(np.uint16)
            if digit.size and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def _run_starts(columns: list[np.ndarray]) -> np.ndarray:
    """Places at which sorted rows differ from the row before."""
    new = np.ones(len(columns[0]), dtype=bool)
    if len(new) > 1:
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def _counted(group: np.ndarray, doc: np.ndarray, words: list[np.ndarray]) -> tuple:
    """Rows of ``(group, words..., count, documents)`` from one row per occurrence.

    ``doc`` tells documents apart and ``group`` is a function of it. Occurrences are counted per
    document first, then per group.
    """
    order = radix_order([*words, group, doc])
    group, doc, words = group[order], doc[order], [w[order] for w in words]
    by_doc = _run_starts([*words, group, doc])
    counts = np.diff(np.append(by_doc, len(doc)))
    group, words = group[by_doc], [w[by_doc] for w in words]
    by_group = _run_starts([*words, group])
    return (
        group[by_group],
        [w[by_group] for w in words],
        np.add.reduceat(counts, by_group) if len(counts) else counts,
        np.diff(np.append(by_group, len(counts))),
    )


def _packed(text: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Up to 8 bytes from each start as one big-endian number; the rest of it is zero."""
    out = np.zeros(len(starts), dtype=np.uint64)
    for k in range(8):
        byte = np.where(k < lengths, text[np.minimum(starts + k, len(text) - 1)], 0)
        out = (out << np.uint64(8)) | byte.astype(np.uint64)
    return out


def _unpacked(words: list[np.ndarray]) -> list[str]:
    data = np.stack(words, axis=1).astype(">u8").tobytes()
    width = 8 * len(words)
    return [data[i : i + width].rstrip(b"\0").decode("utf-8", "replace") for i in range(0, len(data), width)]


def count_terms(texts: list[bytes], groups: np.ndarray) -> Iterator[tuple[np.ndarray, list[str], np.ndarray, np.ndarray]]:
    """``(group, term, count, documents)`` of the texts, as columns, a bucket of lengths at a time."""
    text = _FOLD[np.frombuffer(b"\0".join([*texts, b""]), dtype=np.uint8)]
    ends_of_docs = np.cumsum([len(t) + 1 for t in texts])
    inside = np.concatenate(([0], (text != 0).view(np.int8), [0]))
    edges = np.diff(inside)
    starts = np.flatnonzero(edges == 1)
    lengths = np.flatnonzero(edges == -1) - starts
    if not len(starts):
        return
    doc = np.searchsorted(ends_of_docs, starts, side="right").astype(np.uint32)
    group = groups.astype(np.uint32)[doc]
    for low, high, width in ((1, 8, 1), (9, 16, 2)):
        here = np.flatnonzero((lengths >= low) & (lengths <= high))
        if len(here):
            words = [_packed(text, starts[here] + 8 * k, lengths[here] - 8 * k) for k in range(width)]
            found, words, counts, docs = _counted(group[here], doc[here], words)
            yield found, _unpacked(words), counts, docs
    long = np.flatnonzero(lengths > 16)
    for length in np.unique(lengths[long]):
        here = long[lengths[long] == length]
        terms = np.stack([text[s : s + length] for s in starts[here]]).view(f"S{length}").ravel()
        kinds, number = np.unique(terms, return_inverse=True)
        found, words, counts, docs = _counted(group[here], doc[here], [number.ravel().astype(np.uint32)])
        yield found, [kinds[k].decode("utf-8", "replace") for k in words[0]], counts, docs


def _packs(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[list[bytes], list[tuple[str, str]]]]:
    """Texts with their languages and sources, by :data:`PACK_BYTES`; a longer text stands alone."""
    texts, keys, size = [], [], 0
    for batch in batches:
        for lang, source, text in zip(batch["_lang"], batch["_source"], batch["_text"]):
            data = text.encode("utf-8", "replace")
            if texts and size + len(data) > PACK_BYTES:
                yield texts, keys
                texts, keys, size = [], [], 0
            texts.append(data)
            keys.append((lang, source))
            size += len(data)
    if texts:
        yield texts, keys


@released
def _count_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for texts, keys in _packs(batches):
        kinds = sorted(set(keys))
        number = {key: i for i, key in enumerate(kinds)}
        groups = np.array([number[key] for key in keys])
        for found, terms, counts, docs in count_terms(texts, groups):
            yield pd.DataFrame({
                "lang": [kinds[g][0] for g in found], "source": [kinds[g][1] for g in found],
                "term": terms, "n": counts.astype(np.int64), "docs": docs.astype(np.int64),
            })


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences and documents of every term."""
    ship(docs.sparkSession)
    rows = docs.select(*[
        F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
        for c, name in ((lang_col, "_lang"), (source_col, "_source"), (text_col, "_text"))
    ])
    found = rows.mapInPandas(_count_batches, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: Column, total: Column, terms: Column) -> Column:
    """The smoothed share in parts of :data:`SCALE`; decimals, so no count is too large."""
    parts = F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    return (F.lit(1) + _div(parts, total + terms)).cast("long")


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b.cast("decimal(20,0)"))


def _shares(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The same in numpy: nine decimal digits of ``(count + 1) / total`` by long division."""
    quotient, rest = np.divmod(counts + 1, total)
    for _ in range(9):
        digit, rest = np.divmod(rest * 10, total)
        quotient = quotient * 10 + digit
    return quotient + 1


def block_divergence(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Sums over a block's terms of ``(p - q)^2 / q``, rounded down per term, of source by source.

    ``counts`` has a row per term and a column per source, ``totals`` a source's count and terms
    together. Source ``a`` beside ``b`` is row ``a``, column ``b``.
    """
    shares = np.ascontiguousarray(_shares(counts, totals).T)
    out = np.empty((len(totals), len(totals)), dtype=np.int64)
    for b, q in enumerate(shares):
        gap = shares - q
        out[:, b] = (gap * gap // q).sum(axis=1)
    return out


def _divergence_task(sources: dict[str, tuple[list[str], list[int]]]):
    """A task over kept terms ``(lang, sources, counts)``: sums per language, source and other."""

    @released
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        places = {lang: {s: i for i, s in enumerate(names)} for lang, (names, _) in sources.items()}
        for batch in batches:
            for lang, part in batch.groupby("lang", sort=False):
                names, totals = sources[lang]
                rows = max(1, BLOCK_CELLS // len(names))
                for at in range(0, len(part), rows):
                    block = part.iloc[at : at + rows]
                    sizes = block["sources"].map(len).to_numpy()
                    counts = np.zeros((len(block), len(names)), dtype=np.int64)
                    place = [places[lang][s] for row in block["sources"] for s in row]
                    counts[np.repeat(np.arange(len(block)), sizes), place] = np.concatenate(list(block["counts"]))
                    found = block_divergence(counts, np.array(totals, dtype=np.int64))
                    sums[lang] = sums[lang] + found if lang in sums else found
        for lang, found in sums.items():
            names, n = np.array(sources[lang][0], dtype=object), len(found)
            for a in range(n):  # a row of the table at a time
                others = np.arange(n) != a
                yield pd.DataFrame({"lang": lang, "source": names[a], "item": names[others], "value": found[a][others]})

    return run


def source_audit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least_docs: int = LEAST_DOCS,
    top: int = TOP_TERMS,
) -> DataFrame:
    """``lang, source, part, item, value, rank`` of every source beside the others of its language.

    Part ``pair`` has each other source with the divergence from it, summed over the kept terms of
    the language; part ``term`` the ``top`` terms that the source uses more than its language
    does. Null texts, languages and sources count as empty; a row without terms still names its
    group. Rows that repeat count as often as they stand there. A language whose terms are all rare
    has only pairs, of value 0; an empty table gives no rows. Other columns are not read.

    Every group's name and total goes to all tasks: the answer has a row for every pair of
    them, so this table is the root of the answer's size. No term list is gathered anywhere.
    """
    named = docs.select(*[
        F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang_col, "lang"), (source_col, "source"))
    ]).distinct()
    counts = term_counts(docs, text_col, lang_col, source_col)
    kept = settled(
        counts.groupBy("lang", "term")
        .agg(
            F.sum("docs").alias("docs"), F.sum("n").alias("total"),
            F.collect_list(F.struct("source", "n")).alias("_u"),
        )
        .where(F.col("docs") >= least_docs)
        .select("lang", "term", "total", F.col("_u.source").alias("sources"), F.col("_u.n").alias("counts"))
    )
    each = kept.select("lang", "term", "total", F.explode(F.arrays_zip("sources", "counts")).alias("_u")).select(
        "lang", "term", "total", F.col("_u.sources").alias("source"), F.col("_u.counts").alias("n")
    )
    whole = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("lang_n"))
    own = each.groupBy("lang", "source").agg(F.sum("n").alias("source_n"))
    groups = settled(
        named.join(own, ["lang", "source"], "left").join(whole, "lang", "left").na.fill(0, ["source_n", "terms", "lang_n"])
    )

    sources: dict[str, tuple[list[str], list[int]]] = {}
    for row in groups.orderBy("lang", "source").collect():
        names, totals = sources.setdefault(row["lang"], ([], []))
        names.append(row["source"])
        totals.append(row["source_n"] + row["terms"])
    summed = kept.select("lang", "sources", "counts").mapInPandas(
        _divergence_task(sources), "lang string, source string, item string, value long"
    )
    other = groups.select("lang", F.col("source").alias("item"))
    none = groups.select("lang", "source").join(other, "lang").where("source <> item").withColumn("value", F.lit(0).cast("long"))
    pairs = summed.unionByName(none).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    p, q = _share(F.col("n"), F.col("source_n"), F.col("terms")), _share(F.col("total"), F.col("lang_n"), F.col("terms"))
    gap = F.col("_p") - F.col("_q")
    terms = (
        each.join(groups, ["lang", "source"])
        .select("lang", "source", F.col("term").alias("item"), p.alias("_p"), q.alias("_q"))
        .where("_p > _q")
        .select("lang", "source", "item", F.call_function("div", gap * gap, F.col("_q")).alias("value"))
    )
    ranked = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(ranked).alias("rank")
    listed = terms.select("*", rank).where(F.col("rank") <= top)
    out = ["lang", "source", "part", "item", "value", "rank"]
    return (
        pairs.select("*", rank).withColumn("part", F.lit("pair")).select(*out)
        .unionByName(listed.withColumn("part", F.lit("term")).select(*out))
    )


def op13_source_audit(spark, sf_dir: str) -> DataFrame:
    return source_audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
o AS (
  SELECT row, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM o GROUP BY lang, term HAVING count(DISTINCT row) >= {LEAST_DOCS}),
c AS (SELECT lang, source, term, count(*) AS n FROM o SEMI JOIN kept USING (lang, term) GROUP BY ALL),
l AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
g AS (
  SELECT x.lang, x.source, coalesce(l.v, 0)::HUGEINT AS v, coalesce(s.n, 0)::HUGEINT AS n, coalesce(l.n, 0)::HUGEINT AS ln
  FROM (SELECT DISTINCT lang, source FROM d) x LEFT JOIN l ON l.lang = x.lang
  LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL) s ON s.lang = x.lang AND s.source = x.source),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + {SCALE}::HUGEINT * (coalesce(c.n, 0) + 1) // (g.n + g.v) AS p,
         1 + {SCALE}::HUGEINT * (k.n + 1)::HUGEINT // (g.ln + g.v) AS q
  FROM g JOIN kept k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(x.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
  ) x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
term AS (SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM p WHERE n > 0 AND p > q),
r AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pair
  UNION ALL SELECT lang, source, 'term', item, value FROM term),
n AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM n WHERE part = 'pair' OR rank <= {TOP_TERMS}"""
