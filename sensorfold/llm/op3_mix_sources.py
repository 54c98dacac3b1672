"""Mixing sources to target weights by capped water-filling.

Every source has a size (words) and a weight, and all of them share a budget. Sources whose
share exceeds ``max_epochs`` times their size are clamped there, and what they leave is shared
again by weight among the rest until nobody is above. A source then gives its whole rounds of
repetitions, and the rest of its target in a seeded order of its documents: whole ones, and a
fraction of the one at the cut. So a source gives its target to the word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, WORD, settled

#: Weights by rank of the source, repeating.
WEIGHTS = (3, 1, 2)
BUDGET, MAX_EPOCHS, SEED = 1.5, 2.0, "mix-1"
#: The seeded order is cut into so many ranges per source; sums over ranges come first, so no
#: task ever orders a whole source.
RANGE_BITS = 12
#: Sources of which the table of rounds and cuts is broadcast; more are joined.
BROADCAST_SOURCES = 10_000


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def seeded_rank(seed: str, id_col: Column) -> Column:
    """60 bits of a digest of seed and id; the same on every run and cluster."""
    digest = F.md5(F.encode(F.concat(F.lit(seed + ":"), F.coalesce(id_col.cast("string"), F.lit(""))), "UTF-8"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def ranked_sources(sizes: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """``sizes(source, source_size)`` with the weight of each source's rank by code point, null last.

    Ranks come from a range partitioning and the row counts of its partitions, so the
    sources need not fit one task; the driver sees one number per partition.
    """
    keyed = sizes.withColumn("_null", F.col("source").isNull())
    spread = (
        keyed.repartitionByRange("_null", "source")
        .sortWithinPartitions("_null", "source")
        .withColumn("_m", F.monotonically_increasing_id())
    )
    spread = settled(spread)
    part, row = F.shiftright("_m", 33), F.col("_m").bitwiseAND((1 << 33) - 1)
    counts = spread.groupBy(part.alias("p")).count().orderBy("p").collect()
    before, offsets = 0, {}
    for c in counts:
        offsets[c["p"]] = before
        before += c["count"]
    if not offsets:
        return spread.select("source", "source_size", F.lit(1.0).alias("weight"))
    table = F.create_map(*[F.lit(x) for pair in offsets.items() for x in pair])
    rank = F.element_at(table, part) + row
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weight = F.element_at(cycle, (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    return spread.select("source", "source_size", weight.alias("weight"))


def water_fill(sources: DataFrame, budget: float, max_epochs: float) -> DataFrame:
    """``sources(source, source_size, weight)`` with ``target`` double.

    Each round fixes the sources above their cap and shares the rest anew; the driver holds
    three sums a round. If all sources are at their cap the targets add up to less than the
    budget. Sources of size 0 have target 0.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    state = settled(
        sources.withColumn("clamped", F.col("source_size") == 0)
    )
    total = state.agg(F.sum("source_size")).first()[0] or 0
    while True:
        sums = state.agg(
            F.sum(F.when(F.col("clamped"), cap)).alias("fixed"),
            F.sum(F.when(~F.col("clamped"), F.col("weight"))).alias("weight"),
        ).first()
        left = float(total) * budget - (sums["fixed"] or 0.0)
        if not sums["weight"]:
            return state.select("source", "source_size", cap.alias("target"))
        share = F.lit(left) * F.col("weight") / F.lit(sums["weight"])
        above = ~F.col("clamped") & (share > cap)
        if state.where(above).isEmpty():
            target = F.when(F.col("clamped"), cap).otherwise(share)
            return state.select("source", "source_size", target.alias("target"))
        state = settled(state.withColumn("clamped", F.col("clamped") | above))


def _shares(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    budget: float = BUDGET,
    max_epochs: float = MAX_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """Per document the whole rounds of its source, and the words taken beyond them.

    ``budget`` is the share of all words the mix has; ``weights`` go to the sources by code
    point of their names, null last, repeating; ``max_epochs`` caps a source.
    """
    rows = settled(
        docs.select(
            F.col(id_col).alias("_id"),
            F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"),
            seeded_rank(seed, F.col(id_col)).alias("_h"),
        )
    ).withColumn("_range", F.shiftright("_h", 60 - RANGE_BITS))
    ranges = settled(rows.groupBy("source", "_range").agg(F.sum("size").alias("_sum")))
    sizes = ranges.groupBy("source").agg(F.sum("_sum").alias("source_size"))
    targets = water_fill(ranked_sources(sizes, weights), budget, max_epochs)

    # words before each range, then before each document of a range
    earlier = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.withColumn("_start", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
    same = starts["source"].eqNullSafe(targets["source"])
    plan = starts.join(targets, same).select(
        starts["source"].alias("_source"), F.col("_range").alias("_plan_range"), "_start", "source_size", "target"
    )
    order = Window.partitionBy("source", "_range").orderBy("_h", "_id", "size")
    inside = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = rows.withColumn("_inside", inside)
    match = placed["source"].eqNullSafe(plan["_source"]) & (placed["_range"] == plan["_plan_range"])
    whole = F.floor(F.col("target") / F.col("source_size"))
    rounds = F.when(F.col("source_size") > 0, whole).otherwise(0)
    extra = F.round("target").cast("bigint") - rounds * F.col("source_size")
    part = F.least(F.greatest(extra - (F.col("_start") + F.col("_inside")), F.lit(0)), F.col("size"))
    return placed.join(plan, match).select(
        "_id", "source", "size", "source_size", "target", "_h",
        rounds.cast("bigint").alias("_rounds"), part.cast("bigint").alias("_part"),
    )


def mix(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per row of ``docs``: id, ``source``, ``size``, ``source_size``, ``target``, ``taken``.

    ``taken`` counts the words the mix takes of a document, repeats included. Documents of no
    words (null, empty or blank text) have size 0 and give 0. A null source is a source of its
    own, ranked last. Rows that repeat an id count as documents of their own and stand side by
    side in the seeded order. An empty table gives an empty result. For the options see
    :func:`_shares`.
    """
    return _shares(docs, id_col, **options).select(
        F.col("_id").alias(id_col), "source", "size", "source_size", "target",
        (F.col("_rounds") * F.col("size") + F.col("_part")).alias("taken"),
    )


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    chars_col: str = "n_chars", seed: str = SEED, **options,
) -> DataFrame:
    """The mix itself: rows of ``docs``, repeated or left out as :func:`mix` says.

    The document at a source's cut gives a last row of as many first words as are wanted, joined by one
    space, with its length in ``chars_col``; rows that repeat its id and size share what it takes. What a source takes is known by its rounds and the
    place of its cut in the seeded order, so texts are not shuffled: that table has a row per
    source, and is broadcast if they are few.
    """
    shares = settled(_shares(docs, id_col, text_col, source_col, seed=seed, **options))
    place = F.struct("_h", F.col("_id").cast("string"), "size")
    # what rows of one place (an id that repeats) take together; the last such place is the cut
    taking = shares.where("_part > 0").groupBy("source", place.alias("place")).agg(F.sum("_part").alias("part"))
    ends = taking.groupBy(F.col("source").alias("__of")).agg(F.max(F.struct("place", "part")).alias("__cut"))
    rounds_of = shares.groupBy(F.col("source").alias("__source")).agg(F.max("_rounds").alias("__rounds"))
    cuts = settled(
        rounds_of.join(ends, F.col("__source").eqNullSafe(F.col("__of")), "left").select("__source", "__rounds", "__cut")
    )
    few = cuts.count() <= BROADCAST_SOURCES
    size = word_count(F.col(text_col))
    here = F.struct(seeded_rank(seed, F.col(id_col)), F.col(id_col).cast("string"), size)
    before, same = here < F.col("__cut.place"), here == F.col("__cut.place")
    joined = docs.join(F.broadcast(cuts) if few else cuts, F.col(source_col).eqNullSafe(F.col("__source")))
    told = joined.withColumn("__size", size).withColumn("__same", F.coalesce(same, F.lit(False)))
    plain = told.where("NOT __same").withColumn("__part", F.coalesce(F.when(before, size), F.lit(0)))
    # rows at a cut share its words one after the other
    turn = F.row_number().over(Window.partitionBy("__source").orderBy(F.xxhash64(text_col)))
    left = F.col("__cut.part") - (F.col("__turn") - 1) * F.col("__size")
    at_cut = told.where("__same").withColumn("__turn", turn).withColumn(
        "__part", F.greatest(F.least(left, F.col("__size")), F.lit(0))
    ).drop("__turn")
    counted = plain.withColumn("__part", F.col("__part").cast("bigint")).unionByName(at_cut.withColumn("__part", F.col("__part").cast("bigint")))
    times = F.col("__rounds") + F.when((F.col("__part") > 0) & (F.col("__part") == F.col("__size")), 1).otherwise(0)
    rest = F.when(F.col("__part") < F.col("__size"), F.col("__part")).otherwise(0)
    # whole repetitions have rest 0; a fraction is one more row
    rows = F.concat(F.array_repeat(F.lit(0).cast("bigint"), times.cast("int")), F.filter(F.array(rest.cast("bigint")), lambda n: n > 0))
    taken = counted.where(F.col("__size") > 0).withColumn("__rest", F.explode(rows))
    words = F.slice(F.split(F.trim(F.regexp_replace(text_col, SPACE, " ")), " "), F.lit(1), F.col("__rest").cast("int"))
    text = F.when(F.col("__rest") == 0, F.col(text_col)).otherwise(F.array_join(words, " "))
    out = taken.withColumn(text_col, text)
    if chars_col in docs.columns:
        kind = docs.schema[chars_col].dataType
        out = out.withColumn(chars_col, F.when(F.col("__rest") == 0, F.col(chars_col)).otherwise(F.char_length(text_col)).cast(kind))
    return out.select(*docs.columns)


def op3_mix_sources(spark, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("source")


# The same mix in closed form: in order of cap by weight, a source is clamped when the level
# that its cap stands for costs no more than the budget.
SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM d GROUP BY source),
o AS (
  SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) * 1.5 AS total,
         coalesce(sum(2 * source_size) OVER before, 0) AS fixed,
         sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS open_w
  FROM s WINDOW before AS (ORDER BY source_size * 1.0 / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, 2 * source_size * open_w < (total - fixed) * w OR source_size = 0 AS clamped FROM o),
r AS (
  SELECT max(total) - coalesce(sum(2 * source_size) FILTER (WHERE clamped), 0) AS rest,
         CAST(sum(w) FILTER (WHERE NOT clamped) AS DOUBLE) AS open_w FROM c),
t AS (
  SELECT source, source_size,
         CAST(CASE WHEN clamped THEN 2 * source_size ELSE rest * w / r.open_w END AS DOUBLE) AS target
  FROM c, r),
p AS (
  SELECT d.*, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS rounds,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(rounds * size
            + least(greatest(CAST(round(target) AS BIGINT) - rounds * source_size - before, 0), size) AS BIGINT) AS taken
FROM p"""
