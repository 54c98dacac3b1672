"""Co-grouping any number of keyed inputs.

All functions tag each input, stack them and group once. A key found in any input
appears in the result. For windowed inputs, name the window among the keys.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _stack(inputs: Mapping[str, DataFrame], keys: Sequence[str], value: str) -> DataFrame:
    """Keys, the tag, and one column per tag (its own type) that holds the tag's value."""
    if not inputs:
        raise ValueError("co-grouping needs at least one input")
    clash = set(inputs) & ({*keys} | {"tag", "slice", "n"})
    if clash:
        raise ValueError(f"tags may not be named like keys or result columns: {sorted(clash)}")
    stacked = None
    for tag, df in inputs.items():
        part = df.select(*keys, F.lit(tag).alias("tag"), F.col(value).alias(tag))
        stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)
    return stacked


def co_group_only(
    inputs: Mapping[str, DataFrame], keys: Sequence[str], value: str = "value"
) -> DataFrame:
    """One row per key with each tag's single value; an error if it has none or several.

    Keeps a count and one value per tag, so the state per key has a fixed size and combines
    before the shuffle, however often a key occurs.
    """
    return _only(_stack(inputs, keys, value), list(inputs), keys)


def co_group_columns(df: DataFrame, keys: Sequence[str], tags: Sequence[str]) -> DataFrame:
    """``co_group_only`` of inputs that stand side by side, as the columns ``tags`` of one.

    What ``df`` comes from is computed once, not once per tag.
    """
    each = [F.struct(F.lit(tag).alias("tag"), *[(F.col(t) if t == tag else F.lit(None).cast(df.schema[t].dataType)).alias(t) for t in tags]) for tag in tags]
    stacked = df.select(*keys, F.explode(F.array(*each)).alias("_each")).select(*keys, "_each.*")
    return _only(stacked, tags, keys)


def _only(stacked: DataFrame, tags: Sequence[str], keys: Sequence[str]) -> DataFrame:
    aggregates = []
    for tag in tags:
        here = F.col("tag") == tag
        aggregates.append(
            F.struct(
                F.count_if(here).alias("n"),
                F.any_value(F.when(here, F.col(tag)), True).alias("only"),
            ).alias(f"_{tag}")
        )
    grouped = stacked.groupBy(*keys).agg(*aggregates)
    checked = [
        F.when(F.col(f"_{tag}.n") == 1, F.col(f"_{tag}.only"))
        .otherwise(
            F.raise_error(
                F.concat(
                    F.lit(f"tag {tag}: expected exactly one value, found "),
                    F.col(f"_{tag}.n").cast("string"),
                )
            )
        )
        .alias(tag)
        for tag in tags
    ]
    return grouped.select(*keys, *checked)


def co_group(
    inputs: Mapping[str, DataFrame], keys: Sequence[str], value: str = "value"
) -> DataFrame:
    """All values of each tag per key: one row per key, tag and distinct value.

    Columns are the keys, ``tag``, one column per tag (its own type; the tag's value) and
    ``n``, the repeats. Rows do not grow with the key, and repeats combine before the shuffle.
    """
    return (
        _stack(inputs, keys, value)
        .groupBy(*keys, "tag", *inputs)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def co_group_lists(
    inputs: Mapping[str, DataFrame],
    keys: Sequence[str],
    value: str = "value",
    slices: int = 1,
) -> DataFrame:
    """The same as arrays of ``(value, n)``: the keys, ``slice``, and one array per tag.

    Every key is dealt by hash over ``slices`` slices, whatever its size; slices without
    values have no row. Together a key's slices hold each value exactly once. Choose as many
    as the largest key needs for its arrays to fit a task.
    """
    if slices < 1:
        raise ValueError("slices must be at least 1")
    tags = list(inputs)
    dealt = co_group(inputs, keys, value).withColumn(
        "slice", F.pmod(F.xxhash64("tag", *tags), F.lit(slices)).cast("int")
    )
    lists = [
        F.collect_list(
            F.when(F.col("tag") == tag, F.struct(F.col(tag).alias("value"), F.col("n")))
        ).alias(tag)
        for tag in tags
    ]
    return dealt.groupBy(*keys, "slice").agg(*lists)
