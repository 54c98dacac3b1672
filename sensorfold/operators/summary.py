"""Summaries of the raw and the aggregate table, and the comparison of both.

The reports are ``SELECT DISTINCT measure, f(x) OVER (PARTITION BY measure)`` queries.
Spark would run that form by moving every row to its measure's task. Grouping gives the
same rows and moves one partial row per measure and task.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorfold.schemas import DEFAULT_WINDOW

# Fixed value: marks aggregate rows in the comparison.
AGG_LABEL = "(Agg) "


def summary_raw(raw: DataFrame) -> DataFrame:
    """Per measure: max, min, mean and number of the raw values."""
    return raw.groupBy("measure").agg(
        F.max("value").alias("xMax"),
        F.min("value").alias("xMin"),
        F.avg("value").alias("xAvg"),
        F.count("value").alias("xCount"),
    )


def summary_agg(agg: DataFrame) -> DataFrame:
    """Per measure, from aggregate rows. ``xAvg`` is the plain mean of the window means."""
    return agg.groupBy("measure").agg(
        F.max("max").alias("xMax"),
        F.min("min").alias("xMin"),
        F.avg("avg").alias("xAvg"),
        F.sum("cnt").alias("xCount"),
    )


def summary_comparison(raw: DataFrame, agg: DataFrame) -> DataFrame:
    """Both summaries of the stored tables; aggregate rows carry a label."""
    labelled = summary_agg(agg).withColumn(
        "measure", F.concat(F.lit(AGG_LABEL), F.col("measure"))
    )
    return labelled.unionByName(summary_raw(raw))


def _buckets(readings: DataFrame, duration: str, *aggregates) -> DataFrame:
    """Aggregates per measure and window, and per measure of the readings without a time.

    Those are in no window, but the raw table has them: ``timed`` tells both apart.
    """
    return (
        readings.withColumn("timed", F.col("publish_ts").isNotNull())
        .groupBy(
            "measure",
            "timed",
            F.window(F.coalesce("publish_ts", F.timestamp_seconds(F.lit(0))), duration),
        )
        .agg(*aggregates)
    )


def comparison_from_readings(
    readings: DataFrame, duration: str = DEFAULT_WINDOW
) -> DataFrame:
    """``summary_comparison`` straight from readings, which are read and parsed once.

    Sums and counts fold from windows to totals without loss, so the raw side needs no second
    pass. Sums are decimals, which no table of 64-bit values can overflow.
    """
    windows = _buckets(
        readings.withColumn("value", F.col("value").cast("bigint")),
        duration,
        F.max("value").alias("max"),
        F.min("value").alias("min"),
        F.sum(F.col("value").cast("decimal(20,0)")).cast("decimal(38,0)").alias("total"),
        F.avg("value").cast("float").cast("double").alias("avg"),
        F.count("value").alias("cnt"),
    )

    def side(label: F.Column, mean: F.Column, *, timed_only: bool) -> F.Column:
        def of(aggregate, name: str) -> F.Column:
            return aggregate(F.when(F.col("timed"), F.col(name)) if timed_only else F.col(name))

        rows = F.count_if("timed") if timed_only else F.count(F.lit(1))
        return F.struct(
            rows.alias("rows"), label.alias("measure"), of(F.max, "max").alias("xMax"),
            of(F.min, "min").alias("xMin"), mean.alias("xAvg"), of(F.sum, "cnt").alias("xCount"),
        )

    agg_mean = F.avg(F.when(F.col("timed"), F.col("avg")))
    raw_mean = F.sum("total").cast("double") / F.nullif(F.sum("cnt"), F.lit(0))
    both = windows.groupBy("measure").agg(
        side(F.concat(F.lit(AGG_LABEL), F.col("measure")), agg_mean, timed_only=True).alias("agg"),
        side(F.col("measure"), raw_mean, timed_only=False).alias("raw"),
    )
    sides = both.select(F.explode(F.array("agg", "raw")).alias("side"))
    return sides.where("side.rows > 0").select(
        "side.measure", "side.xMax", "side.xMin", "side.xAvg", "side.xCount"
    )


def _ratio() -> list:
    return [
        F.col("raw_rows"),
        F.col("agg_rows"),
        F.try_divide(F.col("raw_rows"), F.col("agg_rows")).alias("ratio"),
    ]


def reduction_report(raw: DataFrame, agg: DataFrame) -> DataFrame:
    """One row: rows in each stored table, and how many raw rows one aggregate row replaces."""
    counts = raw.agg(
        F.count(F.lit(1)).alias("raw_rows"), F.lit(0).cast("bigint").alias("agg_rows")
    ).unionByName(
        agg.agg(F.lit(0).cast("bigint").alias("raw_rows"), F.count(F.lit(1)).alias("agg_rows"))
    )
    return counts.agg(
        F.sum("raw_rows").alias("raw_rows"), F.sum("agg_rows").alias("agg_rows")
    ).select(*_ratio())


def reduction_from_readings(
    readings: DataFrame, duration: str = DEFAULT_WINDOW
) -> DataFrame:
    """``reduction_report`` straight from readings, in one pass."""
    windows = _buckets(readings, duration, F.count(F.lit(1)).alias("cnt"))
    return windows.agg(
        F.coalesce(F.sum("cnt"), F.lit(0)).alias("raw_rows"),
        F.count_if("timed").alias("agg_rows"),
    ).select(*_ratio())
