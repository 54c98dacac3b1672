"""Windows, co-grouping, rows and summaries against their literal twins."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sensorfold.operators import (
    agg_rows,
    assign_window,
    co_group,
    co_group_lists,
    co_group_only,
    comparison_from_readings,
    count_per_measure,
    extract_readings,
    key_value,
    max_per_measure,
    mean_per_measure,
    min_per_measure,
    raw_rows,
    reduction_from_readings,
    reduction_report,
    summary_agg,
    summary_comparison,
    summary_raw,
    token_counts,
    tokenize_letters,
    windowed_stats,
)
from sensorfold.schemas import AGG_SCHEMA, RAW_SCHEMA
from sensorfold.sources import event_messages

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def readings(spark, tmp_path_factory):
    """Parsed once and stored, because every test here reads it."""
    path = str(tmp_path_factory.mktemp("readings"))
    events = spark.read.parquet(f"{SF}/events.parquet")
    extract_readings(event_messages(events)).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def skewed(spark):
    """One measure holds more than a third of the rows, and most of them in one window."""
    return spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("m"), F.col("id") % 50)).alias("measure"),
        (F.col("id") % 977).cast("int").alias("value"),
        F.col("id").alias("received"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id"))).alias("publish_ts"),
    )


def same(left, right):
    right = right.select(*left.columns)
    assert left.exceptAll(right).isEmpty()
    assert right.exceptAll(left).isEmpty()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shape(schema):
    return [(f.name, f.dataType) for f in schema]


# --- windows --------------------------------------------------------------------------


def test_windows_are_half_open_and_epoch_aligned(spark):
    times = ["2024-01-01 00:00:00", "2024-01-01 00:00:59.999999", "2024-01-01 00:01:00", "1969-12-31 23:59:30"]
    df = spark.createDataFrame([(t,) for t in times], "t string").select(
        F.to_timestamp("t").alias("publish_ts")
    )
    starts = [r[0] for r in assign_window(df).select(F.col("window.start").cast("string")).collect()]
    assert starts == [
        "2024-01-01 00:00:00", "2024-01-01 00:00:00", "2024-01-01 00:01:00", "1969-12-31 23:59:00",
    ]


@pytest.mark.parametrize("duration", ["1 minute", "1 hour"])
def test_single_aggregates_match_the_fused_one(skewed, duration):
    fused = windowed_stats(skewed, duration)
    parts = [
        max_per_measure(skewed, duration),
        min_per_measure(skewed, duration),
        mean_per_measure(skewed, duration).select(
            "window", "measure", F.col("mean").cast("float").alias("avg")
        ),
        count_per_measure(skewed, duration),
    ]
    for part in parts:
        same(part, fused)


def test_counts_are_conserved(skewed):
    total = windowed_stats(skewed).agg(F.sum("cnt")).first()[0]
    assert total == skewed.count()


def test_agg_rows_text_and_narrowing(spark):
    ts = dt.datetime(2024, 1, 1, 0, 9, 30)
    df = spark.createDataFrame(
        [("a", 1, 0, ts), ("a", 1, 0, ts), ("a", 2, 0, ts)],
        "measure string, value int, received bigint, publish_ts timestamp",
    )
    row = agg_rows(windowed_stats(df)).first()
    assert row["ts"] == "2024-01-01T00:09:59.999Z"
    assert (row["max"], row["min"], row["cnt"]) == (2, 1, 3)
    assert row["avg"] == 1.3333333730697632  # 4/3 as a 32-bit float
    assert row["avg"] != 4 / 3


def test_agg_rows_refuse_another_time_zone(spark, readings):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        with pytest.raises(ValueError, match="UTC"):
            agg_rows(windowed_stats(readings))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_raw_rows_keep_publish_time_in_milliseconds(spark):
    ts = dt.datetime(2024, 1, 1, 0, 9, 30, 123987)
    df = spark.createDataFrame(
        [("a", 1, 7, ts)], "measure string, value int, received bigint, publish_ts timestamp"
    )
    assert tuple(raw_rows(df).first()) == ("a", 1, 7, ts.replace(microsecond=123000))


def test_declared_schemas(readings):
    assert shape(raw_rows(readings).schema) == shape(RAW_SCHEMA)
    assert shape(agg_rows(windowed_stats(readings)).schema) == shape(AGG_SCHEMA)
    assert key_value(readings).columns == ["measure", "value"]


# --- plans ----------------------------------------------------------------------------


def test_flagship_plan_has_one_shuffle_and_no_python(readings):
    text = plan(agg_rows(windowed_stats(readings)))
    assert text.count("Exchange") == 1
    assert "partial_max" in text
    assert "Python" not in text
    assert "Join" not in text


def test_summaries_do_not_use_window_operators(readings):
    for df in (summary_raw(raw_rows(readings)), summary_agg(agg_rows(windowed_stats(readings)))):
        text = plan(df)
        assert "Window [" not in text
        assert "partial_" in text


def test_aggregates_read_only_their_columns(readings):
    text = plan(max_per_measure(readings))
    schema = text.split("ReadSchema: ")[1].splitlines()[0]
    assert "received" not in schema and "message_id" not in schema


# --- co-grouping ----------------------------------------------------------------------


def four(readings, duration="1 hour"):
    parts = {
        "max": max_per_measure(readings, duration).withColumnRenamed("max", "value"),
        "min": min_per_measure(readings, duration).withColumnRenamed("min", "value"),
        "mean": mean_per_measure(readings, duration).withColumnRenamed("mean", "value"),
        "cnt": count_per_measure(readings, duration).withColumnRenamed("cnt", "value"),
    }
    return co_group_only(parts, ["window", "measure"])


def test_four_way_co_group_equals_the_fused_aggregate(spark, skewed):
    grouped = four(skewed, "1 minute").withColumn("avg", F.col("mean").cast("float")).drop("mean")
    same(grouped, windowed_stats(skewed, "1 minute"))


def test_co_group_is_right_when_aqe_coalesces_unevenly(spark, skewed):
    """Stacked inputs may keep their partitioning; merging partitions must not break it."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    try:
        for size in ("1b", "2kb", "20kb"):
            spark.conf.set(key, size)
            grouped = four(skewed, "1 minute")
            assert grouped.count() == windowed_stats(skewed, "1 minute").count()
    finally:
        spark.conf.set(key, before)


def test_only_keeps_a_null_value_and_types(spark):
    a = spark.createDataFrame([("x", None), ("y", 2)], "k string, value int")
    b = spark.createDataFrame([("x", "s"), ("y", "t")], "k string, value string")
    out = co_group_only({"a": a, "b": b}, ["k"])
    assert out.dtypes == [("k", "string"), ("a", "int"), ("b", "string")]
    assert sorted(map(tuple, out.collect())) == [("x", None, "s"), ("y", 2, "t")]


@pytest.mark.parametrize("rows, found", [([], 0), ([("x", 1), ("x", 1)], 2)])
def test_only_fails_on_none_or_several(spark, rows, found):
    a = spark.createDataFrame([("x", 1)], "k string, value int")
    b = spark.createDataFrame(rows, "k string, value int")
    with pytest.raises(Exception, match=f"tag b: expected exactly one value, found {found}"):
        co_group_only({"a": a, "b": b}, ["k"]).collect()


def test_co_group_keeps_keys_of_any_input(spark):
    a = spark.createDataFrame([("x", 1), ("x", 1), ("x", 2), (None, 9)], "k string, value int")
    b = spark.createDataFrame([("y", "s")], "k string, value string")
    c = spark.createDataFrame([], "k string, value double")
    out = co_group({"a": a, "b": b, "c": c}, ["k"])
    assert out.columns == ["k", "tag", "a", "b", "c", "n"]
    assert sorted(map(tuple, out.collect()), key=repr) == [
        ("x", "a", 1, None, None, 2), ("x", "a", 2, None, None, 1),
        ("y", "b", None, "s", None, 1), (None, "a", 9, None, None, 1),
    ]
    lists = {
        r["k"]: (r["slice"], sorted(map(tuple, r["a"])), [tuple(i) for i in r["b"]], r["c"])
        for r in co_group_lists({"a": a, "b": b, "c": c}, ["k"]).collect()
    }
    assert lists == {
        "x": (0, [(1, 2), (2, 1)], [], []),
        "y": (0, [], [("s", 1)], []),
        None: (0, [(9, 1)], [], []),
    }


def test_co_group_counts_null_values(spark):
    a = spark.createDataFrame([("x", None), ("x", None), ("x", 1)], "k string, value int")
    row = co_group_lists({"a": a}, ["k"]).first()
    assert sorted(map(tuple, row["a"]), key=repr) == [(1, 1), (None, 2)]


@pytest.mark.parametrize("slices", [1, 7])
def test_slices_hold_every_value_once_at_any_size(skewed, slices):
    maxima = max_per_measure(skewed).withColumnRenamed("max", "value")
    inputs = {"all": skewed, "maxima": maxima}
    grouped = co_group_lists(inputs, ["measure"], slices=slices)
    for tag, source in (("all", skewed), ("maxima", maxima)):
        unfolded = grouped.select("measure", F.explode(tag).alias("i")).select("measure", "i.value", "i.n")
        same(unfolded, source.groupBy("measure", "value").agg(F.count(F.lit(1)).alias("n")))
    assert grouped.groupBy("measure", "slice").count().where("count > 1").isEmpty()
    assert grouped.where((F.col("slice") < 0) | (F.col("slice") >= slices)).isEmpty()
    few = {tag: df.where("value % 50 = 0") for tag, df in inputs.items()}
    assert co_group_lists(few, ["measure"], slices=slices).columns == grouped.columns
    with pytest.raises(ValueError):
        co_group_lists(inputs, ["measure"], slices=0)


def test_co_group_scans_each_input_once_and_joins_nothing(readings):
    for grouped in (co_group({"all": readings}, ["measure"]), co_group_lists({"all": readings}, ["measure"], slices=5)):
        text = plan(grouped)
        assert text.count("FileScan") == 1
        assert "Join" not in text


def test_co_group_refuses_bad_tags(spark, readings):
    with pytest.raises(ValueError):
        co_group({}, ["measure"])
    with pytest.raises(ValueError):
        co_group({"measure": readings}, ["measure"])


# --- summaries ------------------------------------------------------------------------


def test_summary_equals_the_literal_window_query(spark, skewed):
    raw_rows(skewed).createOrReplaceTempView("raw_twin")
    agg_rows(windowed_stats(skewed)).createOrReplaceTempView("agg_twin")
    raw_sql = spark.sql("""
        SELECT DISTINCT measure, max(value) OVER (PARTITION BY measure) AS xMax,
               min(value) OVER (PARTITION BY measure) AS xMin,
               avg(value) OVER (PARTITION BY measure) AS xAvg,
               count(value) OVER (PARTITION BY measure) AS xCount FROM raw_twin""")
    agg_sql = spark.sql("""
        SELECT DISTINCT measure, max(max) OVER (PARTITION BY measure) AS xMax,
               min(min) OVER (PARTITION BY measure) AS xMin,
               round(avg(avg) OVER (PARTITION BY measure), 9) AS xAvg,
               sum(cnt) OVER (PARTITION BY measure) AS xCount FROM agg_twin""")
    same(summary_raw(spark.table("raw_twin")), raw_sql)
    rounded = summary_agg(spark.table("agg_twin")).withColumn("xAvg", F.round("xAvg", 9))
    same(rounded, agg_sql)


def test_mean_of_means_is_not_weighted(spark):
    rows = [("m", 10, 1.0, 1), ("m", 20, 4.0, 3)]
    agg = spark.createDataFrame(
        [(m, v, v, a, c, "") for m, v, a, c in rows],
        "measure string, max bigint, min bigint, avg double, cnt bigint, ts string",
    )
    row = summary_agg(agg).first()
    assert (row["xMax"], row["xMin"], row["xAvg"], row["xCount"]) == (20, 10, 2.5, 4)


def test_one_pass_comparison_equals_the_two_table_one(skewed):
    two = summary_comparison(raw_rows(skewed), agg_rows(windowed_stats(skewed)))
    one = comparison_from_readings(skewed)
    assert one.columns == two.columns and one.dtypes == two.dtypes
    same(one.withColumn("xAvg", F.round("xAvg", 9)), two.withColumn("xAvg", F.round("xAvg", 9)))
    labelled = {r[0] for r in one.select("measure").collect() if r[0].startswith("(Agg) ")}
    assert "(Agg) hot" in labelled


def test_one_pass_reports_count_readings_without_a_time(spark):
    rows = [("a", 1, dt.datetime(2024, 1, 1)), ("a", 9, None), ("b", 5, None)]
    readings = spark.createDataFrame(rows, "measure string, value int, publish_ts timestamp").withColumn(
        "received", F.lit(0).cast("bigint")
    )
    raw, agg = raw_rows(readings), agg_rows(windowed_stats(readings))
    same(comparison_from_readings(readings), summary_comparison(raw, agg))
    assert ("a", 9, 1, 5.0, 2) in [tuple(r) for r in comparison_from_readings(readings).collect()]
    assert tuple(reduction_from_readings(readings).first()) == tuple(reduction_report(raw, agg).first()) == (3, 1, 3.0)


def test_sums_beyond_64_bits(spark):
    big = 5 * 10**18
    rows = [("a", big, dt.datetime(2024, 1, 1)), ("a", big, dt.datetime(2024, 1, 1))]
    readings = spark.createDataFrame(rows, "measure string, value bigint, publish_ts timestamp").withColumn(
        "received", F.lit(0).cast("bigint")
    )
    two = summary_comparison(raw_rows(readings), agg_rows(windowed_stats(readings)))
    same(comparison_from_readings(readings), two)


def test_reduction_report(spark, skewed):
    raw, agg = raw_rows(skewed), agg_rows(windowed_stats(skewed))
    want = (raw.count(), agg.count())
    for report in (reduction_report(raw, agg), reduction_from_readings(skewed)):
        row = report.first()
        assert (row["raw_rows"], row["agg_rows"]) == want
        assert row["ratio"] == want[0] / want[1]
    empty = reduction_from_readings(skewed.where("false")).first()
    assert tuple(empty) == (0, 0, None)
    assert tuple(reduction_report(raw.where("false"), agg.where("false")).first()) == (0, 0, None)


# --- words ----------------------------------------------------------------------------


def test_tokens_are_letter_runs(spark):
    df = spark.createDataFrame(
        [(1, "l'été — 3 Mäuse!"), (2, "  x9y "), (3, "12"), (4, ""), (5, None)], "id int, text string"
    )
    rows = [tuple(r) for r in tokenize_letters(df).collect()]
    assert sorted(rows) == [(1, "Mäuse"), (1, "l"), (1, "été"), (2, "x"), (2, "y")]


def test_token_counts(spark):
    df = spark.createDataFrame([("a", "x y x"), ("a", "y"), ("b", "z")], "g string, text string")
    assert sorted(map(tuple, token_counts(df, "g").collect())) == [("a", 4, 2), ("b", 1, 1)]
