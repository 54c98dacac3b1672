"""The parser's decision table, payload by payload."""

import re

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from sensorfold.functions import REASONS, wire_quote
from sensorfold.operators import (
    count_messages,
    extract_readings,
    parse_messages,
    rejected_messages,
    unescape_payload,
)
from sensorfold.schemas import MESSAGE_SCHEMA

OK = '[{"meaning":"a","value":66,"received":2}]'


def one(meaning='"a"', value="66", received="2"):
    return f'[{{"meaning":{meaning},"value":{value},"received":{received}}}]'


# body after unescaping and slicing -> the reading, or None where it is dropped
BODIES = [
    (OK, ("a", 66, 2)),
    (f"  {OK} \n\t", ("a", 66, 2)),
    (OK[1:-1], None),
    (f'"reading": {OK}', None),
    (f'{{"reading": {OK}}}', None),
    (f"{OK} zzz", None),
    (f"{OK}5", None),
    (f"{OK}]", None),
    (f"{OK},", None),
    (f"{OK}{OK}", None),
    (f"{OK},{OK}", None),
    (f"{OK},null", None),
    (f'{OK},"n"],[', None),
    (f'{OK},"\n"],[', None),
    (f"{OK}]],[[", None),
    (f"{OK}],[1", None),
    (OK[:-1] + ',{"meaning":"b","value":1,"received":3}]', ("a", 66, 2)),
    (OK[:-1] + ",{oops]", None),
    (OK[:-1] + ",5]", ("a", 66, 2)),
    ("[5," + OK[1:], None),
    (one(value="66.7"), ("a", 66, 2)),
    (one(value="-66.7"), ("a", -66, 2)),
    (one(value="1e2"), ("a", 100, 2)),
    (one(value="-0.5"), ("a", 0, 2)),
    (one(value='"66"'), ("a", 66, 2)),
    (one(value='"-66"'), ("a", -66, 2)),
    (one(value='"66.7"'), None),
    (one(value='" 66"'), None),
    (one(value='"66 "'), None),
    (one(value='""'), None),
    (one(value='"x"'), None),
    (one(value="true"), None),
    (one(value="false"), None),
    (one(value="null"), None),
    (one(value="[66]"), ("a", 66, 2)),
    (one(value='["66"]'), ("a", 66, 2)),
    (one(value="[66.7]"), ("a", 66, 2)),
    (one(value="[66,67]"), None),
    (one(value="[66,null]"), None),
    (one(value="[]"), None),
    (one(value="[null]"), None),
    (one(value="[true]"), None),
    (one(value='{"0":66}'), None),
    (one(received="[2]"), ("a", 66, 2)),
    (one(value='{"x":66}'), None),
    (one(value="2147483647"), ("a", 2147483647, 2)),
    (one(value="-2147483648"), ("a", -2147483648, 2)),
    (one(value="3000000000"), None),
    (one(received="1496966201571"), ("a", 66, 1496966201571)),
    (one(received='"1496966201571"'), ("a", 66, 1496966201571)),
    (one(received="1.5e12"), ("a", 66, 1500000000000)),
    (one(received="true"), None),
    (one(received="null"), None),
    (one(received='"x"'), None),
    (one(meaning="5"), ("5", 66, 2)),
    (one(meaning="true"), ("true", 66, 2)),
    (one(meaning='""'), ("", 66, 2)),
    (one(meaning="null"), None),
    (one(meaning='{"x":1}'), None),
    (one(meaning='["z"]'), ("z", 66, 2)),
    (one(meaning='["z","y"]'), None),
    (one(meaning="[[1]]"), None),
    (one(meaning='[{"x":1}]'), None),
    (one(meaning="5.0"), ("5.0", 66, 2)),  # a numeric name keeps its spelling
    (one(meaning="1e2"), ("1e2", 66, 2)),
    (one(meaning="0.10"), ("0.10", 66, 2)),
    (one(meaning="-0"), ("-0", 66, 2)),
    (one(meaning="12345678901234567890123"), ("12345678901234567890123", 66, 2)),
    (one(meaning=" 7.50 "), ("7.50", 66, 2)),
    (one(meaning="[5.0]"), ("5.0", 66, 2)),
    (one(meaning="[ 1E2 ]"), ("1E2", 66, 2)),
    ('[{"meaning":1.0,"x":{"meaning":3.0},"meaning":2.00,"value":66,"received":2},{"meaning":9.0}]', ("2.00", 66, 2)),
    (one(meaning='"5.0"'), ("5.0", 66, 2)),
    (one(meaning='"-x"'), ("-x", 66, 2)),
    (one(meaning='"{x"'), ("{x", 66, 2)),
    (one(meaning='"[x"'), ("[x", 66, 2)),
    (one(meaning='"température"'), ("température", 66, 2)),
    ('[{"value":66,"received":2}]', None),
    ('[{"meaning":"a","received":2}]', None),
    ('[{"meaning":"a","value":66}]', None),
    ('[{"received":2,"x":{"y":[1]},"value":66,"meaning":"a"}]', ("a", 66, 2)),
    ("", None),
    ("[]", None),
    ("[5]", None),
    ("[[]]", None),
    (f"[{OK}]", None),
    ("null", None),
    ("[null]", None),
    ("][", None),
    ("[{'meaning':'a','value':66,'received':2}]", None),
    ("[{meaning:a,value:66,received:2}]", None),
    ('[{"meaning":"a","meaning":"b","value":66,"received":2}]', ("b", 66, 2)),
    ('[{"meaning":"a","x":1,"value":66,"x":2,"received":2}]', ("a", 66, 2)),
]

# whole payloads, where the unescaping or the slice matters
PAYLOADS = [
    ('"[{\\"meaning\\":\\"pipeTemperature\\",\\"value\\":66,\\"received\\":1496966201571}]"',
     ("pipeTemperature", 66, 1496966201571)),
    (f"x{OK}y", ("a", 66, 2)),
    (OK, None),
    ('{"reading": [{"meaning":"pipeTemperature","value":66,"received":1496966201571}]}', None),
    ('"[{\\\\\\"meaning\\\\\\":\\"a\\\\nb\\",\\"value\\":1,\\"received\\":2}]"', ("anb", 1, 2)),
    ("", None),
    ("x", None),
    ("xy", None),
    ("\\", None),
    (None, None),
]

CASES = [("'" + body + "'", want) for body, want in BODIES] + PAYLOADS


@pytest.fixture(scope="module")
def parsed(spark):
    rows = [(i, payload) for i, (payload, _) in enumerate(CASES)]
    return {
        r["i"]: r for r in parse_messages(spark.createDataFrame(rows, "i int, payload string")).collect()
    }


@pytest.mark.parametrize("i", range(len(CASES)), ids=[repr(c[0])[:60] for c in CASES])
def test_decision(parsed, i):
    row, want = parsed[i], CASES[i][1]
    assert row["valid"] == (want is not None)
    if want is not None:
        assert (row["measure"], row["value"], row["received"]) == want


@pytest.mark.parametrize(
    "payload, body",
    [("abc", "b"), ("ab", ""), ("a", None), ("", None), ("\\a\\b\\c\\", "b"), ("é✓😀x", "✓😀")],
)
def test_body(spark, payload, body):
    df = unescape_payload(spark.createDataFrame([(payload,)], "payload string"))
    assert df.columns == ["body"]
    assert df.first()[0] == body


def test_wire_quote_is_undone_by_the_body(spark):
    texts = [('[{"k":"v"}]',), ("plain",), ("",)]
    df = spark.createDataFrame(texts, "t string")
    back = unescape_payload(df.select(wire_quote(F.col("t")).alias("payload"))).collect()
    assert [r["body"] for r in back] == [t[0] for t in texts]


def test_every_message_is_either_a_reading_or_rejected(spark):
    rows = [(i, payload) for i, (payload, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "i int, payload string")
    good = {r["i"] for r in extract_readings(df).collect()}
    bad = {r["i"] for r in rejected_messages(df).collect()}
    assert good == {i for i, (_, want) in enumerate(CASES) if want is not None}
    assert bad == set(range(len(CASES))) - good
    counts = count_messages(df).first()
    assert (counts["total"], counts["good"], counts["bad"]) == (len(CASES), len(good), len(bad))


def test_observation_counts_without_failing(spark):
    df = spark.createDataFrame([("'" + OK + "'",), ("junk",), (None,)], "payload string")
    seen = Observation("parsing")
    parsed = parse_messages(df).observe(
        seen, F.count(F.lit(1)).alias("total"), F.count_if(~F.col("valid")).alias("bad")
    )
    assert parsed.where("valid").count() == 1
    assert seen.get == {"total": 3, "bad": 2}


def test_columns_and_types(spark):
    out = extract_readings(spark.createDataFrame([], MESSAGE_SCHEMA))
    assert out.dtypes == [
        ("measure", "string"), ("value", "int"), ("received", "bigint"), ("publish_ts", "timestamp"),
    ]


def test_only_arrays_reach_the_parser(spark):
    df = spark.createDataFrame([("'" + OK + "'",)], "payload string")
    text = extract_readings(df)._jdf.queryExecution().optimizedPlan().toString()
    guarded = re.search(r"CASE WHEN StartsWith\(.*?\[\) THEN .*?parseJson", text, re.S)
    assert guarded, text


def test_parser_needs_a_configured_session(spark):
    key = "spark.sql.variant.allowDuplicateKeys"
    spark.conf.set(key, "false")
    try:
        with pytest.raises(ValueError, match=key):
            extract_readings(spark.createDataFrame([("x",)], "payload string"))
    finally:
        spark.conf.set(key, "true")


def test_payload_is_parsed_once(spark):
    df = spark.createDataFrame([("'" + OK + "'",)], "payload string")
    plan = extract_readings(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1
    assert "Python" not in plan


# --- lenient spelling -----------------------------------------------------------------

LENIENT = [
    ("[{'meaning':'a','value':66,'received':2}]", ("a", 66, 2)),
    ("[{meaning:a,value:66,received:2}]", ("a", 66, 2)),
    ("[{meaning=a;value=66;received=>2}]", ("a", 66, 2)),
    ("[{'meaning':\"it's\",value:'66',received:\"2\"}]", ("it's", 66, 2)),
    ("[{/* one */meaning:a,value:66, // two\nreceived:2} # three\n]", ("a", 66, 2)),
    ("[{meaning:a,value:66,received:2},]", ("a", 66, 2)),
    ("[{meaning:a,value:66,received:2},,{x:y}]", ("a", 66, 2)),
    ("[{meaning:a,value:66.7,received:2}]", ("a", 66, 2)),
    ("[{meaning:a,value:007,received:+2}]", ("a", 7, 2)),
    ("[{meaning:TRUE,value:66,received:2}]", ("true", 66, 2)),
    ("[{meaning:5.0,value:66,received:2}]", ("5.0", 66, 2)),
    ("[{meaning:a b,value:66,received:2}]", None),
    ("[,{meaning:a,value:66,received:2}]", None),
    ("[{meaning:NULL,value:66,received:2}]", None),
    ("[{meaning:a,value:x,received:2}]", None),
    ("[{meaning:a,value:66,received:2}", None),
    ("[{meaning:a,value:66,received:2}] x", None),
    ("[{meaning:a,value:66,received:2,}]", None),
    ("[{'meaning':'a,value:66,received:2}]", None),
    ("{meaning:a,value:66,received:2}", None),
    ("['a']", None),
    ("[" * 50_000, None),
    ("[" + "," * 50_000 + "]", None),
    ("['" + "x" * 50_000 + "']", None),
    ("[" + "/*" * 20_000, None),
    ("", None),
    (OK, ("a", 66, 2)),
    (OK[:-1], None),
]


def test_lenient_spellings(spark):
    rows = [(i, "'" + body + "'") for i, (body, _) in enumerate(LENIENT)] + [(-1, None), (-2, "")]
    df = spark.createDataFrame(rows, "i int, payload string")
    got = {r["i"]: (r["measure"], r["value"], r["received"]) for r in extract_readings(df, lenient=True).collect()}
    assert got == {i: want for i, (_, want) in enumerate(LENIENT) if want is not None}
    strict = {r["i"] for r in extract_readings(df).collect()}
    assert strict == {len(LENIENT) - 2}
    left = {r["i"] for r in rejected_messages(df, lenient=True).collect()}
    assert left == {r[0] for r in rows} - set(got)


def test_lenient_takes_what_strict_takes(spark):
    rows = [(i, payload) for i, (payload, want) in enumerate(CASES) if want is not None]
    df = spark.createDataFrame(rows, "i int, payload string")
    same = lambda x: sorted((r["i"], r["measure"], r["value"], r["received"]) for r in x.collect())
    assert same(extract_readings(df, lenient=True)) == same(extract_readings(df))


def test_good_bodies_are_not_parsed_again(spark):
    """The second parse is asked for where the first found no reading, and nowhere else."""
    df = spark.createDataFrame([("'" + OK + "'",)], "payload string")
    plan = extract_readings(df, lenient=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 2 and "Python" not in plan
    assert re.search(r"CASE WHEN \(?isnull\(_strict|_strict#\d+\)? THEN|isnull\(_strict", plan)


# --- reasons --------------------------------------------------------------------------

WHY = [
    (OK, None), ("", "not an array"), ("{}", "not an array"), ("junk", "not an array"), (OK[:-1], "malformed"), (OK + " zzz", "malformed"),
    (f"{OK},{OK}", "more than one value"), ("[]", "first element is not an object"), ("[5]", "first element is not an object"), ("[null]", "first element is not an object"),
    (f"[{OK}]", "first element is not an object"), ('[{"value":66,"received":2}]', "no name"), (one(meaning="null"), "no name"),
    (one(meaning='{"x":1}'), "name is not a scalar"), (one(meaning='["z","y"]'), "name is not a scalar"), ('[{"meaning":"a","received":2}]', "no value"),
    (one(value="true"), "value is not a number"), (one(value='"x"'), "value is not a number"), (one(value='"66.7"'), "value is not a number"),
    (one(value="3000000000"), "value is out of range"), (one(value='"3000000000"'), "value is out of range"), (one(value="[1,2]"), "value is not a number"),
    ('[{"meaning":"a","value":66}]', "no time"), (one(received="false"), "time is not a number"), (one(received="99999999999999999999"), "time is out of range"),
]


def test_reasons(spark):
    rows = [(i, "'" + body + "'") for i, (body, _) in enumerate(WHY)] + [(-1, None), (-2, "x")]
    df = spark.createDataFrame(rows, "i int, payload string")
    got = {r["i"]: r["reason"] for r in parse_messages(df, reasons=True).collect()}
    assert {i: got[i] for i in range(len(WHY))} == dict(enumerate(w for _, w in WHY))
    assert got[-1] == got[-2] == "no body"
    assert set(got.values()) - {None} <= set(REASONS)


def test_every_rejected_message_has_a_reason(spark):
    rows = [(i, payload) for i, (payload, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "i int, payload string")
    for lenient in (False, True):
        told = parse_messages(df, lenient=lenient, reasons=True).collect()
        assert all((r["reason"] is None) == r["valid"] for r in told)
    assert rejected_messages(df, reasons=True).columns == ["i", "payload", "reason"]
