"""From wire messages to readings."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorfold.functions.payload import (
    held_candidate,
    holds_array,
    is_reading,
    parse_body,
    reading_candidate,
    reject_reason,
    slice_body,
    spelled_measure,
    strict_body,
    strip_backslashes,
)
from sensorfold.session import require_last_key


def unescape_payload(messages: DataFrame) -> DataFrame:
    """Replace ``payload`` by ``body``: no backslashes, and no first and last character."""
    kept = [c for c in messages.columns if c != "payload"]
    unescaped = messages.select("*", strip_backslashes(F.col("payload")).alias("_text"))
    return unescaped.select(*kept, slice_body(F.col("_text")).alias("body"))


def parse_messages(messages: DataFrame, lenient: bool = False, reasons: bool = False) -> DataFrame:
    """Add ``measure, value, received, valid`` to every message; drops none.

    With ``lenient`` a body that is no reading as it stands is spelled anew and parsed once more;
    good ones are parsed once. With ``reasons`` a column ``reason`` says why a message is no
    reading. Both cost nothing where the message is good.

    Each step is its own projection, so that no step is computed twice. The candidate goes
    through ``explode`` of a one-element array on purpose: a filter on a plain projection
    would be pushed below it, and the payload would be parsed again in every conjunct of the
    filter. A generator is a barrier, so one parse it is.
    """
    require_last_key(messages.sparkSession)
    kept = messages.columns
    bodies = unescape_payload(messages.select("*", F.col("payload").alias("_payload"))).withColumnRenamed("_payload", "payload")
    parsed = _candidates(bodies.select(*kept, F.col("body").alias("_body"), parse_body(F.col("body")).alias("_json")), kept)
    if lenient:
        again = F.when(~is_reading(F.col("_c"), F.col("_json")), strict_body(F.col("_body")))
        spelled = parsed.select(*kept, "_body", "_json", "_c", F.explode(F.array(again)).alias("_strict"))
        both = F.when(F.col("_strict").isNull(), F.col("_json")).otherwise(parse_body(F.col("_strict")))
        body = F.coalesce("_strict", "_body").alias("_body")
        parsed = _candidates(
            spelled.select(*kept, body, both.alias("_json"), F.when(F.col("_strict").isNull(), F.col("_c")).alias("_c")), kept
        )
    good = is_reading(F.col("_c"), F.col("_json"))
    why = F.when(~good, reject_reason(F.col("_c"), F.col("_json"), F.col("_body")))
    return parsed.select(
        *kept,
        spelled_measure(F.col("_c.measure"), F.col("_json"), F.col("_body")).alias("measure"),
        *[F.col(f"_c.{name}").alias(name) for name in ("value", "received")],
        good.alias("valid"),
        *([why.alias("reason")] if reasons else []),
    )


def _candidates(rows: DataFrame, kept: list[str]) -> DataFrame:
    """Adds the candidate ``_c`` to ``_body, _json``; one that is there already stays."""
    plain = reading_candidate(F.col("_json"))
    if "_c" in rows.columns:
        plain = F.when(F.col("_c").isNotNull(), F.col("_c")).otherwise(plain)
    plain_rows = rows.select(*kept, "_body", "_json", F.explode(F.array(plain)).alias("_p"))
    whole = F.when(holds_array(F.col("_p")), held_candidate(F.col("_json"))).otherwise(F.col("_p"))
    return plain_rows.select(*kept, "_body", "_json", F.explode(F.array(whole)).alias("_c"))


def extract_readings(
    messages: DataFrame, observe_as: str | None = None, lenient: bool = False
) -> DataFrame:
    """Readings of the well-formed messages; the message's other columns ride along.

    ``lenient`` takes single quotes, bare words and the like too. With ``observe_as`` the counts ``total``, ``bad`` and ``untimed`` (readings without a
    publish time, which no window holds) are published under that name, in a streaming
    query's progress or to a ``pyspark.sql.Observation`` of a batch.
    """
    parsed = observed(parse_messages(messages, lenient), observe_as)
    carried = [c for c in messages.columns if c != "payload"]
    return parsed.where("valid").select("measure", "value", "received", *carried)


def observed(parsed: DataFrame, name: str | None) -> DataFrame:
    """``parse_messages``' rows, whose counts are published under ``name``."""
    if name is None:
        return parsed
    return parsed.observe(
        name,
        F.count(F.lit(1)).alias("total"),
        F.count_if(~F.col("valid")).alias("bad"),
        F.count_if(F.col("valid") & F.col("publish_ts").isNull()).alias("untimed"),
    )


def rejected_messages(messages: DataFrame, reasons: bool = False, lenient: bool = False) -> DataFrame:
    """The messages that ``extract_readings`` leaves out, unchanged; with ``reasons`` also why."""
    parsed = parse_messages(messages, lenient, reasons)
    return parsed.where(~F.col("valid")).select(*messages.columns, *(["reason"] if reasons else []))


def count_messages(messages: DataFrame) -> DataFrame:
    """One row: ``total, good, bad``."""
    return parse_messages(messages).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("valid").alias("good"),
        F.count_if(~F.col("valid")).alias("bad"),
    )
