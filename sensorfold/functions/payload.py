"""Column expressions that take a wire payload apart. No Python runs per row."""

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

# A line break needs a backslash inside a JSON string.
MARKER = "\n"


def strip_backslashes(payload: Column) -> Column:
    """Remove every backslash. A literal replace; no regex engine per row."""
    return F.replace(payload, F.lit("\\"), F.lit(""))


def slice_body(text: Column) -> Column:
    """Drop the first and last character, whatever they are; NULL if there are not two."""
    return F.when(F.length(text) >= 2, F.substr(text, F.lit(2), F.length(text) - 2))


def parse_body(body: Column) -> Column:
    """Parse the body as the first of two elements of a JSON array; NULL if malformed.

    Alone, a JSON parser stops at the end of the first value and ignores what follows. The
    second element is a marker that no body can spell, since bodies have no backslashes. If
    the marker comes out right after the body's value, the body was that one value.

    Only an array can be a reading, and its first character tells: other bodies are not parsed,
    since a parser turns down junk by exceptions, which cost more than the parsing.
    """
    whole = F.concat(F.lit("["), body, F.lit(f",{json.dumps(MARKER)}]"))
    array = F.startswith(F.ltrim(body, F.lit(" \t\n\r")), F.lit("["))
    return F.when(array, F.try_parse_json(whole))


def reading_candidate(parsed: Column) -> Column:
    """The first array element's fields, as typed values and as text, and the marker.

    Single fields cost less to extract than a struct of them.
    """

    def field(name: str, as_type: str) -> Column:
        return F.try_variant_get(parsed, f"$[0][0].{name}", as_type)

    return _candidate(field, parsed)


def _candidate(field, parsed: Column) -> Column:
    return F.struct(
        field("meaning", "string").alias("measure"),
        field("value", "int").alias("value"),
        field("received", "bigint").alias("received"),
        field("value", "string").alias("value_text"),
        field("received", "string").alias("received_text"),
        F.try_variant_get(parsed, "$[1]", "string").alias("marker"),
    )


def holds_array(candidate: Column) -> Column:
    """True where a field's text begins as an array's does; few candidates, which cost more."""
    begins = lambda name: F.coalesce(F.startswith(candidate[name], F.lit("[")), F.lit(False))
    return begins("measure") | begins("value_text") | begins("received_text")


def held_candidate(parsed: Column) -> Column:
    """The same candidate, where a field that is an array of one element counts as that element."""

    def field(name: str, as_type: str) -> Column:
        path = f"$[0][0].{name}"
        held = F.try_variant_get(parsed, path, "array<variant>")
        only = F.when(F.size(held) == 1, F.try_variant_get(held[0], "$", as_type))
        plain = F.try_variant_get(parsed, path, as_type)
        return F.when(held.isNotNull(), only).otherwise(plain)

    return _candidate(field, parsed)


def _spelled_as_number(text: Column) -> Column:
    """Told by the ends alone: what lies between has already been read as a number."""
    return (text >= "+") & (text < ":") & F.right(text, F.lit(1)).between("0", "9")


def _kind(parsed: Column, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(parsed, path, "variant"))


def is_reading(candidate: Column, parsed: Column) -> Column:
    """True for a complete reading, False (never NULL) for anything else.

    Extracting from a variant is more generous than the wire format: it takes ``true`` for
    1, trims quoted numbers, and renders an object or array as text.
    """
    measure = candidate["measure"]
    complete = (
        measure.isNotNull() & candidate["value"].isNotNull() & candidate["received"].isNotNull()
    )
    alone = candidate["marker"] == MARKER
    numeric = _spelled_as_number(candidate["value_text"]) & _spelled_as_number(
        candidate["received_text"]
    )
    scalar_name = F.when(
        F.left(measure, F.lit(1)).isin("{", "["),
        _kind(parsed, "$[0][0].meaning").isin("STRING", "ARRAY<STRING>"),
    ).otherwise(F.lit(True))
    return F.coalesce(complete & alone & numeric & scalar_name, F.lit(False))


def spelled_measure(measure: Column, parsed: Column, body: Column) -> Column:
    """The name as the message spells it: ``5.0``, ``1e2`` and ``0.10`` stay what they are.

    A parsed number has forgotten its spelling. Only where a name looks like a number and is one,
    its own text is cut out of the body, at the place of its field.
    """
    numeric = F.left(measure, F.lit(1)).isin("-", *"0123456789") & ~_kind(parsed, "$[0][0].meaning").isin("STRING", "ARRAY<STRING>")
    return F.when(numeric, F.coalesce(_own_text(body, "meaning"), measure)).otherwise(measure)


def _own_text(body: Column, name: str) -> Column:
    """The token that spells a field of the first element, or the one element of its array.

    For bodies that parse: one pass over the tokens keeps the depth, the field that was named
    last and what has been found; of a repeated field the last one counts.
    """
    nothing = F.lit(None).cast("string")
    start = F.struct(
        F.lit(0).alias("depth"), F.lit(0).alias("element"), nothing.alias("field"), F.lit(False).alias("named"),
        F.lit(False).alias("held"), nothing.alias("found"),
    )

    def step(acc: Column, t: Column) -> Column:
        in_object = (acc["depth"] == 2) & (acc["element"] == 0)
        value = in_object & acc["named"] & ~t.isin(",", "}")
        mine = acc["field"] == f'"{name}"'
        inside = acc["held"] & (acc["depth"] == 3) & (t != "]")
        return F.struct(
            (acc["depth"] + F.when(t.isin("[", "{"), 1).when(t.isin("]", "}"), -1).otherwise(0)).alias("depth"),
            (acc["element"] + F.when((acc["depth"] == 1) & (t == ","), 1).otherwise(0)).alias("element"),
            F.when(in_object & ~acc["named"] & ~t.isin(",", ":"), t).otherwise(acc["field"]).alias("field"),
            F.when(in_object & (t == ":"), True).when(in_object & (t == ","), False).otherwise(acc["named"]).alias("named"),
            F.when(value & mine, t == "[").when(acc["depth"] <= 2, False).otherwise(acc["held"]).alias("held"),
            F.when((value & mine) | inside, t).otherwise(acc["found"]).alias("found"),
        )

    return F.aggregate(_tokens(body), start, step, lambda acc: acc["found"])


#: Why a message is no reading, in the order in which it is asked.
REASONS = (
    "no body", "not an array", "malformed", "more than one value", "first element is not an object",
    "no name", "name is not a scalar", "no value", "value is not a number", "value is out of range",
    "no time", "time is not a number", "time is out of range",
)


def reject_reason(candidate: Column, parsed: Column, body: Column) -> Column:
    """The first of :data:`REASONS` that holds for a message which is no reading.

    From the same parse; asked of turned-down messages only.
    """
    begins = F.startswith(F.ltrim(body, F.lit(" \t\n\r")), F.lit("["))
    name_kind = _kind(parsed, "$[0][0].meaning")
    scalars = r"^(?:ARRAY<)?(?:STRING|BOOLEAN|BIGINT|DOUBLE|FLOAT|DECIMAL\([0-9,]+\))>?$"

    absent = lambda kind: F.coalesce(kind == "VOID", F.lit(True))

    def number(field: str, what: str) -> list[tuple[Column, str]]:
        text = candidate[f"{field}_text"]
        return [
            (absent(_kind(parsed, f"$[0][0].{field}")), f"no {what}"),
            (text.isNull(), f"{what} is not a number"),
            (~_spelled_as_number(text) | text.try_cast("double").isNull(), f"{what} is not a number"),
            (candidate[field].isNull() & ~F.rlike(text, F.lit("^[+-]?[0-9]+$")), f"{what} is not a number"),
            (candidate[field].isNull(), f"{what} is out of range"),
        ]

    cases = [
        (body.isNull(), "no body"),
        (~begins, "not an array"),
        (parsed.isNull(), "malformed"),
        (F.coalesce(candidate["marker"] != MARKER, F.lit(True)), "more than one value"),
        (~F.startswith(F.coalesce(_kind(parsed, "$[0][0]"), F.lit("")), F.lit("OBJECT")), "first element is not an object"),
        (absent(name_kind), "no name"),
        (~F.rlike(name_kind, F.lit(scalars)), "name is not a scalar"),
        (candidate["measure"].isNull(), "name is not a scalar"),
        *number("value", "value"),
        *number("received", "time"),
    ]
    out = F.lit("malformed")
    for condition, reason in reversed(cases):
        out = F.when(condition, reason).otherwise(out)
    return out


# A token of a lenient body: a quoted text, a comment, a mark, white space, or a bare word. There
# are no escapes, as bodies have no backslashes; what fits nothing is a token by itself.
_TOKEN = (
    r"\"[^\"]*\"|'[^']*'|/\*(?s:.*?)\*/|//[^\n\r]*|#[^\n\r]*|=>|[\[\]{}:,;=]|[ \t\f\r\n]+"
    r"|[^/\\;#={}\[\]:, \t\f\r\n\"'][^/\\;#={}\[\]:, \t\f\r\n]*|."
)
_NUMBER = r"^-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?$"


def _tokens(body: Column) -> Column:
    """A body's tokens without white space and comments."""
    found = F.regexp_extract_all(body, F.lit(f"(?s){_TOKEN}"), F.lit(0))
    return F.filter(found, lambda t: ~F.rlike(t, F.lit(r"^(?:[ \t\f\r\n]|/\*|//|#)")))


def strict_body(body: Column) -> Column:
    """A leniently spelled body as strict JSON.

    Single quotes and bare words become quoted texts, ``=``, ``=>`` and ``;`` the marks they stand
    for, comments and white space between tokens go, an element left out of an array is null. What
    is wrong beyond that stays wrong, and the strict parser turns it down.
    """
    mark = lambda t: F.when(t.isin("=", "=>"), ":").when(t == ";", ",").otherwise(t)
    quoted = lambda t: F.concat(F.lit('"'), F.replace(t, F.lit('"'), F.lit("'")), F.lit('"'))

    def strict(tokens: Column) -> Column:
        def one(t: Column, i: Column) -> Column:
            after = F.get(tokens, i + 1)
            # nothing stands between these two marks
            gap = (t.isin("[", ",") & after.isin(",")) | ((t == ",") & (after == "]"))
            word = F.lower(t)
            return (
                F.when(t.isin("[", "]", "{", "}", ":", ","), F.when(gap, F.concat(t, F.lit("null"))).otherwise(t))
                .when(F.startswith(t, F.lit('"')) & (F.length(t) > 1), t)
                .when(F.startswith(t, F.lit("'")) & (F.length(t) > 1), quoted(F.substr(t, F.lit(2), F.length(t) - 2)))
                .when(after == ":", quoted(t))
                .when(word.isin("true", "false", "null"), word)
                .when(F.rlike(t, F.lit(_NUMBER)), t)
                .otherwise(quoted(t))
            )

        return F.array_join(F.transform(tokens, one), "")

    # the outer transform names the tokens, which would else be cut anew for each of them
    return F.transform(F.array(F.transform(_tokens(body), mark)), strict)[0]


def wire_quote(text: Column) -> Column:
    """The producer's side: wrap text in quotes, escaping backslashes and quotes."""
    slashes = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.concat(F.lit('"'), F.replace(slashes, F.lit('"'), F.lit('\\"')), F.lit('"'))
