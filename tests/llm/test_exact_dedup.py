import hashlib
import re

from sensorfold.llm.op10_exact_dedup import dedup, exact_groups

SHAPE = "doc_id bigint, text string, source string"


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    groups = {}
    for (i, _), t in zip(rows, norm):
        groups.setdefault(t, []).append(i)
    out = []
    for (i, _), t in zip(rows, norm):
        keep = min((k for k in groups[t] if k is not None), default=None)
        out.append((i, keep, len(groups[t]), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


LONG = "abc " * 60_000
ROWS = [
    (5, "a b"), (3, "a\t\n b"), (9, " a b"), (4, None), (2, ""), (8, " "), (7, "\n\r"), (11, LONG), (10, LONG + "x"), (12, LONG + "y"),
    (13, LONG + "x"), (14, " "), (15, "  "), (16, "é"), (17, "e"), (5, "a b"), (18, "same length"), (19, "other words"),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "s") for i, t in rows], SHAPE)


def test_against_brute_force(spark, crowded):
    for bits in (1 << 22, 64):  # a crowded bitmap changes nothing
        got = exact_groups(crowded(frame(spark, ROWS)).repartition(3), bitmap_bits=bits)
        assert sorted(map(tuple, got.collect()), key=repr) == brute(ROWS)


def test_null_ids_and_no_rows(spark):
    rows = [(None, "q"), (1, "q"), (None, "alone"), (None, "alone")]
    got = exact_groups(frame(spark, rows))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)
    assert exact_groups(frame(spark, [])).count() == 0


def test_dedup_keeps_columns(spark, crowded):
    df = crowded(frame(spark, ROWS))
    out = dedup(df)
    assert out.columns == df.columns
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(i for i, k, *_ in brute(ROWS) if i == k)


def test_rows_that_repeat_an_id_and_a_text_become_one(spark, crowded):
    rows = [(1, "a b")] * 5 + [(1, "a  b"), (2, "a b"), (3, "own"), (3, "other"), (None, None), (None, ""), (7, "x")]
    df = crowded(frame(spark, rows))
    got = sorted(((r["doc_id"], r["text"]) for r in dedup(df).collect()), key=repr)
    assert len(got) == 5
    assert {(i, " ".join((t or "").split())) for i, t in got} == {(1, "a b"), (3, "own"), (3, "other"), (7, "x"), (None, "")}
