import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sensorfold.llm.op3_mix_sources import mix, mixed_documents

SHAPE = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], SHAPE)


def fill(sizes, weights=(3, 1, 2)):
    """Plain water-filling over sources in order, null last."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % 3] for k, s in enumerate(order)}
    total, fixed = 1.5 * sum(sizes.values()), {s for s in sizes if not sizes[s]}
    while True:
        left = total - sum(2 * sizes[s] for s in fixed)
        rest = sum(w[s] for s in sizes if s not in fixed)
        share = {s: left * w[s] / rest for s in sizes if s not in fixed}
        over = {s for s in share if share[s] > 2 * sizes[s]}
        if not over:
            return {s: share.get(s, 2.0 * sizes[s]) for s in sizes}
        fixed |= over


def test_targets_and_taken(spark, crowded):
    rows = [(i, " ".join(["w"] * (i % 17)) + "\t", f"s{i % 4}" if i % 9 else None) for i in range(200)]
    rows += [(1000, None, "s0"), (1001, "", "blank"), (1002, "x " * 500, "s1"), (5, "again", "s1"), (5, "again", "s1")]
    out = mix(crowded(docs(spark, rows))).collect()
    assert len(out) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += size(t)
    targets, taken = fill(sizes), defaultdict(int)
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(targets[r["source"]], rel=1e-12)
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= 0.5 + 1e-9
    assert sorted(map(tuple, out), key=repr) == sorted(map(tuple, mix(docs(spark, rows).repartition(7)).collect()), key=repr)


def test_rows_of_the_mix(spark, crowded):
    rows = [(i, " ".join(f"w{k}" for k in range(i % 13)), f"s{i % 5}") for i in range(120)] + [(500, None, None), (501, "a  b\nc d", None)]
    base = crowded(docs(spark, rows))
    out = mixed_documents(base)
    assert out.columns == base.columns
    taken = {r["doc_id"]: r["taken"] for r in mix(base).collect()}
    got = defaultdict(int)
    texts = {i: t for i, t, _ in rows}
    for r in out.collect():
        words = (r["text"] or "").split()
        got[r["doc_id"]] += len(words)
        whole = texts[r["doc_id"]]
        assert r["text"] == whole or whole.split()[: len(words)] == words
        assert r["n_chars"] == len(r["text"])
    assert dict(got) == {i: n for i, n in taken.items() if n}


@pytest.mark.parametrize("rows", [[], [(1, None, "a"), (2, "", None)]])
def test_no_words(spark, rows):
    df = docs(spark, rows)
    assert [r["taken"] for r in mix(df).collect()] == [0] * len(rows)
    assert mixed_documents(df).count() == 0


def test_single_source_takes_the_budget(spark):
    df = docs(spark, [(i, "a b c d", "only") for i in range(10)])
    assert mix(df).agg(F.sum("taken")).first()[0] == 60


def test_rows_of_one_id_share_the_cut(spark):
    """Three rows of one id and size take together what the mix says of them."""
    for copies, rest in ((3, 0), (3, 4), (5, 2)):
        rows = [(1, "a b c d e f g h i j", "s")] * copies + [(2 + k, "w " * 7, "s") for k in range(rest)] + [(90, "x y z", "t")]
        df = docs(spark, rows)
        taken = mix(df).groupBy("doc_id").agg(F.sum("taken").alias("n")).collect()
        held = mixed_documents(df).groupBy("doc_id").agg(F.sum(F.size(F.split("text", " +")) - F.when(F.col("text").endswith(" "), 1).otherwise(0)).alias("n")).collect()
        assert {r["doc_id"]: r["n"] for r in held} == {r["doc_id"]: r["n"] for r in taken if r["n"]}
