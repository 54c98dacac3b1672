import random
import re
import tracemalloc

import numpy as np
import pandas as pd
import pytest

from sensorfold.llm import common
from sensorfold.llm import op7_ngram_join as op
from sensorfold.llm.op7_ngram_join import keep_one, similar_documents

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, width=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(w) >= width:
        return frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1))
    return frozenset([tuple(w)]) if w else frozenset()


def brute(rows, width=4, percent=85):
    sets = [shingles(t, width) for _, t in rows]
    links = {i: set() for i in range(len(rows))}
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                links[i].add(j)
                links[j].add(i)
    out = []
    for i in range(len(rows)):
        seen, open_ = {i}, [i]
        while open_:
            for k in links[open_.pop()] - seen:
                seen.add(k)
                open_.append(k)
        out.append((rows[i][0], len(sets[i]), min((rows[k][0] for k in seen if rows[k][0] is not None), default=None)))
    return sorted(out, key=repr)


def corpus(seed):
    """Clusters of near copies around the threshold, common lines, copies, short and odd texts."""
    r = random.Random(seed)
    vocab = [f"w{k}" for k in range(300)]
    line = " ".join(r.choice(vocab) for _ in range(25))
    rows = []
    for c in range(8):
        base = [r.choice(vocab) for _ in range(r.choice([8, 40, 120]))]
        for _ in range(r.choice([1, 5, 40])):
            words = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 3])):
                words[r.randrange(len(words))] = r.choice(vocab)
            if r.random() < 0.3:
                words.append(r.choice(vocab))
            text = " ".join(words)
            rows.append((line + "\n" + text) if c % 3 == 0 else text)
    rows += [rows[0].upper(), rows[0] + "\r\n", rows[1], rows[1], "", " \t", None, "one", "ONE", "one two", "a b c", "A  b\nC", "a b c d", "É b c d", "é b c d"]
    ids = list(range(len(rows)))
    r.shuffle(ids)
    return [(i * 3, t) for i, t in zip(ids, rows)]


@pytest.mark.parametrize("few, block, frequent", [(64, 1_024, 1 << 17), (4, 8, 1 << 17), (64, 1_024, 0), (2, 1_024, 40)])
def test_against_brute_force(spark, monkeypatch, crowded, few, block, frequent):
    monkeypatch.setattr(op, "FEW", few)
    monkeypatch.setattr(op, "BLOCK", block)
    for seed in (few, few + 1):
        rows = corpus(seed)
        df = crowded(spark.createDataFrame(rows, "doc_id bigint, text string")).repartition(3)
        got = similar_documents(df, frequent=frequent)
        assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_other_widths(spark):
    rows = corpus(77)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = similar_documents(df, width=5, percent=80)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, 5, 80)


def test_null_and_repeated_ids_and_no_rows(spark):
    rows = [(None, "a b c d e"), (4, "a b c d e"), (4, "x y z u v"), (3, "x y z u v"), (None, "only here now once"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(map(tuple, similar_documents(df).collect()), key=repr)
    assert got == sorted([(None, 2, 4), (4, 2, 4), (4, 2, 3), (3, 2, 3), (None, 1, None), (None, 0, None)], key=repr)
    assert similar_documents(df.where("false")).count() == 0


def test_keep_one(spark, crowded):
    rows = corpus(5)
    df = crowded(spark.createDataFrame(rows, "doc_id bigint, text string"))
    want = sorted(i for i, _, c in brute(rows) if i == c)
    out = keep_one(df)
    assert out.columns == df.columns and sorted(r["doc_id"] for r in out.collect()) == want


def test_near_copies_of_null_ids(spark):
    words = [f"w{k}" for k in range(60)]
    alike = lambda k: " ".join(words[:k] + ["other"] + words[k + 1 :])
    # 9 and 8 differ too much to link but for the row of null id between them
    rows = [(None, alike(59)), (9, " ".join(words)), (8, alike(59) + " a b c d e"), (None, "only here now once"), (None, "x y z u v " * 2)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert brute(rows, 4, 90) == sorted(map(tuple, similar_documents(df, percent=90).collect()), key=repr)
    assert sorted(c for i, _, c in brute(rows, 4, 90) if i is not None) == [8, 8]


def test_a_tile_of_two_full_blocks_stays_small():
    """Two blocks of near copies, as in a very large group: all hang together, in bounded memory."""
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, op.BLOCK_TOKENS // op.BLOCK - 20, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[k % 20 :], rng.integers(0, 2**63, 20, dtype=np.uint64)])) for k in range(2 * op.BLOCK)]
    tile = pd.DataFrame({
        "run": 1, "node": np.arange(len(sets)), "n": [len(s) for s in sets], "tokens": [s.tobytes() for s in sets],
        "i": 0, "j": 1, "side": np.arange(len(sets)) % 2,
    })
    tracemalloc.start()
    found = op._tile_links(80)(tile)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20
    assert set(found["a"]) == set(range(1, len(sets))) and set(found["b"]) == {0}


def test_edges_of_a_large_group_follow_its_size(spark, monkeypatch):
    """Two blocks give one edge where each hangs together, not a forest of all their classes."""
    monkeypatch.setattr(op, "BLOCK", 8)
    op.ship(spark)
    n = 120  # near copies: any two link
    texts = [" ".join([f"w{k}" for k in range(59)] + [f"x{i}"]) for i in range(n)]
    sets = list(op.shingle_sets(texts))
    rows = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "_id string, _text string")
    classes = spark.createDataFrame(
        [(i, i, op.set_key(s).hex(), len(s)) for i, s in enumerate(sets)], "node bigint, rep bigint, cls string, n bigint"
    )
    many = spark.range(n).selectExpr("1L AS run", "id AS node")
    so_far = spark.range(n).selectExpr("id AS node", "id AS component")
    edges = op._tiled(rows, classes, many, so_far, op.WIDTH, op.PERCENT)
    assert {r["component"] for r in op._together(so_far, edges).collect()} == {0}
    assert edges.count() < n + 15 * 14 // 2


def test_a_tile_leaves_out_links_within_a_component():
    sets = [np.arange(20, dtype=np.uint64)] * 4
    tile = pd.DataFrame({
        "run": 1, "node": [5, 6, 7, 8], "n": 20, "tokens": [s.tobytes() for s in sets], "i": 0, "j": 0, "side": 0, "of": [2, 2, 7, 2],
    })
    assert op._tile_links(80)(tile).to_dict("list") == {"a": [7], "b": [2]}
    assert op._tile_links(80)(tile.assign(of=2)).empty


def test_sets_take_few_bytes_on_their_way(spark, monkeypatch):
    """Sets move once to be settled, in fewer bytes than their tokens, and what brought them goes before pairs are made."""
    r = random.Random(3)
    texts = [" ".join(r.choice(["the", "of", "and", f"word{r.randrange(500)}"]) for _ in range(400)) for _ in range(40)]
    texts += [" ".join("".join(map(chr, r.choices(range(0x4E00, 0x9000), k=60))) for _ in range(9)), "One", "é \ud800 x y z"]
    op.ship(spark)
    sets = list(op.shingle_sets(texts))
    wrapped = [op._wrapped(t, s) for t, s in zip(texts, sets, strict=True)]
    assert all(np.array_equal(x, y) for x, y in zip(op._unwrapped(wrapped, op.WIDTH), sets, strict=True))
    assert all(len(w) <= 8 * len(s) + 1 for w, s in zip(wrapped, sets, strict=True))
    texts, sets = texts[:-1], sets[:-1]  # no lone surrogates in a table
    rows = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)] * 2, "_id string, _text string")
    classes = spark.createDataFrame(
        [(i, i, op.set_key(s).hex(), len(s)) for i, s in enumerate(sets)], "node bigint, rep bigint, cls string, n bigint"
    )
    made, real = [], op.settled

    def settled(df):
        name = next((f.name for f in df.schema if f.dataType.simpleString() == "binary"), None)
        out = real(df)
        if name:
            plan = df._jdf.queryExecution().executedPlan().toString()
            made.append((plan, out.selectExpr(f"sum(octet_length({name}))", "sum(n)").first()))
        return out

    monkeypatch.setattr(op, "settled", settled)
    monkeypatch.setattr(op, "forget", lambda spark: made.append("forget"))
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        pairs = spark.range(len(texts)).selectExpr("id AS a", "(id + 1) % 42 AS b")
        assert op._verified(rows, classes, pairs, op.WIDTH, op.PERCENT).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    (plan, (size, tokens)), then = made[-2:]
    assert then == "forget"
    assert size < 8 * tokens / 2
    assert plan.split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 2  # one for each side of the join


@pytest.mark.parametrize("rows", [1 << 14, 4])
def test_rounds_of_few_edges_take_few_tasks(spark, monkeypatch, rows):
    """A chain, a star, a null and a loop over many shuffle partitions, which AQE is not to merge."""
    monkeypatch.setattr(common, "ROUND_ROWS", rows)
    edges = [(k, k + 1) for k in range(9)] + [(30, k) for k in range(31, 60)] + [(1, None), (70, 70)]
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    context = spark.sparkContext
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        context.setJobGroup(f"few-edges-{rows}", "components of few edges")
        got = common.components(spark.range(75).toDF("node"), spark.createDataFrame(edges, "a long, b long")).collect()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    want = {k: 0 if k < 10 else 30 if 30 <= k < 60 else k for k in range(75)}
    assert {r["node"]: r["component"] for r in got} == want
    status = context.statusTracker()
    stages = {s for j in status.getJobIdsForGroup(f"few-edges-{rows}") for s in status.getJobInfo(j).stageIds}
    tasks = sum(x.numCompletedTasks for s in stages if (x := status.getStageInfo(s)))
    if rows > len(edges):
        assert tasks < 2_000
